"""Whole-batch text arithmetic with numpy: words, word hashes and shingles of many texts at once.

Every function works on a list of texts and returns flat arrays with offsets, so that no Python
loop runs over words.  A word is a run of letters and digits of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_POW_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_tables: dict[str, np.ndarray] = {}
U64 = np.uint64


def _word_table() -> np.ndarray:
    """True for each code point that is a letter or a digit."""
    if "word" not in _tables:
        low = np.fromiter((chr(c).isalnum() for c in range(0x32400)), dtype=bool, count=0x32400)
        table = np.zeros(0x110000, dtype=bool)
        table[:0x32400] = low
        _tables["word"] = table
    return _tables["word"]


def _letter_table() -> np.ndarray:
    if "letter" not in _tables:
        low = np.fromiter((chr(c).isalpha() for c in range(0x32400)), dtype=bool, count=0x32400)
        table = np.zeros(0x110000, dtype=bool)
        table[:0x32400] = low
        _tables["letter"] = table
    return _tables["letter"]


def _powers(n: int) -> np.ndarray:
    have = _tables.get("pow")
    if have is None or len(have) < n:
        size = max(256, 1 << int(n).bit_length())
        with np.errstate(over="ignore"):
            have = np.cumprod(np.full(size, _POW_BASE, dtype=U64), dtype=U64)
        _tables["pow"] = have
    return have


def _inverse_powers(n: int) -> np.ndarray:
    """The inverse of the base to the power 0, 1, 2, ..."""
    have = _tables.get("inverse")
    if have is None or len(have) < n:
        size = max(256, 1 << int(n).bit_length())
        step = np.full(size, U64(pow(int(_POW_BASE), -1, 2**64)), dtype=U64)
        step[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(step, dtype=U64)
        _tables["inverse"] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit touches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(32))
        x = x * U64(0xD6E8FEB86659FD93)
        x = x ^ (x >> U64(29))
        x = x * U64(0xA5CB9243F01B0A4B)
        return x ^ (x >> U64(32))


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Words:
    """Words of a list of texts.

    ``hashes`` holds one 64-bit hash a word over all texts, ``offsets`` the bounds of each text in
    it; ``starts`` and ``ends`` are character positions in ``joined`` (the lower-cased texts,
    each followed by a line feed) and ``base`` is where each text begins there.
    """

    def __init__(self, texts: list[str], keep_text: bool = False, letters: bool = False):
        low = [(t or "").lower() for t in texts]
        lens = np.fromiter(map(len, low), dtype=np.int64, count=len(low)) + 1
        joined = "\n".join(low) + "\n"
        self.joined = joined if keep_text else None
        chars = codepoints(joined)
        self.base = np.concatenate([[0], np.cumsum(lens)])
        self.chars = chars if keep_text else None
        isw = (_letter_table() if letters else _word_table())[chars]
        edge = np.flatnonzero(np.diff(isw.view(np.int8), prepend=np.int8(0)))
        starts, ends = edge[0::2], edge[1::2]
        self.starts, self.ends = starts, ends
        n = ends - starts
        self.offsets = np.searchsorted(starts, self.base).astype(np.int64)
        if len(starts):
            with np.errstate(over="ignore"):
                if len(chars) <= 1 << 22:  # running sums over all characters, taken apart by words: powers are invertible
                    total = np.zeros(len(chars) + 1, dtype=U64)
                    np.cumsum((chars.astype(U64) + U64(0x51)) * _powers(len(chars))[:len(chars)], out=total[1:])
                    value = (total[ends] - total[starts]) * _inverse_powers(len(chars))[starts]
                else:
                    at = np.flatnonzero(isw)
                    first = np.concatenate([[0], np.cumsum(n)[:-1]])
                    pos = np.arange(len(at)) - np.repeat(first, n)
                    value = np.add.reduceat((chars[at].astype(U64) + U64(0x51)) * _powers(int(n.max()) + 1)[pos], first)
                self.hashes = mix(value + n.astype(U64))
        else:
            self.hashes = np.zeros(0, dtype=U64)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all k-word sequences, their offsets by text, and the first word's index of each."""
        w = self.hashes
        counts = np.maximum(np.diff(self.offsets) - (k - 1), 0)
        off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        if len(w) < k or off[-1] == 0:
            return np.zeros(0, dtype=U64), off, np.zeros(0, dtype=np.int64)
        with np.errstate(over="ignore"):
            h = w[: len(w) - k + 1].copy()
            for i in range(1, k):
                h = h * U64(0xC2B2AE3D27D4EB4F) + w[i : len(w) - k + 1 + i]
        first = np.arange(off[-1]) + np.repeat(self.offsets[:-1] - off[:-1], counts)
        return mix(h[first]), off, first


def sequence_keys(hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One hash of each run of n (one at least) words from ``first`` on; runs may not overlap but stand in order."""
    if not len(first):
        return np.zeros(0, dtype=U64)
    at = np.concatenate([[0], np.cumsum(n)[:-1]])
    pos = np.arange(int(n.sum())) - np.repeat(at, n)
    with np.errstate(over="ignore"):
        value = hashes[np.repeat(first, n) + pos] * _powers(int(n.max()) + 1)[pos]
        return mix(np.add.reduceat(value, at) + n.astype(U64))


def among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(x), dtype=bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def reduce_min(values: np.ndarray, offsets: np.ndarray, empty) -> np.ndarray:
    """Minimum of each stretch; ``empty`` for a stretch without values."""
    out = np.full(len(offsets) - 1, empty, dtype=values.dtype)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.minimum.reduceat(values, offsets[:-1][full])
    return out


def text_hashes(w: Words) -> np.ndarray:
    """One hash of the whole word sequence of each text; equal word sequences have equal hashes."""
    n = np.diff(w.offsets)
    out = np.zeros(len(n), dtype=U64)
    full = np.flatnonzero(n > 0)
    if len(full):
        first = w.offsets[:-1]
        pos = np.arange(len(w.hashes)) - np.repeat(first, n)
        with np.errstate(over="ignore"):
            value = w.hashes * (mix(pos.astype(U64) + U64(7)) | U64(1))
            out[full] = mix(np.add.reduceat(value, first[full]) + n[full].astype(U64))
    return out


def chunks(lengths: np.ndarray, most: int = 1_500_000) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` characters together; a longer text makes a run of its own."""
    at, total = 0, 0
    for i, n in enumerate(lengths):
        if i > at and total + n > most:
            yield at, i
            at, total = i, 0
        total += int(n)
    if at < len(lengths):
        yield at, len(lengths)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays without repeats."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
