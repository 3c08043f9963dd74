"""Problem 8: evaluation texts inside the corpus.

Windows of the corpus at every position, and of every item at every position, are walked through a
CGK embedding: at each step the walk writes the word it stands on and moves on or stays by a random
bit of that word and step, so windows a few edits apart write mostly the same words at the same
steps.  Each repetition samples some steps and hashes what was written there; windows that agree
are candidates and are verified word by word.  Windows are ``run`` words long or, for edited
copies, as long as the item: its largest size of run, 2 run, 4 run, ... words.  How many walks and
samples a size takes is measured beforehand on made pairs the full number of edits apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .cluster import map_batches, own_names


@dataclass(frozen=True)
class Leak:
    run: int = 12                   # words of a window, at least
    max_edits: int = 0              # word edits within which a window of ``run`` words still counts; longer ones in proportion
    item_sized: bool = False        # windows as long as the item, else of ``run`` words
    sampled: int = 5                # sampled steps a repetition
    samples: int = 8                # repetitions a walk (one if nothing may be edited)
    recall: float = 0.99            # for windows the full number of edits apart
    made_pairs: int = 3000          # on which repetitions are measured
    block_windows: int = 2_000_000  # item windows held in memory at once; more make further passes
    seed: int = 5


Plan = tuple[int, list[list[int]]]  # of a walk: its seed and the steps sampled by each repetition


def made_pairs(words: np.ndarray, size: int, edits: int, o: Leak) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``size`` words and others made of them exactly ``edits`` edits away, as rows of word hashes."""
    rng = np.random.default_rng(o.seed)
    left, right, have = [], [], 0
    while have < o.made_pairs:
        n = o.made_pairs
        span = size + 2 * edits
        if len(words) > 4 * span:
            rows = words[rng.integers(0, len(words) - span, n)[:, None] + np.arange(span)]
        else:
            rows = rng.integers(1, 2**62, (n, span)).astype(np.uint64)
        a, b = rows[:, :size], rows.copy()
        for _ in range(edits):
            at, kind = rng.integers(0, size, n)[:, None], rng.integers(0, 3, n)[:, None]
            new = rng.integers(1, 2**62, (n, 1)).astype(np.uint64)
            i = np.arange(span)[None, :]
            put = np.where(i == at, new, np.where(i > at, np.take_along_axis(b, np.maximum(i - 1, 0) + 0 * at, 1), b))
            cut = np.where(i >= at, np.take_along_axis(b, np.minimum(i + 1, span - 1) + 0 * at, 1), b)
            b = np.where(kind == 0, np.where(i == at, new, b), np.where(kind == 1, put, cut))
        b = b[:, :size]
        ok = distance_within(a, b, edits) & ~distance_within(a, b, edits - 1)
        left.append(a[ok])
        right.append(b[ok])
        have += int(ok.sum())
    return np.concatenate(left)[:o.made_pairs], np.concatenate(right)[:o.made_pairs]


def plans(words: np.ndarray, size: int, edits: int, o: Leak) -> list[Plan]:
    """Walks with their samples: one if nothing may be edited, else as many as reach the recall on made pairs."""
    rng = np.random.default_rng(o.seed)
    one = lambda n: (int(rng.integers(1, 2**62)), [sorted(rng.choice(2 * size, o.sampled, replace=False).tolist()) for _ in range(n)])
    if edits == 0:
        return [one(1)]
    a, b = made_pairs(words, size, edits, o)
    target = min(1.0, o.recall + 3 * math.sqrt(o.recall * (1 - o.recall) / len(a)))  # three standard errors above
    first = np.arange(len(a)) * size
    met, out = np.zeros(len(a), dtype=bool), []
    while met.mean() < target:
        out.append(one(o.samples))
        for x, y in zip(walk_keys(a.ravel(), first, size, out[-1]), walk_keys(b.ravel(), first, size, out[-1])):
            met |= x == y
    return out


def walk_keys(words: np.ndarray, first: np.ndarray, size: int, plan: Plan) -> list[np.ndarray]:
    """LSH keys of each window ``words[first : first + size]``: the sampled steps of its CGK walk, by repetition."""
    seed, sets = plan
    bits = vec.mix(words ^ np.uint64(seed))
    padded_w = np.concatenate([words, np.zeros(1, dtype=np.uint64)])
    padded_b = np.concatenate([bits, np.zeros(1, dtype=np.uint64)])
    at, end = first.astype(np.int64).copy(), first.astype(np.int64) + size
    keys = [np.full(len(first), (seed + n) % 2**62, dtype=np.uint64) for n in range(len(sets))]
    with np.errstate(over="ignore"):
        for j in range(max(s[-1] for s in sets) + 1):
            here = np.minimum(at, len(words))
            who = [n for n, s in enumerate(sets) if j in s]
            if who:
                w = np.where(at < end, padded_w[here], np.uint64(0))
                for n in who:
                    keys[n] = (keys[n] ^ w) * np.uint64(0x9E3779B97F4A7C15)
                    keys[n] ^= keys[n] >> np.uint64(31)
            at += ((padded_b[here] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    return keys


def distance_within(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """For each row whether two word sequences of one length are within ``most`` edits: a banded dynamic programme over all rows at once."""
    n, size = a.shape
    if most < 0:
        return np.zeros(n, dtype=bool)
    if most == 0:
        return (a == b).all(1)
    far = np.int32(10**6)
    prev = np.full((n, 2 * most + 3), far, dtype=np.int32)  # column 1 + most + j - i, a guard on either side
    prev[:, 1 + most:2 + 2 * most] = np.arange(most + 1)
    for i in range(1, size + 1):
        cur = np.full_like(prev, far)
        for c in range(1, 2 * most + 2):
            j = i + c - 1 - most
            if j < 0 or j > size:
                continue
            best = np.minimum(prev[:, c + 1], cur[:, c - 1]) + 1
            if j:
                best = np.minimum(best, prev[:, c] + (a[:, i - 1] != b[:, j - 1]))
            cur[:, c] = best
        prev = cur
    return prev[:, 1 + most] <= most


def leaks(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, options: Leak = Leak()) -> DataFrame:
    """Distinct (doc_id, item_id): the document contains ``run`` consecutive words of the item.

    With ``max_edits`` they may be that many word edits apart; with ``item_sized`` windows grow with
    the item, and the edits allowed with them.  Items shorter than ``run`` words, null ids and null or empty texts match nothing.  Repeated
    texts on either side give a row for each id.  The items are the query set: they are taken in
    blocks of a bounded number of windows, each block against all documents.
    """
    o = options
    it = own_names(items, id=item_id, text=item_text).where("id is not null and length(text) > 0")
    corpus = own_names(docs, id=doc_id, text=doc_text).where("id is not null and length(text) > 0")
    windows = it.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    blocks = max(1, math.ceil(windows / o.block_windows))
    out = None
    for n in range(blocks):
        part = it if blocks == 1 else it.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n)
        found = _block(corpus, part, o)
        out = found if out is None else out.union(found)
    return out.distinct().select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def _sizes(n: np.ndarray, o: Leak) -> np.ndarray:
    """Words of the windows of items of n words; 0 for items too short for any."""
    if not o.item_sized:
        return np.where(n >= o.run, o.run, 0)
    return np.where(n >= o.run, o.run * 2 ** np.floor(np.log2(np.maximum(n, o.run) / o.run)).astype(np.int64), 0)


def _block(corpus: DataFrame, items: DataFrame, o: Leak) -> DataFrame:
    rows = items.select("id", "text").collect()
    w = vec.Words([r["text"] for r in rows])
    length = np.diff(w.offsets)
    sizes = _sizes(length, o)
    index = []
    for size in sorted(set(sizes.tolist()) - {0}):
        n = np.where(sizes == size, length - size + 1, 0)
        first = np.arange(n.sum()) + np.repeat(w.offsets[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        owner = np.repeat(np.array([r["id"] for r in rows], dtype=np.int64), n)
        edits = o.max_edits * size // o.run
        ways = []
        for plan in plans(w.hashes, size, edits, o):
            held = []
            for key in walk_keys(w.hashes, first, size, plan):
                order = np.argsort(key, kind="stable")
                bitmap = np.zeros(1 << 22, dtype=bool)
                bitmap[(key >> np.uint64(42)).astype(np.int64)] = True
                held.append((key[order], order, np.packbits(bitmap)))
            ways.append((plan, held))
        index.append((size, edits, first, owner, ways))
    sent = corpus.sparkSession.sparkContext.broadcast((w.hashes, index))  # block_windows at most

    def scan(cols) -> Iterator[dict]:
        iw, index = sent.value
        ids, texts = cols["id"].to_numpy(), cols["text"].to_pylist()
        for s, e in vec.chunks(np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))):
            w = vec.Words(texts[s:e])
            for size, edits, ifirst, iowner, ways in index:
                n = np.maximum(np.diff(w.offsets) - size + 1, 0)
                off = np.concatenate([[0], np.cumsum(n)])
                if not off[-1]:
                    continue
                start = np.arange(off[-1]) + np.repeat(w.offsets[:-1] - off[:-1], n)
                hits = []
                for plan, held in ways:
                    for key, (keys, order, packed) in zip(walk_keys(w.hashes, start, size, plan), held):
                        at = (key >> np.uint64(42)).astype(np.int64)
                        maybe = np.flatnonzero((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
                        lo, hi = np.searchsorted(keys, key[maybe], "left"), np.searchsorted(keys, key[maybe], "right")
                        m = hi - lo
                        if m.sum():
                            pos = np.repeat(lo, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                            hits.append(np.repeat(maybe, m) * len(ifirst) + order[pos])
                if not hits:
                    continue
                met = np.unique(np.concatenate(hits)) if len(hits) > 1 else hits[0]
                same = np.zeros(len(met), dtype=bool)
                for x in range(0, len(met), 100_000):  # verified in steps of bounded memory
                    c, q = met[x:x + 100_000] // len(ifirst), met[x:x + 100_000] % len(ifirst)
                    step = np.arange(size)
                    same[x:x + 100_000] = distance_within(w.hashes[start[c][:, None] + step], iw[ifirst[q][:, None] + step], edits)
                met = met[same]
                doc = np.searchsorted(off, met // len(ifirst), "right") - 1
                pair = np.unique(np.stack([ids[s + doc], iowner[met % len(ifirst)]], 1), axis=0)
                if len(pair):
                    yield {"doc": pair[:, 0], "item": pair[:, 1]}

    return map_batches(corpus, scan, "doc long, item long")
