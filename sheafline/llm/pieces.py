"""Problem 9: oversized texts cut at natural boundaries, with overlap.

Each text becomes a string of one mark a token, saying what kind of boundary follows it.  A regular
expression with bounded quantifiers eats marks up to the limit: its alternatives stand in order of
boundary strength, the last one takes any character boundary.  SQL array functions turn the eaten
lengths into offsets, look back for the overlap and cut the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec
from .cluster import map_batches, own_names
from .tokens import DEFAULT_VOCABULARY, byte_length, char_ends, encode, send_vocabulary

#: Marks, strongest first: paragraph, line, sentence, clause, word, character; '-' is inside a character.
MARKS = "PLSCWx"


_SETS = {1: "\t\n\x0b\x0c\r \xa0\u2028\u2029", 2: "\n\x0c\r\u2028\u2029", 4: ".!?…。！？", 8: ",;:–—，；：", 16: "\"')]»”’"}
_KINDS = np.zeros(0x10000, dtype=np.uint8)  # white space, line break, sentence end, clause end, closing sign, by bit
for _bit, _chars in _SETS.items():
    for _c in _chars:
        _KINDS[ord(_c)] |= _bit


def boundary_marks(texts: list[str], ends: list[np.ndarray], inside: list[np.ndarray]) -> list[str]:
    """For each text one mark a token for the boundary at its end.

    The texts are looked at together, a sign between them that is neither space nor punctuation.
    """
    c = vec.codepoints("\x01".join(texts) + "\x01")
    n = len(c)
    base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    counts = [len(x) for x in ends]
    kind = _KINDS[np.minimum(c, 0xFFFF)]
    space, brk, stop, clause, close = (kind & b > 0 for b in (1, 2, 4, 8, 16))
    at = lambda a, i: np.where((i >= 0) & (i < n), a[np.clip(i, 0, max(n - 1, 0))], False)
    # Position of the last character that is no space, and the line breaks since.
    solid = np.concatenate([[-1], np.maximum.accumulate(np.where(space, -1, np.arange(n)))])
    feed = brk & (c != 0x2028)
    cr = np.flatnonzero(c == 13)
    feed[cr[(cr + 1 < n) & (c[np.minimum(cr + 1, n - 1)] == 10)]] = False  # of CR LF only the second counts
    feeds = np.concatenate([[0], np.cumsum(feed)])
    e = np.concatenate([x + b for x, b in zip(ends, base)])
    last = solid[e]
    breaks = feeds[e] - feeds[np.maximum(last + 1, 0)]
    before_space, after_space = at(space, e - 1), at(space, e)
    ff = at(c == 12, e - 1)
    inner = np.where(at(close, last) & at(stop, last - 1), last - 1, last)
    gap = before_space | after_space
    marks = np.full(len(e), ord("x"), dtype=np.uint8)
    marks[gap] = ord("W")
    marks[gap & at(clause, last)] = ord("C")
    marks[gap & at(stop, inner)] = ord("S")
    open_line = ~at(brk, e)  # the last of a run of line breaks is the boundary
    marks[(breaks >= 1) & before_space & open_line] = ord("L")
    marks[((breaks >= 2) | ff) & before_space & open_line] = ord("P")
    marks[np.concatenate(inside)] = ord("-")
    whole = marks.tobytes().decode("ascii")
    cut = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return [whole[a:b] for a, b in zip(cut, cut[1:])]


def cut_pattern(size: int) -> str:
    """Alternatives by boundary strength within ``size`` marks: first those that fill at least half."""
    half = max(1, size // 2)
    full = [f".{{{half - 1},{size - 1}}}{m}" for m in MARKS[:4]]
    short = [f".{{0,{size - 1}}}{m}" for m in MARKS[:1]] if size < 8 else []
    return "|".join([f".{{1,{size}}}$", *full, f".{{{half - 1},{size - 1}}}W", *short, f".{{0,{size - 1}}}[{MARKS[:5]}]", f".{{0,{size - 1}}}x", f".{{1,{size}}}"])


def split_pieces(df: DataFrame, id_col: str, text_col: str, limit: int = 512, overlap: int = 64, vocabulary: str = DEFAULT_VOCABULARY, keep_small: bool = False) -> DataFrame:
    """(id, piece_no, start_char, end_char, n_tokens, overlap_tokens, piece), pieces counted from 1.

    Texts of more than ``limit`` tokens come out as pieces of at most ``limit``; each starts
    ``overlap`` tokens before the end of the one before (fewer only where that would fall inside
    a character) and ends at the strongest boundary that leaves it at least half full: paragraph,
    line, sentence, clause, word; failing all, any such boundary, then between characters.
    ``limit`` must exceed ``overlap`` by 8 at least.  Texts within the limit are left out, or come
    as one piece with ``keep_small``.  Null ids and null or empty texts give no piece.  Repeated
    ids give pieces of each row.
    """
    if limit < overlap + 8 or overlap < 0:
        raise ValueError("limit must exceed overlap by 8 at least")

    def mark(cols) -> Iterator[dict]:
        ids, texts = cols["id"].to_pylist(), cols["text"].to_pylist()
        for s, e in vec.chunks(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)), 2_000_000):
            own, text, ends, inside = [], [], [], []
            for i, t in zip(ids[s:e], texts[s:e]):
                if not keep_small and (len(t) * 4 <= limit or byte_length(t) <= limit):  # a token has a byte at least
                    continue
                tok = encode(t, vocabulary)
                if len(tok) <= limit and not keep_small:
                    continue
                at, mid = char_ends(t, tok, vocabulary)
                for kept, x in ((own, i), (text, t), (ends, at), (inside, mid)):
                    kept.append(x)
            if own:
                off = np.concatenate([[0], np.cumsum([len(x) for x in ends])]).astype(np.int32)
                yield {"id": own, "text": text, "marks": boundary_marks(text, ends, inside),
                       "ends": pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(ends).astype(np.int32)))}

    send_vocabulary(df.sparkSession, vocabulary)
    docs = own_names(df, id=id_col, text=text_col).where("id is not null and length(text) > 0")
    marked = map_batches(docs.withColumn("id", F.col("id").cast("long")), mark, "id long, text string, marks string, ends array<int>")
    size = limit - overlap
    ends, blocks, marks = F.col("ends"), _blocks(F.col("text")), _blocks(F.col("marks"))
    eaten = F.transform(F.regexp_extract_all("marks", F.lit(f"({cut_pattern(size)})"), F.lit(1)), F.length)
    one = F.when(F.length("marks") <= limit, F.array(F.length("marks"))).otherwise(eaten)

    def piece(sums, blocks, marks, i):
        upto, begin = F.get(sums, i), F.when(i == 0, F.lit(0)).otherwise(F.get(sums, i - 1))
        inside = lambda at: F.substr(F.get(marks, F.floor((at - 1) / BLOCK).cast("int")), F.pmod(at - 1, F.lit(BLOCK)) + 1, F.lit(1)) == "-"
        back = F.greatest(F.lit(0), begin - overlap)
        for _ in range(3):  # a character has four bytes at most
            back = F.when((back > 0) & inside(back), back + 1).otherwise(back)
        c0 = lambda b: F.when(b == 0, F.lit(0)).otherwise(F.get(ends, b - 1))
        return _let(back, lambda b: _let(F.struct(c0(b).alias("c0"), F.get(ends, upto - 1).alias("c1")), lambda c: F.struct(
            (i + 1).alias("piece_no"), c["c0"].alias("start_char"), c["c1"].alias("end_char"), (upto - b).alias("n_tokens"), (begin - b).alias("overlap_tokens"),
            _cut(blocks, c["c0"], c["c1"]).alias("piece"))))

    pieces = _let(_let(one, lambda n: _running(n)), lambda sums: _let(F.struct(blocks.alias("text"), marks.alias("marks")), lambda x: F.transform(
        F.sequence(F.lit(0), F.size(sums) - 1), lambda i: piece(sums, x["text"], x["marks"], i))))
    return marked.select("id", F.inline(pieces))


BLOCK = 4096


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(text: Column) -> Column:
    """A text in blocks of BLOCK characters: where a character is, is then known without counting from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{BLOCK}}})"), F.lit(1))


def _cut(blocks: Column, c0: Column, c1: Column) -> Column:
    """The characters from c0 up to c1."""
    b0, b1 = F.floor(c0 / BLOCK).cast("int"), F.floor((c1 - 1) / BLOCK).cast("int")
    return F.substr(F.array_join(F.slice(blocks, b0 + 1, b1 - b0 + 1), ""), c0 - b0 * BLOCK + 1, c1 - c0)


def _running(x: Column, step: int = 64) -> Column:
    """Running sums of an array: within runs of ``step``, on top of the running sums of the runs."""
    add = lambda acc, v: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + v))
    sums = lambda a: F.aggregate(a, F.array().cast("array<int>"), add)
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / step).cast("int")), lambda k: sums(F.slice(x, k * step + 1, step)))
    return _let(runs, lambda r: _let(sums(F.transform(r, lambda a: F.element_at(a, -1))), lambda total: F.flatten(
        F.zip_with(r, total, lambda a, t: F.transform(a, lambda v: v + t - F.element_at(a, -1))))))
