"""Problem 7: containers of fixed capacity filled with lexically near items.

Items are texts, or the capacity-sized parts of a text that alone exceeds a container.  Items are
laid out in the order of a min-hash of their weightier terms and cut into shards of a bounded number, so that
lexical neighbours share a shard however many shards there are.  Each builds a BM25 inverted index;
the largest unused item seeds a container, its nearest unused neighbours fill it greedily, and what
then remains goes to the largest unused items that fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import vec
from .cluster import durable, map_batches, map_stream, own_names
from .tokens import DEFAULT_VOCABULARY, char_ends, encode, send_vocabulary


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    shard_items: int = 4096     # items a shard is laid out for
    features: int = 1 << 16     # words are hashed to so many terms
    k1: float = 1.2
    b: float = 0.75
    vocabulary: str = DEFAULT_VOCABULARY


def _terms(text: str, features: int) -> tuple[np.ndarray, np.ndarray]:
    h = vec.Words([text]).hashes
    return np.unique((h >> np.uint64(40)).astype(np.int64) % features, return_counts=True)


def items_of(df: DataFrame, id_col: str, text_col: str, o: Packing) -> DataFrame:
    """(id, part, n_tokens, start_char, end_char, terms, counts): one row an item."""

    def run(cols) -> Iterator[dict]:
        out = {k: [] for k in ("id", "part", "n_tokens", "start_char", "end_char", "terms", "counts")}
        ids, texts = cols["id"].to_pylist(), cols["text"].to_pylist()
        for s, e in vec.chunks(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))):
            w = vec.Words(texts[s:e])
            term = (w.hashes >> np.uint64(40)).astype(np.int64) % o.features
            for i in range(s, e):
                t = texts[i]
                tok = encode(t, o.vocabulary)
                if len(tok) <= o.capacity:
                    parts = [(0, len(tok), 0, len(t))]
                else:
                    ends, inside = char_ends(t, tok, o.vocabulary)
                    parts, at, c = [], 0, 0
                    while at < len(tok):
                        to = min(len(tok), at + o.capacity)
                        while to < len(tok) and inside[to - 1]:
                            to -= 1
                        parts.append((at, to, c, int(ends[to - 1])))
                        at, c = to, int(ends[to - 1])
                for n, (a, b, c0, c1) in enumerate(parts):
                    if len(parts) == 1:
                        u, k = np.unique(term[w.offsets[i - s]:w.offsets[i - s + 1]], return_counts=True)
                    else:
                        u, k = _terms(t[c0:c1], o.features)
                    for key, v in zip(out, (ids[i], n, b - a, c0, c1, u.astype(np.uint16 if o.features <= 65536 else np.uint32).tobytes(), k.astype(np.uint32).tobytes())):
                        out[key].append(v)
            yield out
            out = {k: [] for k in out}

    send_vocabulary(df.sparkSession, o.vocabulary)
    docs = own_names(df, id=id_col, text=text_col).where("id is not null and length(text) > 0").withColumn("id", F.col("id").cast("long"))
    return map_batches(docs, run, ITEM)


def _unpack(terms: list[bytes], counts: list[bytes], wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = np.frombuffer(b"".join(terms), dtype=np.uint32 if wide else np.uint16).astype(np.int64)
    c = np.frombuffer(b"".join(counts), dtype=np.uint32).astype(np.float32)
    off = np.concatenate([[0], np.cumsum([len(x) // 4 for x in counts])]).astype(np.int64)
    return t, c, off


def fill(size: np.ndarray, t: np.ndarray, c: np.ndarray, off: np.ndarray, idf: np.ndarray, avg: float, o: Packing) -> np.ndarray:
    """Container number of each item of one shard."""
    n = len(size)
    length = np.add.reduceat(np.concatenate([c, [0]]), off[:-1]) * (np.diff(off) > 0) if n else np.zeros(0)
    doc = np.repeat(np.arange(n), np.diff(off))
    weight = idf[t] * c * (o.k1 + 1) / (c + o.k1 * (1 - o.b + o.b * length[doc] / max(avg, 1e-9)))
    order = np.argsort(t, kind="stable")
    pt, pd, pw = t[order], doc[order], weight[order]
    lo = np.searchsorted(pt, np.arange(o.features))
    hi = np.searchsorted(pt, np.arange(o.features), "right")
    where = np.full(n, -1, dtype=np.int64)
    by_size = np.lexsort((np.arange(n), size))
    rank = np.empty(n, dtype=np.int64)
    rank[by_size] = np.arange(n)
    sorted_size = size[by_size]
    prev = np.arange(-1, n)  # prev[i + 1]: largest unused rank <= i, with path halving

    def free(i: int) -> int:
        j = i + 1
        while prev[j] != j - 1:
            prev[j] = prev[prev[j] + 1]
            j = prev[j] + 1
        return j - 1

    def take(i: int, box: int) -> None:
        where[i] = box
        prev[rank[i] + 1] = rank[i] - 1

    box = 0
    while True:
        top = free(n - 1)
        if top < 0:
            return where
        seed = int(by_size[top])
        take(seed, box)
        room = o.capacity - int(size[seed])
        terms = t[off[seed]:off[seed + 1]]
        terms = terms[idf[terms] > 0]
        if room > 0 and len(terms):
            m = hi[terms] - lo[terms]
            at = np.repeat(lo[terms], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            score = np.bincount(pd[at], weights=pw[at], minlength=n)
            score[where >= 0] = 0
            near = np.flatnonzero(score > 0)
            # Small items are the mortar of the last gaps: near ones are taken while half the gap stays open for them.
            for i in near[np.lexsort((near, -score[near]))]:
                if size[i] <= room and (size[i] * 4 >= room or room > o.capacity // 8):
                    take(int(i), box)
                    room -= int(size[i])
                    if room < o.capacity // 16:
                        break
        while room > 0:
            i = free(int(np.searchsorted(sorted_size, room, "right")) - 1)
            if i < 0:
                break
            take(int(by_size[i]), box)
            room -= int(sorted_size[i])
        box += 1


def pack(df: DataFrame, id_col: str, text_col: str, options: Packing = Packing()) -> DataFrame:
    """(container, id, part, n_tokens, start_char, end_char): every item placed in exactly one container.

    No item is divided unless it alone exceeds the capacity; then all parts but the last are full
    (short of it only where the cut would fall inside a character).  Document frequencies and the
    mean length are taken over all items.  Null ids and null or empty texts are not placed.
    """
    o = options
    items = durable(items_of(df, id_col, text_col, o))
    wide = o.features > 65536

    def freq(cols):
        t, _, _ = _unpack(cols["terms"].to_pylist(), cols["counts"].to_pylist(), wide)
        u, n = np.unique(t, return_counts=True)
        yield {"term": u, "n": n}

    total = items.agg(F.count("*"), F.sum(F.length("counts"))).first()
    n_items = total[0]
    df_rows = map_batches(items.select("terms", "counts"), freq, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    idf = np.zeros(o.features)
    for r in df_rows.collect():  # o.features rows at most
        idf[r["term"]] = max(0.0, math.log((n_items - r["n"] + 0.5) / (r["n"] + 0.5)))
    avg = (total[1] or 0) / 4 / max(1, n_items)
    held = items.sparkSession.sparkContext.broadcast(idf)  # o.features numbers
    names = ("id", "part", "n_tokens", "start_char", "end_char", "terms", "counts")

    def place(cols):
        t, c, off = _unpack(cols["terms"].to_pylist(), cols["counts"].to_pylist(), wide)
        yield {"place": telling(t, c, off, held.value)} | {n: cols[n] for n in names}

    placed = map_batches(items, place, "place long, " + ITEM)
    shards = max(1, math.ceil(n_items / o.shard_items))
    arrow = to_arrow_schema(StructType.fromDDL(PLACED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        tb = pa.Table.from_batches(got)
        size = tb["n_tokens"].to_numpy().astype(np.int64)
        t, c, off = _unpack(tb["terms"].to_pylist(), tb["counts"].to_pylist(), wide)
        name = tb["shard"].to_numpy().astype(np.int64) * (1 << 32) + fill(size, t, c, off, held.value, avg, o)
        yield pa.RecordBatch.from_arrays([pa.array(name), *[tb[x].combine_chunks() for x in names[:5]]], schema=arrow)

    # A task is a shard: ranges of the order hold about as many items each, a hot term's being cut by id.
    ranged = placed.repartitionByRange(shards, "place", "id", "part").sortWithinPartitions("place", "id", "part")
    return map_stream(ranged.withColumn("shard", F.spark_partition_id()), run, PLACED)


ITEM = "id long, part int, n_tokens int, start_char int, end_char int, terms binary, counts binary"
PLACED = "container long, id long, part int, n_tokens int, start_char int, end_char int"


def telling(t: np.ndarray, c: np.ndarray, off: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A number for each item: the two smallest hashes among the weightier half of its terms (tf-idf), so that like items have like numbers."""
    n = len(off) - 1
    out = np.zeros(n, dtype=np.int64)
    size = np.diff(off)
    doc = np.repeat(np.arange(n), size)
    order = np.lexsort((t, -np.minimum(c, 8.0) * idf[t], doc))
    rank = np.empty(len(t), dtype=np.int64)
    rank[order] = np.arange(len(t)) - np.repeat(off[:-1], size)
    kept = np.flatnonzero(2 * rank < size[doc])
    h = (vec.mix(t[kept].astype(np.uint64)) >> np.uint64(33)).astype(np.int64)
    order = np.lexsort((h, doc[kept]))
    h, d = h[order], doc[kept][order]
    at = np.flatnonzero(np.diff(d, prepend=-1))
    last = np.append(at[1:], len(d)) - 1
    out[d[at]] = (h[at] << 31) + h[np.minimum(at + 1, last)] if len(at) else 0
    return out
