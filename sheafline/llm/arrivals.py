"""Problem 4: new batches against everything accepted before, without reading it again.

A record's winnowed fingerprints (the smallest of each window of k-word shingle hashes) go into a
persistent store: segments by hash part, each with its sorted fingerprints, the records they come
from and a Bloom filter.  A batch is screened part by part by the Bloom filters; positives are
looked up; records that share enough fingerprints are verified on their whole texts; accepted
records are appended as new segments, filters included.

The store needs nothing beside itself: it holds the texts it accepted, in buckets by id, and the
hash of each whole word sequence, in buckets by hash, so that exact copies are found first and
without fingerprints.  A batch reads the parts and buckets it touches and no others.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import vec
from .cluster import Files, durable, map_batches, map_stream, sent_if_small, shared_dir
from .neardup import _verify, common_shingles


@dataclass(frozen=True)
class Arrivals:
    k: int = 5
    similarity: float = 0.8
    window: int = 12            # shingles a winnowing window
    short: int = 64             # records of up to this many distinct shingles are looked up with all of them
    common_share: float = 0.001 # shingles in more than this share of the history are picked last
    coverage: float = 0.25      # share of a record's fingerprints a similar one must hold to be looked up
    shared: int = 5             # of which as many (or all, if fewer) must be met among the rarest
    first: int = 2              # ... and as many of these before the more frequent of the rarest are looked up
    meets: int = 4_000_000      # meetings of a bucket of askers, about
    segment: int = 1_000_000    # entries of a segment at most
    part_entries: int = 500_000 # entries a part is laid out for
    bucket_chars: int = 16_000_000  # characters of text a bucket is laid out for
    bloom_bits: int = 12        # a fingerprint
    broadcast_ids: int = 500_000

    @property
    def full(self) -> int:
        """Records of up to this many distinct shingles are stored with all of them: any that a short one can resemble."""
        return math.ceil(max(self.short, self.window) / self.similarity)


SEGMENT = "part int, seg long, n int, fp binary, rec binary, bloom binary"


def winnow(h: np.ndarray, off: np.ndarray, window: int, short: int) -> np.ndarray:
    """Positions whose hash is the smallest of a window; all positions of short stretches."""
    n = np.diff(off)
    pick = np.zeros(len(h), dtype=bool)
    if len(h) >= window:
        view = np.lib.stride_tricks.sliding_window_view(h, window)
        at = view.argmin(1) + np.arange(len(view))
        doc = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(view))
        pick[at[doc[start] == doc[start + window - 1]]] = True
    few = np.repeat(n <= max(short, window), n)
    pick |= few
    return np.flatnonzero(pick)


def distinct(h: np.ndarray, off: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes at the positions ``at`` of each stretch, sorted, and where each stretch begins."""
    doc = np.searchsorted(off, at, "right") - 1
    order = np.lexsort((h[at], doc))
    hs, ds = h[at][order], doc[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
    hs, ds = hs[new], ds[new]
    return hs, np.searchsorted(ds, np.arange(len(off)))


def sketch(docs: DataFrame, common: np.ndarray, o: Arrivals) -> DataFrame:
    """(id, whole, nf, need, fps, kept) of each record with at least k words; shingles in ``common`` are picked last.

    ``fps`` are the nf fingerprints a record is looked up with, ``kept`` those it is stored with (null if
    the same), ``need`` how many of its nf a similar record holds: where those are all its shingles
    and the other's too, that follows from the similarity.
    """
    k = o.k
    stock = docs.sparkSession.sparkContext.broadcast(common)  # bounded by mean shingles / common_share

    def run(cols):
        ids, texts = cols["id"], cols["text"].to_pylist()
        often = stock.value
        low = np.uint64((1 << 22) - 1)
        table = np.zeros(1 << 22, dtype=bool)
        table[(often & low).astype(np.int64)] = True
        for a, b in vec.chunks(np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))):
            w = vec.Words(texts[a:b])
            h, off, _ = w.shingles(k)
            maybe = np.flatnonzero(table[(h & low).astype(np.int64)])
            maybe = maybe[np.isin(h[maybe], often)]
            h = h >> np.uint64(1)
            h[maybe] |= np.uint64(1 << 63)
            ok = np.flatnonzero(np.diff(off) > 0)
            if not len(ok):
                continue
            marks, bound = distinct(h, off, winnow(h, off, o.window, 0))
            may = np.diff(bound) <= o.full  # others have more distinct shingles than that for certain
            every, all_bound = distinct(h, off, np.flatnonzero(np.repeat(may, np.diff(off))))
            n = np.diff(all_bound)
            few, full = may & (n <= max(o.short, o.window)), may & (n <= o.full)
            some = [marks[bound[i]:bound[i + 1]].tobytes() for i in ok]
            whole = [every[all_bound[i]:all_bound[i + 1]].tobytes() if full[i] else None for i in ok]
            nf = np.where(few, n, np.diff(bound))
            need = np.ceil(nf * np.where(few, o.similarity, o.coverage) - 1e-9).astype(np.int64)
            yield {"id": ids.take(pa.array(ok + a)), "whole": vec.signed(vec.text_hashes(w)[ok]), "nf": nf[ok], "need": need[ok], "fps": [e if f else s for e, s, f in zip(whole, some, few[ok])],
                   "kept": [None if f else e for e, f in zip(whole, few[ok])]}

    return map_batches(docs.where("length(text) > 0"), run, "id long, whole long, nf int, need int, fps binary, kept binary")


def to_store(sketches: DataFrame) -> DataFrame:
    """(id, fps) of sketches, with the fingerprints they are stored with."""
    return sketches.select("id", F.coalesce("kept", "fps").alias("fps"))


def _bloom_hits(bits: np.ndarray, fp: np.ndarray) -> np.ndarray:
    size = np.uint64(len(bits) * 8)
    ok = np.ones(len(fp), dtype=bool)
    for i in range(4):
        with np.errstate(over="ignore"):
            at = vec.mix(fp.astype(np.uint64) + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15)) % size
        ok &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return ok


def _bloom(fp: np.ndarray, bits_each: int) -> np.ndarray:
    out = np.zeros(max(8, len(fp) * bits_each // 8), dtype=np.uint8)
    size = np.uint64(len(out) * 8)
    for i in range(4):
        with np.errstate(over="ignore"):
            at = vec.mix(fp.astype(np.uint64) + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15)) % size
        np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
    return out


def _pack_ids(ids: np.ndarray) -> bytes:
    base = int(ids.min())
    span = ids - base
    narrow = int(span.max()) < 2**32
    return np.array([base, narrow], dtype=np.int64).tobytes() + (span.astype(np.uint32) if narrow else span).tobytes()


def _ids(blob: bytes) -> np.ndarray:
    base, narrow = np.frombuffer(blob[:16], dtype=np.int64)
    return np.frombuffer(blob[16:], dtype=np.uint32 if narrow else np.int64).astype(np.int64) + base


def segments(sketches: DataFrame, parts: int, o: Arrivals) -> DataFrame:
    """The fingerprints of (id, fps) by hash part, in segments of bounded size, sorted."""

    def scatter(cols):
        ids = cols["id"].to_numpy()
        blobs = cols["fps"].to_pylist()
        fp = np.frombuffer(b"".join(blobs), dtype=np.uint64)
        rec = np.repeat(ids, [len(b) // 8 for b in blobs])
        part = (vec.mix(fp) >> np.uint64(33)).astype(np.int64) % parts
        order = np.argsort(part, kind="stable")
        bound = np.searchsorted(part[order], np.arange(parts + 1))
        got = np.flatnonzero(np.diff(bound))
        low = fp.astype(np.uint32)
        cut = [order[bound[p]:bound[p + 1]] for p in got]
        if len(got):
            yield {"part": got.astype(np.int32), "fp": [low[c].tobytes() for c in cut], "rec": [_pack_ids(rec[c]) for c in cut]}

    return merged(map_batches(sketches.select("id", "fps"), scatter, "part int, fp binary, rec binary"), o)


def merged(small: DataFrame, o: Arrivals) -> DataFrame:
    """Segments of bounded size from rows (part, fp, rec)."""
    most, bits = o.segment, o.bloom_bits
    arrow = to_arrow_schema(StructType.fromDDL(SEGMENT))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        part, n = None, 0

        def flush():
            fp = np.concatenate([np.frombuffer(f, dtype=np.uint32) for f, _ in held])
            rec = np.concatenate([_ids(r) for _, r in held])
            order = np.lexsort((rec, fp))
            fp, rec = fp[order], rec[order]
            seg = int(uuid.uuid4().int >> 66)
            return pa.RecordBatch.from_pylist([{"part": part, "seg": seg, "n": len(fp), "fp": fp.tobytes(), "rec": _pack_ids(rec), "bloom": _bloom(np.unique(fp), bits).tobytes()}], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["part"] != part or n >= most):
                    yield flush()
                    held, n = [], 0
                part = row["part"]
                held.append((row["fp"], row["rec"]))
                n += len(row["fp"]) // 4
        if held:
            yield flush()

    return map_stream(small.repartition("part").sortWithinPartitions("part"), merge, SEGMENT)


TABLES = {
    "segments": (SEGMENT.replace("part int, ", ""), "part"),
    "texts": ("id long, text string", "bucket"),       # of the first record of each word sequence
    "wholes": ("whole long, rep long", "bucket"),      # word sequence -> that record
    "copies": ("rep long, id long", "bucket"),         # that record -> its exact copies
}


class Store:
    """What was accepted so far, in a shared folder: segments, texts, wholes and copies.

    Each append writes new folders (gen=...) of all tables and then one numbered file of the log
    that lists the generations in force.  Readers go by the last whole log file, so an append that
    broke off leaves nothing behind but folders nobody reads; of two writers one fails.
    """

    def __init__(self, spark: SparkSession, path: str, options: Arrivals):
        self.spark, self.path, self.o = spark, path.rstrip("/"), options
        self.files = Files(spark, self.path)
        row = spark.read.parquet(f"{self.path}/layout").first()
        if "buckets" not in row:
            raise ValueError(f"store {self.path} has no texts of its own: create it anew")
        if row["full"] < options.full:
            raise ValueError(f"store {self.path} does not keep all fingerprints of records of up to {options.full} shingles: create it anew")
        self.parts, self.buckets = row["parts"], row["buckets"]
        self.common = np.frombuffer(bytes(row["common"]), dtype=np.uint64)
        self.turn, self.gens, self.done = self._state()

    def _state(self) -> tuple[int, list[str], list[str]]:
        """Number of the last whole log file, the generations in force, the batches taken in by name."""
        for name in sorted((n for n in self.files.names("log") if n.isdigit()), reverse=True):
            said = self.files.read(f"log/{name}").split("\n")
            if said[-1] == "end":
                return int(name), [x[4:] for x in said if x.startswith("gen ")], [x[5:] for x in said if x.startswith("done ")]
        return 0, [], []

    @classmethod
    def create(cls, history: DataFrame, path: str, options: Arrivals = Arrivals()) -> Store:
        """A store of ``history(id, text)``; null ids and texts of fewer than k words stay out."""
        spark = history.sparkSession
        history = history.where("id is not null").select(F.col("id").cast("long").alias("id"), "text")
        common = common_shingles(history.where("length(text) > 0"), options.k, options.common_share)
        sk = durable(sketch(history, common, options))
        entries = (to_store(sk).agg(F.sum(F.length("fps"))).first()[0] or 0) // 8  # bytes each
        chars = history.agg(F.sum(F.length("text"))).first()[0] or 0
        layout = (max(8, math.ceil(entries / options.part_entries)), max(8, math.ceil(chars / options.bucket_chars)), bytearray(common.tobytes()), options.full)
        spark.createDataFrame([layout], "parts int, buckets int, common binary, full int").write.parquet(f"{path.rstrip('/')}/layout")
        store = cls(spark, path, options)
        reps = sk.groupBy("whole").agg(F.min("id").alias("rep"))
        member = durable(sk.select("id", "whole").join(reps, "whole"))
        first = durable(member.where("id = rep").select("id", "whole"))
        own = to_store(sk.join(sent_if_small(first.select("id"), options.broadcast_ids), "id", "left_semi"))
        store.append(segments(own, store.parts, options), history, first, member)
        return store

    def bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, table: str, at: DataFrame | None = None) -> DataFrame:
        """Rows of a table in force, of the parts or buckets in the one column of ``at`` only.

        Those are numbers of folders, so the layout bounds how many the driver sees.
        """
        columns, key = TABLES[table]
        t = self.spark.read.schema(f"{columns}, gen string, {key} int").parquet(f"{self.path}/{table}").where(F.col("gen").isin(self.gens))
        if at is not None:
            touched = [r[0] for r in at.distinct().collect()]
            if len(touched) < (self.parts if key == "part" else self.buckets):
                t = t.where(F.col(key).isin(touched))
        return t.drop("gen")

    def _write(self, gen: str, table: str, df: DataFrame) -> None:
        df.write.partitionBy(TABLES[table][1]).parquet(f"{self.path}/{table}/gen={gen}")

    def _log(self, gens: list[str], done: list[str]) -> None:
        self.files.create(f"log/{self.turn + 1:012d}", "\n".join([*(f"gen {g}" for g in gens), *(f"done {d}" for d in done), "end"]))
        self.turn, self.gens, self.done = self.turn + 1, gens, done

    def append(self, seg: DataFrame, texts: DataFrame, first: DataFrame, member: DataFrame, name: str | None = None) -> None:
        """Add segments, the ``texts(id, text)`` of ``first(id, whole)``, and the other rows of ``member(id, rep)`` as copies."""
        gen = f"g{uuid.uuid4().hex}"
        self._write(gen, "segments", seg)
        own = texts.select("id", "text").join(sent_if_small(first.select("id"), self.o.broadcast_ids), "id", "left_semi")
        self._write(gen, "texts", own.withColumn("bucket", self.bucket("id")).repartition("bucket"))
        self._write(gen, "wholes", first.select("whole", F.col("id").alias("rep"), self.bucket("whole").alias("bucket")).repartition("bucket"))
        self._write(gen, "copies", member.where("id <> rep").select("rep", "id", self.bucket("rep").alias("bucket")).repartition("bucket"))
        self._log([*self.gens, gen], self.done + ([name] if name else []))

    def compact(self) -> None:
        """Put all generations together as one, then drop the folders no log file in force lists."""
        gen = f"g{uuid.uuid4().hex}"
        index = self.read("segments")
        fused = map_batches(index.select("part", "fp", "rec"), lambda cols: [{c: cols[c] for c in ("part", "fp", "rec")}], "part int, fp binary, rec binary")
        self._write(gen, "segments", merged(fused, self.o))
        for table in ("texts", "wholes", "copies"):
            self._write(gen, table, self.read(table).repartition("bucket"))
        self._log([gen], self.done)
        for table in TABLES:
            for name in self.files.names(table):
                if name.startswith("gen=") and name[4:] not in self.gens:
                    self.files.remove(f"{table}/{name}")


def _unpack(fp: bytes, rec: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(fp, dtype=np.uint32), _ids(rec)


def _ranges(start: np.ndarray, times: np.ndarray) -> np.ndarray:
    """start, start + 1, ... as many times, one range after another."""
    return np.repeat(start - np.cumsum(times) + times, times) + np.arange(int(times.sum()))


def meeting(rows: list[dict], first: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) of a bucket's lists that meet often enough, made about ``most`` at a time."""
    count = lambda name: np.concatenate([np.frombuffer(r[name], dtype=np.uint32) for r in rows]).astype(np.int64)
    asked, b = np.unique(np.concatenate([_ids(r["b"]) for r in rows]), return_inverse=True)
    held, a = np.unique(np.concatenate([_ids(r["a"]) for r in rows]), return_inverse=True)
    code = np.concatenate([np.frombuffer(r["code"], dtype=np.uint16) for r in rows])
    times, size = count("owners"), np.int64(len(held))
    group = np.repeat(np.arange(len(times)), count("askers"))
    start = np.cumsum(times) - times
    holds = np.repeat(np.arange(len(times)), times) * size + a  # sorted: owners are in order
    least = np.zeros(len(asked), dtype=np.int64)
    least[b] = code >> 1
    order = np.argsort(b, kind="stable")
    early, late = order[code[order] & 1 == 0], order[code[order] & 1 == 1]
    bound, late_bound = (np.searchsorted(b[x], np.arange(len(asked) + 1)) for x in (early, late))
    total = np.concatenate([[0], np.cumsum(times[group[early]])])[bound]
    out_a, out_b = [held[:0]], [asked[:0]]
    for s, e in vec.chunks(np.diff(total), most):
        at = early[bound[s]:bound[e]]
        n = times[group[at]]
        pair, met = np.unique(np.repeat(b[at], n) * size + a[_ranges(start[group[at]], n)], return_counts=True)
        ok = met >= np.minimum(least[pair // size], first)
        pair, met = pair[ok], met[ok]
        whose, who = pair // size, pair % size
        ok = held[who] != asked[whose]
        pair, met, whose, who = pair[ok], met[ok], whose[ok], who[ok]
        more = late_bound[whose + 1] - late_bound[whose]
        of = np.repeat(np.arange(len(pair)), more)
        found = vec.among(group[late[_ranges(late_bound[whose], more)]] * size + who[of], holds)
        met = met + np.bincount(of[found], minlength=len(pair))
        ok = met >= least[whose]
        out_a.append(held[who[ok]])
        out_b.append(asked[whose[ok]])
    return np.concatenate(out_a), np.concatenate(out_b)


def _candidates(asked: DataFrame, index: DataFrame, nf: DataFrame, o: Arrivals) -> DataFrame:
    """(a, b): records a of the index that may share enough fingerprints with the asked record b.

    Whatever a record short enough to be looked up with all its shingles can resemble is stored with
    all of its own, so F counts only what a can hold (else both sides have their winnowed marks).
    If b must find n of its F fingerprints in a, any F - n + m of them hold m
    that a has (m up to n): the rarest are looked up, those nothing else has counting among them,
    and a must come up m times.  As that holds for each m, a must come up twice among fewer of them
    (three fewer, where m is 5) before the others, which are the most frequent, are looked at.
    """
    q = durable(asked.select("part", F.col("fp").alias("qfp"), F.col("rec").alias("qrec")))

    def screen(cols):
        for part, seg, qfp, qrec, bloom in zip(*(cols[c].to_pylist() for c in ("part", "seg", "qfp", "qrec", "bloom"))):
            fp, rec = _unpack(qfp, qrec)
            got = np.flatnonzero(_bloom_hits(np.frombuffer(bloom, dtype=np.uint8), fp))
            if len(got):
                yield {"part": [part], "seg": [seg], "qfp": [fp[got].tobytes()], "qrec": [_pack_ids(rec[got])]}

    positive = durable(map_batches(q.join(index.select("part", "seg", "bloom"), "part"), screen, "part int, seg long, qfp binary, qrec binary"))

    def count(cols):
        for part, qfp, qrec, sfp in zip(*(cols[c].to_pylist() for c in ("part", "qfp", "qrec", "fp"))):
            fp, rec = _unpack(qfp, qrec)
            have = np.frombuffer(sfp, dtype=np.uint32)
            n = np.searchsorted(have, fp, "right") - np.searchsorted(have, fp, "left")
            got = np.flatnonzero(n)
            if len(got):
                yield {"part": np.full(len(got), part), "fp": fp[got].astype(np.int64), "b": rec[got], "n": n[got]}

    seen = map_batches(positive.join(index.select("part", "seg", "fp"), ["part", "seg"]), count, "part int, fp long, b long, n long").repartition("b")
    seen = seen.groupBy("b", "part", "fp").agg(F.sum("n").alias("n")).where("n > 1")  # one is b itself
    need = F.col("need")
    least = F.least(need, F.lit(o.shared))
    ranked = seen.join(nf.select(F.col("id").alias("b"), "nf", "need"), "b").withColumn(
        "rank", F.row_number().over(W.partitionBy("b").orderBy("n", "part", "fp"))).withColumn(
        "known", F.count("*").over(W.partitionBy("b")))
    from_last = F.col("known") - need - F.col("rank")
    chosen = durable(ranked.where(from_last + least >= 0).select(
        "part", "fp", "b", "n", least.alias("least"), (from_last + F.least(least, F.lit(o.first)) < 0).alias("late")))
    meets = chosen.where("not late").agg(F.sum("n")).first()[0] or 0
    return _met(chosen, index, max(1, math.ceil(meets / o.meets)), o)


def _met(chosen: DataFrame, index: DataFrame, buckets: int, o: Arrivals) -> DataFrame:
    """(a, b): records a that hold ``least`` of the fingerprints (part, fp, late) chosen of b, ``first`` of them not late.

    Owners and askers of a fingerprint go to a bucket of b as two lists, so what is moved does not
    grow with their product.  Pairs are made there, of those fingerprints that aren't late; the late ones
    are the most frequent, and are looked up only for pairs that met often enough before.
    """
    chosen = chosen.repartition("part").sortWithinPartitions("part")

    def pack(cols):
        part, fp, b, least, late = (cols[c].to_numpy(zero_copy_only=False) for c in ("part", "fp", "b", "least", "late"))
        for p in np.unique(part):
            at = np.flatnonzero(part == p)
            yield {"part": [int(p)], "qfp": [fp[at].astype(np.uint32).tobytes()], "qrec": [_pack_ids(b[at])], "code": [(least[at] * 2 + late[at]).astype(np.uint16).tobytes()]}

    packed = map_batches(chosen, pack, "part int, qfp binary, qrec binary, code binary")

    def post(cols):
        for qfp, qrec, code, sfp, srec in zip(*(cols[c].to_pylist() for c in ("qfp", "qrec", "code", "fp", "rec"))):
            fp, rec = _unpack(qfp, qrec)
            have, owner = _unpack(sfp, srec)
            kind = np.frombuffer(code, dtype=np.uint16)
            lo, hi = np.searchsorted(have, fp, "left"), np.searchsorted(have, fp, "right")
            bucket = (vec.mix(rec.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % buckets
            got = np.flatnonzero(hi > lo)
            got = got[np.lexsort((fp[got], bucket[got]))]
            for at in np.split(got, np.flatnonzero(np.diff(bucket[got])) + 1) if len(got) else []:
                new = np.flatnonzero(np.diff(fp[at].astype(np.int64), prepend=-1))  # askers of one fingerprint stand together
                start, times = lo[at[new]], hi[at[new]] - lo[at[new]]
                yield {"bucket": [int(bucket[at[0]])], "b": [_pack_ids(rec[at])], "code": [kind[at].tobytes()], "askers": [np.diff(np.append(new, len(at))).astype(np.uint32).tobytes()],
                       "a": [_pack_ids(owner[_ranges(start, times)])], "owners": [times.astype(np.uint32).tobytes()]}

    lists = map_batches(packed.join(index.select("part", "fp", "rec"), "part"), post, "bucket int, b binary, code binary, askers binary, a binary, owners binary")
    arrow = to_arrow_schema(StructType.fromDDL("a long, b long"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in meeting(held, o.first, o.meets)], schema=arrow)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in meeting(held, o.first, o.meets)], schema=arrow)

    return map_stream(lists.repartition("bucket").sortWithinPartitions("bucket"), meet, "a long, b long")


def ingest(store: Store, batch: DataFrame, id_col: str, batch_col: str, text_col: str, name: str | None = None) -> DataFrame:
    """(accepted_id, rec_id): each rejected record with each accepted one it resembles; the store is updated.

    ``batch`` may hold several batches; records are taken by batch, then id (null batches first).
    A record is rejected if its similarity to a stored or earlier accepted record reaches the
    threshold.  Records with null id are left out; those with fewer than k words are accepted and
    match nothing.  Exact copies are decided together, the earliest speaking for them; those of
    stored records are known by the hash of their words before any fingerprint is looked up.  With
    a ``name`` a batch taken in already is refused, so a job may be tried again.
    """
    o = store.o
    if name and name in store.done:
        raise ValueError(f"batch {name} is in store {store.path} already")
    docs = batch.select(batch[id_col].cast("long").alias("id"), batch[batch_col].alias("batch"), batch[text_col].alias("text")).where("id is not null")
    when = docs.select("id", F.struct("batch", "id").alias("at"))
    sk = durable(sketch(docs.select("id", "text"), store.common, o))
    timed = durable(sk.select("id", "whole").join(when, "id"))
    speaks = timed.groupBy("whole").agg(F.min_by("id", "at").alias("rep"))
    member = durable(timed.join(speaks, "whole").select("id", "at", "rep", "whole"))
    first = durable(member.where("id = rep").select("id", "at", "whole"))
    reps = durable(sk.join(first.select("id"), "id", "left_semi"))
    same = durable(store.read("wholes", first.select(store.bucket("whole"))).join(first.select("id", "whole"), "whole").select(F.col("rep").alias("a"), F.col("id").alias("b")))
    own = durable(segments(to_store(reps), store.parts, o))
    asked = durable(segments(reps, store.parts, o).select("part", "fp", "rec"))
    index = store.read("segments", asked.select("part")).select(*own.columns).union(own)
    pairs = durable(_candidates(asked, index, reps.select("id", "nf", "need"), o))
    new_ids = first.select(F.col("id").alias("a"), F.lit(True).alias("new"), F.col("at").alias("at_a"))
    told = pairs.join(new_ids, "a", "left").join(first.select(F.col("id").alias("b"), F.col("at").alias("at_b")), "b")
    late = F.coalesce(F.col("at_a") > F.col("at_b"), F.lit(False))  # met from the earlier record's side
    told = told.select(F.when(late, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(late, F.col("a")).otherwise(F.col("b")).alias("b"),
                       F.col("new").isNull().alias("old")).distinct()
    wanted = durable(told.join(same, ["a", "b"], "left_anti"))
    stored = wanted.where("old").select(store.bucket("a"))
    texts = docs.select("id", "text").union(store.read("texts", stored).select("id", "text"))
    close = _verify(wanted.select("a", "b"), texts, o.k, o.similarity, o.broadcast_ids, "left").select("a", "b").union(same)
    close = durable(close.join(new_ids, "a", "left"))

    against_old = close.where("new is null").select("b").distinct()
    edges = durable(close.where("new").join(against_old, "b", "left_anti").join(
        against_old.select(F.col("b").alias("a")), "a", "left_anti").select("a", "b"))
    rejected = against_old
    while not edges.isEmpty():  # whoever has no earlier rival left is accepted, and rejects those after it
        ok = durable(edges.select("a").distinct().join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti"))
        out = durable(edges.join(ok, "a", "left_semi").select("b").distinct())
        rejected = rejected.union(out)
        edges = durable(edges.join(out, "b", "left_anti").join(out.select(F.col("b").alias("a")), "a", "left_anti").join(ok, "a", "left_anti"))
    rejected = durable(rejected.distinct())

    rep_ok = durable(first.join(rejected.select(F.col("b").alias("id")), "id", "left_anti").select(F.col("id").alias("rep"), F.col("at").alias("at_a")))
    copies = member.where("id <> rep").join(rep_ok.select("rep"), "rep", "left_semi").select(F.col("rep").alias("accepted_id"), F.col("id").alias("rec_id"))
    lost = durable(member.join(rejected.select(F.col("b").alias("rep")), "rep", "left_semi").select("id", "at", "rep"))
    hit = durable(close.where("new is null").select("a", F.col("b").alias("rep")))
    again = store.read("copies", hit.select(store.bucket("a"))).select(F.col("rep").alias("a"), F.col("id").alias("accepted_id"))
    by_old = hit.select("rep", F.col("a").alias("accepted_id")).union(hit.join(again, "a").select("rep", "accepted_id"))
    by_old = by_old.join(lost, "rep").select("accepted_id", F.col("id").alias("rec_id"))
    both = close.where("new").select("a", "b").union(close.where("new").select(F.col("b").alias("a"), F.col("a").alias("b")))
    by_new = both.select("a", F.col("b").alias("rep")).join(rep_ok.select(F.col("rep").alias("a"), "at_a"), "a").join(lost, "rep").where(
        "at_a < at").select(F.col("a").alias("accepted_id"), F.col("id").alias("rec_id"))
    result = durable(copies.union(by_old).union(by_new))
    keep = durable(first.join(rep_ok.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "whole"))
    store.append(segments(to_store(reps.join(keep.select("id"), "id", "left_semi")), store.parts, o), docs, keep, keep.select("id", F.col("id").alias("rep")), name)
    return result


def fresh_store_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/fingerprints-{uuid.uuid4().hex}"
