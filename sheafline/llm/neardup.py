"""Problem 3: sets of near-duplicate records (generalised pigeonhole over min-hash codes).

A record's code is ``symbols`` weighted min-hash values of its k-word shingles, 16 bits each.  The
bits of one value agree or differ together, and values that agree together on unrelated records
(both picked the same stock phrase) are put into one partition.  Each partition has a threshold:
-1 (not probed), 0 (all its values equal) or 1 (all but one).  Any pair whose codes differ in
fewer values than the sum of (threshold + 1) meets in a partition for certain; beyond that radius
a pair meets with a probability that follows from its similarity.  A dynamic programme picks the
thresholds with the fewest candidate pairs, counted over all records on a slice of signature
space, among those that reach the recall asked for at the similarity threshold itself, as the
weights of shared stock phrases may lower it.
Weighting stock phrases down keeps unrelated records apart; where they make up much of a record (it
may be one of a mass of versions of one text), a second code without weights stands beside the first.
Candidates whose codes agree as those of pairs at the threshold do are verified on their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import vec
from .cluster import durable, map_batches, map_stream, own_names, sent_if_small
from .components import star_components


@dataclass(frozen=True)
class NearDup:
    k: int = 5
    similarity: float = 0.8
    symbols: int = 108
    width: int = 3
    recall: float = 0.998
    common_share: float = 0.01      # shingles in more than this share of records are weighted down
    common_shift: int = 5           # ... by 2 ** this
    plain_share: float = 0.3        # records with more common shingles than this get a second, unweighted code
    slice_of: int = 16              # candidate counts are taken on 1 / this of signature space
    pair_cost: float = 40.0         # what fetching and verifying a pair costs, in signatures
    layout_sample: int = 256        # records whose codes fix which values go together
    small: int = 12                 # buckets up to this size are paired in full at once
    block: int = 256                # larger ones in blocks of about this many rows
    hot: int = 64                   # a signature of more records than this in one batch is salted
    bucket: int = 500_000           # signatures a task looks through at once, about
    broadcast_ids: int = 500_000    # candidate ids or large buckets sent to all tasks at most; more are joined
    seed: int = 7

    @property
    def weighted(self) -> float:
        """The least weighted similarity of a pair at the threshold that need not share an unweighted code.

        One of its records has up to plain_share of common shingles, so they share at most that part of their union.
        """
        lost = self.plain_share * (1 - 0.5**self.common_shift)
        return max(0.0, self.similarity - lost) / (1 - lost)


def common_shingles(docs: DataFrame, k: int, share: float) -> np.ndarray:
    """Shingles frequent over all records: frequent in at least one chunk, then their chunk counts summed.

    There can be no more of them than the mean number of shingles of a record divided by ``share``,
    however many records there are.
    """

    def local(cols):
        texts = cols["text"].to_pylist()
        for a, b in vec.chunks(np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts)), 3_000_000):
            h, off, _ = vec.Words(texts[a:b]).shingles(k)
            if not len(h):
                continue
            least = max(3, share * (b - a))
            hs = np.sort(h)
            at = np.flatnonzero(np.diff(hs, prepend=~hs[:1]))
            often = hs[at[np.diff(np.append(at, len(hs))) >= least]]  # by occurrences first, which costs one sort
            some = np.flatnonzero(vec.among(h, often))
            doc = np.searchsorted(off, some, "right") - 1
            order = np.lexsort((doc, h[some]))
            hs, ds = h[some][order], doc[order]
            new = np.ones(len(hs), dtype=bool)
            new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
            u, n = np.unique(hs[new], return_counts=True)
            yield {"h": vec.signed(u[n >= least]), "n": n[n >= least], "docs": np.full(int((n >= least).sum()), 0)}
            yield {"h": np.array([0]), "n": np.array([0]), "docs": np.array([b - a])}

    counts = durable(map_batches(docs.select("text"), local, "h long, n long, docs long").groupBy("h").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    total = counts.agg(F.max("docs")).first()[0] or 0
    rows = counts.where((F.col("n") > 0) & (F.col("n") >= share * total)).select("h").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def _codes(docs: DataFrame, common: np.ndarray, o: NearDup) -> DataFrame:
    """(id, whole, code, plain, brief, brief_plain) of each record with at least k words.

    ``plain`` is null or the unweighted code; the brief forms hold four bits of each value.
    """
    rng = np.random.default_rng(o.seed)
    mul = (rng.integers(1, 2**31, o.symbols, dtype=np.int64) * 2 + 1).astype(np.uint32)
    add = rng.integers(0, 2**32, o.symbols, dtype=np.int64).astype(np.uint32)
    table = np.zeros(1 << 20, dtype=bool)
    table[(common & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    k, shift, share = o.k, np.uint32(o.common_shift), o.plain_share
    packed = np.packbits(table) if len(common) else None

    def short(c: np.ndarray) -> list[bytes]:
        low = (c & np.uint16(15)).astype(np.uint8)
        return [r.tobytes() for r in (low[:, 0::2] << np.uint8(4)) | low[:, 1::2]]

    def code(cols):
        ids, texts = cols["id"], cols["text"].to_pylist()
        light = np.unpackbits(packed).astype(bool) if packed is not None else None
        for a, b in vec.chunks(np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))):
            w = vec.Words(texts[a:b])
            h, off, _ = w.shingles(k)
            ok = np.flatnonzero(np.diff(off) > 0)
            if not len(ok):
                continue
            x = (h >> np.uint64(32)).astype(np.uint32)
            y = h.astype(np.uint32)
            heavy = None
            if light is not None:
                maybe = np.flatnonzero(light[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
                maybe = maybe[np.isin(h[maybe], common)]
                heavy = maybe if len(maybe) else None
            out = np.empty((len(ok), len(mul)), dtype=np.uint16)
            own, plain = np.zeros(0, dtype=np.int64), None
            if heavy is not None:  # records mostly made of stock phrases, with their shingles put together
                stock = np.bincount(np.searchsorted(off, heavy, "right") - 1, minlength=b - a)
                own = ok[stock[ok] > share * np.diff(off)[ok]]
                size = np.diff(off)[own]
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                part = np.arange(at[-1]) + np.repeat(off[:-1][own] - at[:-1], size)
                plain = np.empty((len(own), len(mul)), dtype=np.uint16)
            top = np.uint32(0xFFFFFFFF) >> shift
            with np.errstate(over="ignore"):
                for j in range(len(mul)):
                    v = x * mul[j] + (y ^ add[j]) * np.uint32(0x85EBCA6B)
                    v ^= v >> np.uint32(15)
                    v *= np.uint32(0x2C1B3C6D)
                    v ^= v >> np.uint32(13)
                    low = v
                    if heavy is not None:
                        if len(own):
                            m = np.minimum.reduceat(v[part], at[:-1]) * np.uint32(0x9E3779B1)
                            plain[:, j] = (m >> np.uint32(16)).astype(np.uint16)
                        low = v.copy()
                        s = v[heavy]
                        low[heavy] = np.where(s > top, np.uint32(0xFFFFFFFF), s << shift)
                    m = vec.reduce_min(low, off, np.uint32(0))[ok]
                    m = m * np.uint32(0x9E3779B1)
                    out[:, j] = (m >> np.uint32(16)).astype(np.uint16)
            whole = vec.text_hashes(w)[ok]
            where = {i: n for n, i in enumerate(own.tolist())}
            brief = short(plain) if len(own) else []
            yield {"id": ids.take(pa.array(ok + a)), "whole": vec.signed(whole), "code": [r.tobytes() for r in out],
                   "plain": [plain[where[i]].tobytes() if i in where else None for i in ok.tolist()],
                   "brief": short(out), "brief_plain": [brief[where[i]] if i in where else None for i in ok.tolist()]}

    return map_batches(docs, code, "id long, whole long, code binary, plain binary, brief binary, brief_plain binary")


def group_values(codes: np.ndarray, width: int) -> list[list[int]]:
    """Partitions of ``width`` values; values whose agreement on unrelated records correlates go together."""
    n, m = codes.shape
    if n < 8:
        return [list(range(i, i + width)) for i in range(0, m - width + 1, width)]
    i, j = np.triu_indices(n, 1)
    same = (codes[i] == codes[j]).astype(np.float32)
    same -= same.mean(0)
    norm = np.sqrt((same * same).sum(0)) + 1e-9
    corr = (same.T @ same) / np.outer(norm, norm)
    free, out = set(range(m)), []
    rate = norm.copy()
    while len(free) >= width:
        head = max(free, key=lambda c: (rate[c], -c))
        free.discard(head)
        rest = sorted(free, key=lambda c: (-corr[head, c], c))[: width - 1]
        free.difference_update(rest)
        out.append([head, *rest])
    return out


def meets(similarity: float, width: int, threshold: int) -> float:
    """Probability that a pair of this similarity meets in one partition."""
    s = similarity
    if threshold < 0:
        return 0.0
    return s**width + (width * s ** (width - 1) * (1 - s) if threshold else 0.0)


def allocate(cost: np.ndarray, similarity: float, width: int, recall: float, units: int = 400) -> list[int]:
    """Thresholds (-1, 0, 1) by partition with the least summed cost that reach the recall.

    ``cost[i, t]`` is the candidate count of partition i at threshold t (0 or 1).  Coverage adds up
    as -log of the chance to miss; the dynamic programme runs over partitions and coverage units.
    """
    need = -np.log(1 - recall)
    gain = [0] + [int(-np.log(1 - meets(similarity, width, t)) / need * units) for t in (0, 1)]
    best = np.full(units + 1, np.inf)
    best[0] = 0
    picks = []
    for i in range(len(cost)):
        new, pick = best.copy(), np.full(units + 1, -1)
        came = np.arange(units + 1)
        for t in (0, 1):
            for c in np.flatnonzero(np.isfinite(best)):
                to = min(units, c + gain[t + 1])
                if best[c] + cost[i, t] < new[to]:
                    new[to], pick[to], came[to] = best[c] + cost[i, t], t, c
        picks.append((pick, came))
        best = new
    at = int(units if np.isfinite(best[units]) else np.flatnonzero(np.isfinite(best)).max())
    out = []
    for pick, came in reversed(picks):
        out.append(int(pick[at]))
        at = int(came[at])
    return out[::-1]


def _probes(ids: np.ndarray, code: np.ndarray, kind: int, layout: list[list[int]], want: list[tuple[int, int]], slice_of: int, hot: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(probe, sig, salt, id) of a batch's codes, a few probes at a time."""
    for n, (p, t) in enumerate(want):
        for drop in range(-1, len(layout[p])) if t else (-1,):
            if t and drop < 0:
                continue  # all equal is within all but one
            h = np.full(len(ids), (kind << 16) + (p << 8) + (drop + 1 if t else 0), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for q, c in enumerate(layout[p]):
                    if q != drop:
                        h = vec.mix(h * np.uint64(0x9E3779B97F4A7C15) + code[:, c] + np.uint64(1))
            got = np.flatnonzero(h % np.uint64(slice_of) == 0) if slice_of else np.arange(len(ids))
            if not len(got):
                continue
            salt = np.zeros(len(got), dtype=np.int32)
            if not slice_of and len(got) > hot:
                sig, first, where, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                many = times > hot
                if many.any():
                    salt[many[where]] = 1 + int(ids.min()) % 1_000_003
                    heads = first[many]
                    yield np.full(len(heads), n), h[heads], np.zeros(len(heads), dtype=np.int32), ids[heads]
            yield np.full(len(got), n), h[got], salt, ids[got]


def _probed(cols: dict, *how) -> Iterator[tuple[np.ndarray, ...]]:
    """``_probes`` of a batch's codes and of its plain ones."""
    ids = cols["id"].to_numpy()
    for kind, name in enumerate(("code", "plain")):
        blobs = cols[name].to_pylist()
        at = np.array([i for i, x in enumerate(blobs) if x is not None], dtype=np.int64)
        if len(at):
            code = np.frombuffer(b"".join(blobs[i] for i in at), dtype=np.uint16).reshape(len(at), -1).astype(np.uint64)
            yield from _probes(ids[at], code, kind, *how)


def _sliced(codes: DataFrame, layout: list[list[int]], want: list[tuple[int, int]], slice_of: int) -> DataFrame:
    """(probe, sig) for the wanted (partition, threshold) on a slice of signature space."""

    def run(cols):
        for probe, sig, _, _ in _probed(cols, layout, want, slice_of, 0):
            yield {"probe": probe, "sig": vec.signed(sig)}

    return map_batches(codes.select("id", "code", "plain"), run, "probe int, sig long")


HITS = "bucket int, sig binary, probe binary, salt binary, id binary"


def _planes(x: np.ndarray, n: int = 8) -> bytes:
    """The n low bytes of each number, all lowest ones first: they compress well where the higher ones recur."""
    return np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _from_planes(blob: bytes, n: int = 8) -> np.ndarray:
    out = np.zeros((len(blob) // n, 8), dtype=np.uint8)
    out[:, :n] = np.frombuffer(blob, dtype=np.uint8).reshape(n, -1).T
    return out.view(np.int64).ravel()


def _hit_row(bucket: int, sig: np.ndarray, probe: np.ndarray, salt: np.ndarray, ids: np.ndarray) -> dict:
    return {"bucket": [bucket], "sig": [_planes(sig, 6)], "probe": [_planes(probe, 2)], "salt": [_planes(salt, 4)], "id": [_planes(np.diff(ids, prepend=0))]}


def _hit_rows(row: dict) -> tuple[np.ndarray, ...]:
    return _from_planes(row["sig"], 6), _from_planes(row["probe"], 2), _from_planes(row["salt"], 4), np.cumsum(_from_planes(row["id"]))


def _shared_hits(codes: DataFrame, layout: list[list[int]], want: list[tuple[int, int]], hot: int, buckets: int) -> DataFrame:
    """Signatures (48 bits) of the wanted (partition, threshold) that more than one record has, as lists in order, by bucket.

    A signature that many records of one batch share is salted by batch, so that a mass of versions
    of one text spreads over tasks; its first record stands in the unsalted bucket too, where the
    batches meet.
    """

    def scatter(cols):
        got = list(_probed(cols, layout, want, 0, hot))
        if not got:
            return
        probe, sig, salt, ids = (np.concatenate(x) for x in zip(*got))
        sig = sig & np.uint64((1 << 48) - 1)
        bucket = (vec.mix(sig + (salt.astype(np.uint64) << np.uint64(48))) >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        bound = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for n in np.flatnonzero(np.diff(bound)):
            at = order[bound[n]:bound[n + 1]]
            yield _hit_row(int(n), sig[at], probe[at], salt[at], ids[at])

    arrow = to_arrow_schema(StructType.fromDDL(HITS))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def flush():
            sig, probe, salt, ids = (np.concatenate(x) for x in zip(*map(_hit_rows, held)))
            order = np.lexsort((ids, salt, probe, sig))
            sig, probe, salt, ids = sig[order], probe[order], salt[order], ids[order]
            like = (np.diff(sig) == 0) & (np.diff(probe) == 0) & (np.diff(salt) == 0)
            keep = np.append(like, False) | np.insert(like, 0, False) | (salt > 0)
            row = _hit_row(held[0]["bucket"], sig[keep], probe[keep], salt[keep], ids[keep])
            return pa.RecordBatch.from_arrays([pa.array(row[f.name], type=f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield flush()
                    held = []
                held.append(row)
        if held:
            yield flush()

    lists = map_batches(codes.select("id", "code", "plain"), scatter, HITS)
    return durable(map_stream(lists.repartition("bucket").sortWithinPartitions("bucket"), shared, HITS))


def _verify(pairs: DataFrame, docs: DataFrame, k: int, similarity: float, broadcast_ids: int, how: str = "inner") -> DataFrame:
    """The pairs (a, b), written already, whose whole texts reach the similarity, with it.

    Only the texts of candidates are moved: their ids go to the scan if they are few enough.  With
    ``how`` "left" a candidate without a text is an error.
    """
    ids = durable(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    texts = docs.join(sent_if_small(ids, broadcast_ids), "id", "left_semi")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def run(cols):
        a, b = cols["a"].to_numpy(), cols["b"].to_numpy()
        ids, at = np.unique(np.concatenate([a, b]), return_index=True)  # each text of the batch is read once
        ta, tb = cols["ta"], cols["tb"]
        texts = [ta[i].as_py() if i < len(a) else tb[i - len(a)].as_py() for i in at.tolist()]
        if None in texts:
            raise ValueError(f"no text for record {ids[texts.index(None)]}")
        sets: list = []
        for s, e in vec.chunks(np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))):
            h, off, _ = vec.Words(texts[s:e]).shingles(k)
            sets += [np.unique(h[off[i]:off[i + 1]]) for i in range(e - s)]
        left_at, right_at = np.searchsorted(ids, a), np.searchsorted(ids, b)
        sims = np.array([vec.jaccard(sets[i], sets[j]) for i, j in zip(left_at.tolist(), right_at.tolist())])
        ok = np.flatnonzero(sims >= similarity - 1e-12)
        if len(ok):
            yield {"a": a[ok], "b": b[ok], "similarity": sims[ok]}

    return map_batches(pairs.join(left, "a", how).join(right, "b", how).select("a", "b", "ta", "tb"), run, "a long, b long, similarity double")


def least_agreement(similarity: float, symbols: int, bits: int) -> int:
    """Values, seen with so many bits, that a pair of this similarity agrees in but for one case in a million: five standard errors below the mean."""
    p = similarity + (1 - similarity) / 2**bits
    return int(np.floor(symbols * p - 5 * np.sqrt(symbols * p * (1 - p))))


def _agreement(diff: np.ndarray) -> np.ndarray:
    """How many of the four-bit values are equal, of each row of differences."""
    return ((diff & 0xF0) == 0).sum(1) + ((diff & 0x0F) == 0).sum(1)


def _alike(pairs: DataFrame, codes: DataFrame, o: NearDup) -> DataFrame:
    """The pairs whose brief codes agree as those of pairs at the threshold do: only their texts are fetched.

    A pair at the threshold has either the weighted similarity that plain_share leaves, or two plain codes.
    """
    brief = lambda x: codes.select(F.col("id").alias(x), F.col("brief").alias(f"w{x}"), F.col("brief_plain").alias(f"p{x}"))
    weighted, plain = least_agreement(o.weighted, o.symbols, 4), least_agreement(o.similarity, o.symbols, 4)

    def agree(x: list, y: list) -> np.ndarray:
        diff = np.frombuffer(b"".join(x), dtype=np.uint8) ^ np.frombuffer(b"".join(y), dtype=np.uint8)
        return _agreement(diff.reshape(len(x), -1))

    def run(cols):
        w = [cols[c].to_pylist() for c in ("wa", "wb", "pa", "pb")]
        ok = agree(w[0], w[1]) >= weighted
        both = np.array([i for i, (x, y) in enumerate(zip(w[2], w[3])) if x and y and not ok[i]], dtype=np.int64)
        if len(both):
            ok[both] = agree([w[2][i] for i in both], [w[3][i] for i in both]) >= plain
        at = np.flatnonzero(ok)
        if len(at):
            yield {"a": cols["a"].to_numpy()[at], "b": cols["b"].to_numpy()[at]}

    return map_batches(pairs.join(brief("a"), "a").join(brief("b"), "b").select("a", "b", "wa", "wb", "pa", "pb"), run, "a long, b long")


def _close_pairs(hits: DataFrame, o: NearDup) -> tuple[DataFrame, DataFrame]:
    """Pairs to verify first, and the signatures of buckets too large to be paired in full."""

    def ranked(row):
        sig, probe, salt, ids = _hit_rows(row)
        new = np.flatnonzero(np.append(True, (np.diff(sig) != 0) | (np.diff(probe) != 0) | (np.diff(salt) != 0)))[:len(sig)]
        start = np.repeat(new, np.diff(np.append(new, len(sig))))
        return sig, probe, salt, ids, start, np.arange(len(sig)) - start + 1

    def pair(cols):
        for row in pa.table(cols).to_pylist():
            _, _, _, ids, start, rn = ranked(row)
            few = [(at - i, at) for i in range(1, o.small) for at in [np.flatnonzero((rn > i) & (rn <= o.small))]]
            many = np.flatnonzero(rn > o.small)
            a, b = (np.concatenate(x) for x in zip(*few, (start[many], many), (many - 1, many)))
            got = np.unique(np.stack([ids[a], ids[b]], 1), axis=0)
            got = got[got[:, 0] != got[:, 1]]
            if len(got):
                yield {"a": np.ascontiguousarray(got[:, 0]), "b": np.ascontiguousarray(got[:, 1])}

    def count(cols):
        for row in pa.table(cols).to_pylist():
            sig, probe, salt, _, _, rn = ranked(row)
            at = np.flatnonzero((rn > o.small) | (salt > 0))
            got, n = np.unique(np.stack([sig[at], probe[at]], 1), axis=0, return_counts=True)
            if len(got):
                yield {"sig": np.ascontiguousarray(got[:, 0]), "probe": np.ascontiguousarray(got[:, 1]), "n": n}

    large = map_batches(hits, count, "sig long, probe int, n long").groupBy("sig", "probe").agg((F.sum("n") + o.small).alias("size"))
    return map_batches(hits, pair, "a long, b long").distinct(), large


def _members(hits: DataFrame) -> DataFrame:
    """(sig, probe, id) of the lists."""

    def run(cols):
        for row in pa.table(cols).to_pylist():
            sig, probe, _, ids = _hit_rows(row)
            if len(sig):
                yield {"sig": sig, "probe": probe, "id": ids}

    return map_batches(hits, run, "sig long, probe int, id long")


def _rest(hits: DataFrame, large: DataFrame, codes: DataFrame, comp: DataFrame, o: NearDup) -> DataFrame:
    """Candidate pairs of the large buckets between records not yet in one set.

    Rows outside the hub's set meet every row of their bucket, block by block: a block holds a
    bounded number of codes and only pairs whose codes are alike leave the task.
    """
    rows = _members(hits).join(sent_if_small(large, o.broadcast_ids), ["sig", "probe"]).distinct().join(comp, "id", "left").withColumn("root", F.coalesce("root", "id"))
    hub = rows.groupBy("sig", "probe").agg(F.min_by("root", "id").alias("hub"))
    rows = rows.join(hub, ["sig", "probe"]).withColumn("blk", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / o.block)))
    outside = rows.where("root <> hub").select("sig", "probe").distinct()
    rows = durable(rows.join(outside, ["sig", "probe"]).join(codes.select("id", "brief", "brief_plain"), "id"))
    pack = lambda d, p: d.repartition("sig", "probe").groupBy("sig", "probe", "blk").agg(
        F.collect_list(F.struct("id", "root", "brief", "brief_plain")).alias(p)).withColumnRenamed("blk", f"{p}_blk")
    grid = pack(rows.where("root <> hub"), "l").join(pack(rows, "r"), ["sig", "probe"]).select("l", "r")
    weighted, plain = least_agreement(o.weighted, o.symbols, 4), least_agreement(o.similarity, o.symbols, 4)
    width = o.symbols // 2

    def run(cols):
        for l, r in zip(cols["l"].to_pylist(), cols["r"].to_pylist()):
            # A record without a plain code has zeros there, and is told apart by a mask.
            mat = lambda x, c: np.frombuffer(b"".join(y[c] or bytes(width) for y in x), dtype=np.uint8).reshape(len(x), -1)
            cl, cr, dl, dr = mat(l, "brief"), mat(r, "brief"), mat(l, "brief_plain"), mat(r, "brief_plain")
            has = np.array([y["brief_plain"] is not None for y in r])
            ids = np.array([y["id"] for y in r])
            roots = np.array([y["root"] for y in r])
            for i, y in enumerate(l):
                ok = _agreement(cr ^ cl[i]) >= weighted
                if y["brief_plain"] is not None:
                    ok |= has & (_agreement(dr ^ dl[i]) >= plain)
                got = np.flatnonzero(ok & (roots != y["root"]))
                if len(got):
                    yield {"a": np.minimum(ids[got], y["id"]), "b": np.maximum(ids[got], y["id"])}

    return map_batches(grid, run, "a long, b long").where("a <> b").distinct()


def near_duplicate_sets(df: DataFrame, id_col: str, text_col: str, options: NearDup = NearDup()) -> DataFrame:
    """One row a record: (id, set_id); set_id is the smallest id of the record's set.

    Records are in one set if their similarity (shared distinct k-word sequences over all of
    either) reaches ``options.similarity``, directly or through others.  Records of fewer than k
    words, or with null text, come out as sets of their own; null ids are left out; repeated ids
    must not occur.  Other columns play no part.  Exact copies (of the word sequence) are one
    vertex throughout, so a mass of copies costs no more than one record.
    """
    o = options
    docs = own_names(df, id=id_col, text=text_col).where(F.col("id").isNotNull())
    docs = docs.withColumn("id", F.col("id").cast("long"))
    with_text = docs.where(F.length("text") > 0)
    common = common_shingles(with_text, o.k, o.common_share)
    codes_all = durable(_codes(with_text, common, o))
    reps = codes_all.groupBy("whole").agg(F.min("id").alias("rep"))
    member = codes_all.select("id", "whole").join(reps, "whole").select("id", "rep")
    copies = durable(member.where("id <> rep").select("id"))
    codes = durable(codes_all.join(sent_if_small(copies, o.broadcast_ids), "id", "left_anti").select("id", "code", "plain", "brief", "brief_plain"))

    sample = codes.orderBy(F.xxhash64("id", F.lit(o.seed))).limit(o.layout_sample).select("code").collect()
    arr = np.frombuffer(b"".join(bytes(r[0]) for r in sample), dtype=np.uint16).reshape(len(sample), o.symbols) if sample else np.zeros((0, o.symbols), np.uint16)
    layout = group_values(arr, o.width)
    every = [(p, t) for p in range(len(layout)) for t in (0, 1)]
    counted = _sliced(codes, layout, every, o.slice_of).groupBy("probe", "sig").count().where("count > 1").groupBy("probe").agg(
        F.sum(F.expr("count * (count - 1) / 2")).alias("pairs")).collect()
    cost = np.zeros((len(layout), 2))
    for r in counted:
        p, t = every[r["probe"]]
        cost[p, t] = r["pairs"] * o.slice_of
    n = codes.count()
    cost *= o.pair_cost             # ... against what it costs to hand out the signatures themselves
    cost[:, 0] += n
    cost[:, 1] += n * o.width
    plan = allocate(cost, o.weighted if len(common) else o.similarity, o.width, o.recall)
    want = [(p, t) for p, t in enumerate(plan) if t >= 0]

    signatures = n * sum(o.width if t else 1 for _, t in want)
    hits = _shared_hits(codes, layout, want, o.hot, max(1, -(-signatures // o.bucket)))
    pairs, large = _close_pairs(hits, o)
    edges = durable(_verify(durable(_alike(pairs, codes, o)), docs, o.k, o.similarity, o.broadcast_ids)).select("a", "b")
    comp = durable(star_components(edges))
    large = durable(large)
    if not large.isEmpty():
        more = _verify(durable(_rest(hits, large, codes, comp, o)), docs, o.k, o.similarity, o.broadcast_ids).select("a", "b")
        tree = comp.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))
        comp = durable(star_components(tree.union(more)))
    return (
        docs.select("id").join(member, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
        .join(comp.select(F.col("id").alias("rep"), "root"), "rep", "left")
        .select("id", F.coalesce("root", "rep").alias("set_id"))
    )


def set_pairs(sets: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, of records in the same set."""
    big = sets.groupBy("set_id").agg(F.count("*").alias("n")).where("n > 1").select("set_id")
    m = sets.join(big, "set_id", "left_semi")
    return m.select("set_id", F.col("id").alias("a")).join(m.select("set_id", F.col("id").alias("b")), "set_id").where("a < b").select("a", "b")
