"""Users, roles and models as relations."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable, ship

CHUNK = 65_536      # models of which a role's list is kept together
GATHER = 1_000_000  # rows packed into one blob
TASK_ROWS = 1_000_000  # (user, role) rows a task is laid out for
BLOCK_ROWS = 8_000_000  # (role, model) rows a task holds at most, about
SENT_ROWS = 2_000_000   # rows sent to all tasks at most
PARTS = 4_096           # parts of the users at most
LEVELS = 6              # blocks of 1, 2, 4 ... chunks are weighed against each other


def user_models(user_roles: DataFrame, model_roles: DataFrame, models: DataFrame) -> DataFrame:
    """(user_id, model_id, name): models a user may use through any role."""
    # Small inputs, large output: keep the join spread out where the size of its inputs would not.
    n = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = user_roles.repartition(n, "role_id").join(model_roles.repartition(n, "role_id"), "role_id").select("user_id", "model_id").distinct()
    return pairs.join(models, "model_id")


def _packed(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(t.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(blobs: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(b).read_all() for b in blobs)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHER:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _cut(t: pa.Table, key: np.ndarray) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each key, in their order."""
    order = np.argsort(key, kind="stable")
    t, key = t.take(pa.array(order)), key[order]
    starts = np.flatnonzero(np.append(True, np.diff(key) != 0)) if len(key) else []
    for a, b in zip(starts, [*starts[1:], len(key)]):
        yield int(key[a]), t.slice(a, b - a)


def _pack_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _gathered(batches):
        t = t.sort_by([("user_id", "ascending"), ("role_id", "ascending")])
        yield pa.record_batch([pa.array([t.num_rows]), pa.array([_packed(t)], pa.binary())], names=["n", "links"])


def _pack_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _gathered(batches):
        t = t.sort_by([("role_id", "ascending"), ("n", "ascending")])
        for bucket, own in _cut(t.drop(["bucket"]), t["bucket"].to_numpy()):
            yield pa.record_batch([pa.array([bucket], pa.int32()), pa.array([_packed(own)], pa.binary())], names=["bucket", "held"])


def _lists(t: pa.Table, chunk: int) -> pa.Table:
    """Of a bucket of roles, for each chunk of models: rows, (role_id, step) in order, where step is the distance from the place before, and the roles.

    The first row has in pairs how many (role, block) there are at 1, 2, 4 ... chunks a block, and last how many roles.
    """
    held = _unpacked(t["held"].to_pylist())
    code = held["role_id"].combine_chunks().dictionary_encode()
    n = held["n"].to_numpy()
    pair = np.unique(code.indices.to_numpy().astype(np.int64) << 32 | n)  # a place fits 32 bits: models are rows of one table
    role, n = pair >> 32, pair & 0xFFFFFFFF
    pairs = [len(np.unique(role << 32 | n // (chunk << k))) for k in range(LEVELS)] + [len(code.dictionary)]
    rows = []
    for where, own in _cut(pa.table({"role": role, "n": n}), n // chunk):
        at = own["role"].combine_chunks()
        place = own["n"].to_numpy() % chunk
        step = pa.array(np.diff(place, prepend=0).astype(np.int32))
        used = code.dictionary.take(at.unique())
        rows.append((where, own.num_rows, _packed(pa.table({"role_id": code.dictionary.take(at), "step": step})), _packed(pa.table({"role_id": used})), None if rows else pairs))
    cols = list(zip(*rows)) or [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())))], names=["chunk", "n", "lists", "roles", "pairs"])


def _spread(links: Iterator[pa.RecordBatch], homes, blocks: int, cuts: int) -> Iterator[pa.RecordBatch]:
    """The links of each cell: a block in which the role has models (every one, if not known) and a part of the users."""
    known = homes.value if homes is not None else None
    if known is not None:
        roles, start, block = pa.ipc.open_stream(known[0]).read_all()["role_id"].combine_chunks(), known[1], known[2]
    for batch in links:
        for blob in batch.column("links"):
            t = _unpacked([blob.as_py()])
            if known is not None:
                role = pc.index_in(t["role_id"], value_set=roles).combine_chunks()
                t = t.filter(role.is_valid())
                role = role.drop_null().to_numpy()
                times = np.diff(start)[role]
                into = np.repeat(start[:-1][role], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                into = block[into]
                t = t.take(pa.array(np.repeat(np.arange(len(role)), times)))
            else:
                into = np.repeat(np.arange(blocks), t.num_rows)
                t = t.take(pa.array(np.tile(np.arange(t.num_rows), blocks)))
            part = t["part"].to_numpy().astype(np.int64) % cuts
            for cell, own in _cut(t.drop(["part"]), into * cuts + part):
                yield pa.record_batch([pa.array([cell], pa.int32()), pa.array([_packed(own)], pa.binary())], names=["cell", "links"])


def _bits(place: np.ndarray, low: int, high: int) -> np.ndarray:
    """Bitmap of places, of the words from low to high."""
    own = np.zeros(64 * int(high - low), dtype=np.uint8)
    own[place - 64 * low] = 1
    return np.packbits(own, bitorder="little").view(np.uint64)


def _totals(left: pa.Table, right: pa.Table, schema: pa.Schema, chunk: int) -> pa.Table:
    """Of one block of models: how many each user may use, and the sum of their ids, from the union of the roles' lists."""
    lists = right.filter(right["lists"].is_valid()).sort_by("chunk")
    if not left.num_rows or not lists.num_rows:
        return schema.empty_table()
    first = pc.min(right["chunk"]).as_py()
    size = (pc.max(right["chunk"]).as_py() - first + 1) * chunk
    ids = np.zeros(size, dtype=np.int64)
    for row in right.filter(right["ids"].is_valid()).select(["chunk", "ids"]).to_pylist():
        at = (row["chunk"] - first) * chunk
        ids[at: at + len(row["ids"])] = row["ids"]
    names, places = [], []
    for row in lists.select(["chunk", "lists"]).to_pylist():
        t = _unpacked([row["lists"]])
        names.append(t["role_id"].combine_chunks())
        places.append(np.cumsum(t["step"].to_numpy(), dtype=np.int32) + np.int32((row["chunk"] - first) * chunk))
    code = pa.concat_arrays(names).dictionary_encode()
    role = code.indices.to_numpy()
    place = np.concatenate(places)[np.argsort(role, kind="stable")]
    start = np.concatenate([[0], np.cumsum(np.bincount(role, minlength=len(code.dictionary)))])
    of_role = [place[a:b] for a, b in zip(start, start[1:])]
    count = np.diff(start)
    links = _unpacked(left["links"].to_pylist())
    at = pc.index_in(links["role_id"], value_set=code.dictionary).combine_chunks()
    links, role = links.filter(at.is_valid()), at.drop_null().to_numpy()
    if not len(role):
        return schema.empty_table()
    who = links["user_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    user = who.indices.to_numpy()
    order = np.argsort(user, kind="stable")
    role = role[order]
    cuts = np.append(np.flatnonzero(np.diff(user[order], prepend=-1)), len(role))
    low, high = place[start[:-1]] // 64, place[start[1:] - 1] // 64 + 1
    # Where a role's models lie close together, a bitmap from the first to the last one is united quicker than lists are.
    words = [_bits(x, i, j) for x, i, j in zip(of_role, low, high)] if 8 * (high - low).sum() <= 8 * len(place) else None
    seen, union = np.zeros(size, dtype=bool), np.zeros(size // 64 + 1, dtype=np.uint64)
    n, total = [], []
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        own = role[a:b]
        held = count[own].sum()
        if words is not None:
            i, j = int(low[own].min()), int(high[own].max())
            for r, x, y in zip(own.tolist(), low[own].tolist(), high[own].tolist()):
                part = union[x:y]
                np.bitwise_or(part, words[r], out=part)
            got = np.flatnonzero(np.unpackbits(union[i:j].view(np.uint8), bitorder="little").view(bool)) + 64 * i
            union[i:j] = 0
        elif 4 * held > size:  # marking is quicker than sorting; in pieces where a user has more than there are models
            for r in (own,) if held <= size else np.unique(own)[:, None]:
                seen[np.concatenate([of_role[x] for x in r.tolist()])] = True
            got = np.flatnonzero(seen)
            seen[got] = False
        else:
            got = np.unique(np.concatenate([of_role[x] for x in own.tolist()]))
        n.append(len(got))
        total.append(int(ids[got].sum()))
    return pa.Table.from_arrays([who.dictionary.take(pa.array(user[order][cuts[:-1]])).cast(schema.field(0).type), pa.array(n, pa.int64()), pa.array(total, pa.int64())], schema=schema)


def _layout(pairs: list[int], roles: int, rows: int, links: int, size: int, least: int) -> tuple[int, int]:
    """(chunks a block, parts of the users): the pair at which the least is moved.  ``pairs[k]`` counts (role, block) at 2 ** k chunks a block.

    Larger blocks repeat links less often, smaller ones need fewer parts, to each of which a block's lists go.
    """
    best = None
    for k, n in enumerate(pairs):
        blocks = math.ceil(size / (1 << k))
        each = links * n / max(1, roles)
        cuts = min(PARTS, max(1, math.ceil(max(least, each / TASK_ROWS) / blocks)))
        moved = 4 * each + 1.5 * rows * cuts
        if k == 0 or (rows / blocks <= BLOCK_ROWS and moved < best[0]):
            best = moved, 1 << k, cuts
    return best[1], best[2]


def _homes(chunks: DataFrame, step: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The roles, and for each where its blocks begin in a list of blocks, and that list."""
    rows = chunks.select("chunk", "roles").toArrow()
    names = [_unpacked([b])["role_id"].combine_chunks() for b in rows["roles"].to_pylist()]
    code = pa.concat_arrays(names).dictionary_encode()
    block = np.repeat(rows["chunk"].to_numpy() // step, [len(x) for x in names]).astype(np.int64)
    pair = np.unique(code.indices.to_numpy().astype(np.int64) << 32 | block)
    start = np.concatenate([[0], np.cumsum(np.bincount(pair >> 32, minlength=len(code.dictionary)))])
    return _packed(pa.table({"role_id": code.dictionary})), start, (pair & 0xFFFFFFFF).astype(np.int32)


def user_model_totals(user_roles: DataFrame, model_roles: DataFrame, models: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(user_id, n_models, model_sum): how many models a user may use through any role, and the sum of their ids.

    The same as counting ``user_models``, whose pairs are many times the tables, without making them:
    a role is a list of models a block of them, a user the union of its roles' lists.  Links and lists
    move packed, many to a row; repeated links and pairs do no harm.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = models.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = models.select(F.col("model_id").cast("bigint").alias("model_id")).where("model_id is not null").distinct()
    place = durable(_numbered(known, "model_id").select("model_id", (F.col("_n") - 1).alias("n")))
    sent = F.broadcast(place) if place.count() <= SENT_ROWS else place
    held = model_roles.where("role_id is not null").join(sent, "model_id").select("role_id", "n", F.pmod(F.hash("role_id"), F.lit(n)).alias("bucket"))
    buckets = held.mapInArrow(_pack_held, "bucket int, held binary").repartition(n, "bucket").groupBy("bucket")
    chunks = durable(buckets.applyInArrow(lambda t: _lists(t, chunk), "chunk int, n long, lists binary, roles binary, pairs array<bigint>"))
    told = chunks.agg(F.max("chunk").alias("last"), F.sum("n").alias("rows"), *[F.sum(F.col("pairs")[k]).alias(f"p{k}") for k in range(LEVELS + 1)]).first()
    links = user_roles.where("role_id is not null").select("user_id", "role_id", F.pmod(F.hash("user_id"), F.lit(PARTS)).cast("smallint").alias("part"))
    links = durable(links.mapInArrow(_pack_links, "n long, links binary"))
    *pairs, roles = [told[f"p{k}"] or 0 for k in range(LEVELS + 1)]
    size = 1 + (told["last"] or 0)
    step, cuts = _layout(pairs, roles, told["rows"] or 0, links.agg(F.sum("n")).first()[0] or 0, size, 2 * spark.sparkContext.defaultParallelism)
    blocks = math.ceil(size / step)
    homes = spark.sparkContext.broadcast(_homes(chunks, step)) if 0 < pairs[0] <= SENT_ROWS else None
    left = links.mapInArrow(lambda b: _spread(b, homes, blocks, cuts), "cell int, links binary").repartition(blocks * cuts, "cell")
    at = F.expr(f"cast(n div {chunk} as int)")
    ids = place.groupBy(at.alias("chunk")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "model_id"))), lambda x: x["model_id"]).alias("ids"))
    every = F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))).alias("cut")
    right = chunks.select("chunk", "lists").unionByName(ids, allowMissingColumns=True).select("*", every)
    right = right.select((F.expr(f"chunk div {step}") * cuts + F.col("cut")).cast("int").alias("cell"), "chunk", "lists", "ids").repartition(blocks * cuts, "cell")
    out = T.StructType([T.StructField("user_id", user_roles.schema["user_id"].dataType), T.StructField("n_models", T.LongType()), T.StructField("model_sum", T.LongType())])
    schema = to_arrow_schema(out)
    parts = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(lambda a, b: _totals(a, b, schema, chunk), out)
    return parts.groupBy("user_id").agg(F.sum("n_models").alias("n_models"), F.sum("model_sum").alias("model_sum"))


def _numbered(df: DataFrame, by: str) -> DataFrame:
    """``df`` with _n, its place from 1 in the order of ``by``: numbered within ranges, on top of the ranges' sizes, so no task sees all rows."""
    ranged = df.repartitionByRange(by).withColumn("_p", F.spark_partition_id())
    ranged = durable(ranged.withColumn("_n", F.row_number().over(W.partitionBy("_p").orderBy(by))))
    size = ranged.groupBy("_p").agg(F.max("_n").alias("_m"))
    below = size.select("_p", (F.sum("_m").over(W.orderBy("_p")) - F.col("_m")).alias("_b"))  # a row a task
    return ranged.join(F.broadcast(below), "_p").withColumn("_n", F.col("_b") + F.col("_n")).drop("_p", "_b")


def model_allowed(requests: DataFrame, user_roles: DataFrame, model_roles: DataFrame) -> DataFrame:
    """Requests (user_id, model_id) some role of the user allows."""
    asked = requests.select("user_id", "model_id").distinct()
    through = asked.join(user_roles, "user_id").join(model_roles, ["model_id", "role_id"], "left_semi")
    return through.select("user_id", "model_id").distinct()


def users_positions(users: DataFrame, positions: DataFrame, admin: str) -> DataFrame:
    return users.join(positions, "position_id").withColumn("is_admin", F.col("position") == admin)


def roles_of_users(user_roles: DataFrame, roles: DataFrame) -> DataFrame:
    return user_roles.join(roles, "role_id").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list("role")), ",").alias("roles"))


def role_matrix(models: DataFrame, roles: DataFrame, links: DataFrame) -> DataFrame:
    """Every model with every role and whether they are linked: a small grid by definition, blocked by the roles' broadcast size."""
    return models.select("model_id").crossJoin(roles.select("role_id")).join(
        links.select("model_id", "role_id", F.lit(True).alias("assigned")).distinct(), ["model_id", "role_id"], "left").withColumn("assigned", F.coalesce("assigned", F.lit(False)))


def insert_or_ignore(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table with the rows whose key is new, each key once."""
    new = rows.join(table, keys, "left_anti").dropDuplicates(keys)
    return table.unionByName(new)


def insert_strict(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table with the rows; a key that is there already, or twice in the rows, is an error."""
    clash = rows.join(table, keys, "left_semi").limit(1).count() or rows.groupBy(*keys).count().where("count > 1").limit(1).count()
    if clash:
        raise ValueError(f"duplicate key in {keys}")
    return table.unionByName(rows)


def delete_cascade(parent: DataFrame, children: list[DataFrame], key: str, gone: DataFrame) -> list[DataFrame]:
    """Parent and children without the given keys."""
    return [t.join(gone.select(key), key, "left_anti") for t in (parent, *children)]


def update_where(table: DataFrame, key: str, keys: DataFrame, column: str, value) -> DataFrame:
    hit = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return table.join(hit, key, "left").withColumn(column, F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(column))).drop("_hit")


def get_or_create(table: DataFrame, rows: DataFrame, name: str, id_col: str) -> DataFrame:
    """The table with new names under ids after the largest one, numbered in name order."""
    new = rows.select(name).distinct().join(table, name, "left_anti")
    top = table.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    numbered = _numbered(new, name).crossJoin(F.broadcast(top))
    return table.unionByName(numbered.select((F.col("_top") + F.col("_n")).alias(id_col), name), allowMissingColumns=True)


def assign_role(user_roles: DataFrame, users: DataFrame, roles: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with the rows (user_id, role_id); unknown users or roles are an error, pairs already there are ignored."""
    for side, key in ((users, "user_id"), (roles, "role_id")):
        if rows.join(side, key, "left_anti").limit(1).count():
            raise ValueError(f"unknown {key}")
    return insert_or_ignore(user_roles, rows, ["user_id", "role_id"])
