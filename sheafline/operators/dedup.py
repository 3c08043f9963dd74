"""Exact duplicates and order-preserving deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def hashed(df: DataFrame, text_col: str = "text", cap: int | None = T.TEXT_CAP) -> DataFrame:
    """``df`` with ``own_hash``, of the text up to ``cap`` characters as records keep it, or of the whole text without one."""
    return df.withColumn("own_hash", T.text_hash(T.truncated(F.col(text_col), cap or 0)))


def order_key(path: Column) -> Column:
    """Paths sort by their parts: a/x before a-b/x."""
    return F.split(path, "/")


def first_wins(df: DataFrame, hash_col: str, order: list[Column], payload: list[str]) -> DataFrame:
    """The first record of each hash in the given order; records with an empty hash all stay.

    One pass: the hash is aggregated with a map-side partial ``min_by`` over the small payload, so a
    hash that a third of all rows share meets one row a task; a record with an empty or null hash
    is a group of its own.
    """
    small = df.select(*payload, F.coalesce(hash_col, F.lit("")).alias("_h"), F.struct(*order).alias("_o"))
    alone = F.when(F.col("_h") == "", F.monotonically_increasing_id())
    first = small.withColumn("_own", alone).groupBy("_h", "_own").agg(F.min_by(F.struct(*payload), F.col("_o")).alias("p"))
    return first.select("p.*", F.col("_h").alias(hash_col))


def conflicts(df: DataFrame, hash_col: str, order: list[Column], label: str, group: str) -> DataFrame:
    """(hash, n_dropped, n_conflicts): later copies, and those among them whose label or group differs from the first's."""
    small = df.where(F.coalesce(F.col(hash_col), F.lit("")) != "").select(
        F.col(hash_col).alias("h"), F.col(label).alias("l"), F.col(group).alias("g"), F.struct(*order).alias("o"))
    first = small.groupBy("h").agg(F.min_by(F.struct("l", "g"), "o").alias("f"), F.count("*").alias("n")).where("n > 1")
    same = F.col("l").eqNullSafe(F.col("f.l")) & F.col("g").eqNullSafe(F.col("f.g"))
    return small.join(first, "h").groupBy("h").agg(
        (F.count("*") - 1).alias("n_dropped"), F.count_if(~same).alias("n_conflicts")).withColumnRenamed("h", hash_col)


def distinct_in_order(df: DataFrame, value: str, pos: Column) -> DataFrame:
    """(value, pos): each value once, at its first position; nulls dropped."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(pos).alias("pos"))


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in the given order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The stored rows with the batch's in place of those of the same key."""
    both = stored.withColumn("_turn", F.lit(0)).unionByName(batch.withColumn("_turn", F.lit(1)))
    return last_wins(both, keys, [F.col("_turn")]).drop("_turn")
