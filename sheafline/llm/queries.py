"""Queries of this package's operators over the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import oracles
from .arrivals import Arrivals, Store, fresh_store_path, ingest
from .boilerplate import furniture_lines, main_bodies
from .cluster import durable
from .leak import Leak, leaks
from .neardup import NearDup, near_duplicate_sets, set_pairs
from .packing import Packing, pack
from .pieces import split_pieces
from .scans import repaired, scan_defects
from .sitelines import record_group, repeated_lines, without_repeated_lines
from .splits import entities, linked_pairs, split_records

THREE_WORDS = NearDup(k=3, similarity=0.6)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    sets = near_duplicate_sets(table(spark, d, "doc_record"), "rec_id", "text", THREE_WORDS)
    return set_pairs(sets).select(F.col("a").alias("rec_a"), F.col("b").alias("rec_b"))


def p3_sets(spark: SparkSession, d: str) -> DataFrame:
    sets = near_duplicate_sets(table(spark, d, "doc_record"), "rec_id", "text", THREE_WORDS)
    return sets.select(F.col("id").alias("rec_id"), "set_id")


def _group(df: DataFrame):
    return record_group(df["doc_group"], df["path"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return furniture_lines(table(spark, d, "content_item"), "item_id", "text", "url").withColumnRenamed("id", "item_id")


def p1_bodies(spark: SparkSession, d: str) -> DataFrame:
    return main_bodies(table(spark, d, "content_item"), "item_id", "text", "url").withColumnRenamed("id", "item_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rec, links = table(spark, d, "doc_record"), table(spark, d, "group_link")
    roots, _ = entities(rec, _group(rec), rec["label"], links, "slug_a", "slug_b")
    return linked_pairs(roots, links, "slug_a", "slug_b")


def p2_split(spark: SparkSession, d: str) -> DataFrame:
    rec, links = table(spark, d, "doc_record"), table(spark, d, "group_link")
    out = split_records(rec, "rec_id", _group(rec), rec["label"], links, "slug_a", "slug_b")
    return out.select(F.col("id").alias("rec_id"), F.col("slug").alias("grp"), "split")


def p2_whole(spark: SparkSession, d: str) -> DataFrame:
    """Records, groups and splits of each entity: one split each."""
    rec, links = table(spark, d, "doc_record"), table(spark, d, "group_link")
    out = split_records(rec, "rec_id", _group(rec), rec["label"], links, "slug_a", "slug_b")
    return out.groupBy(F.col("root").alias("entity")).agg(
        F.count("*").alias("n_records"), F.count_distinct("slug").alias("n_groups"), F.count_distinct("split").alias("n_splits"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    history = table(spark, d, "doc_record").select(F.col("rec_id").alias("id"), "text")
    store = Store.create(history, fresh_store_path(spark), Arrivals(k=3, similarity=0.6))
    return ingest(store, table(spark, d, "doc_batch"), "rec_id", "batch_no", "text")


def _digital(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "doc_record").where("ocr_used = false")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rec = _digital(spark, d)
    return repeated_lines(rec, "rec_id", "text", _group(rec)).select(F.col("id").alias("rec_id"), F.col("line_no").cast("int"))


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every record without the lines that six records and a twentieth of its group share."""
    rec = table(spark, d, "doc_record")
    return without_repeated_lines(rec, "rec_id", "text", _group(rec), min_share=0.05).select("rec_id", "text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_defects(table(spark, d, "doc_record"), "rec_id", "text", "ocr_used").withColumnRenamed("id", "rec_id")


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    return repaired(table(spark, d, "doc_record"), "rec_id", "text", "ocr_used").withColumnRenamed("id", "rec_id")


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), "doc_id", "text", Packing(capacity=4096)).withColumnRenamed("id", "doc_id")


def p7_cover(spark: SparkSession, d: str) -> DataFrame:
    """Characters of each document placed, gaps between its parts, and containers over capacity that it stands in."""
    o = Packing(capacity=4096)
    placed = durable(pack(table(spark, d, "documents"), "doc_id", "text", o))
    full = placed.groupBy("container").agg((F.sum("n_tokens") > o.capacity).alias("over")).where("over")
    w = W.partitionBy("id").orderBy("part")
    rows = placed.join(full, "container", "left").withColumn("gap", F.col("start_char") != F.coalesce(F.lag("end_char").over(w), F.lit(0)))
    return rows.groupBy(F.col("id").alias("doc_id")).agg(
        F.sum(F.col("end_char") - F.col("start_char")).cast("bigint").alias("placed"), F.count_if("gap").alias("gaps"), F.count_if("over").alias("over"))


def p9_cover(spark: SparkSession, d: str) -> DataFrame:
    """Characters of each document reached by its pieces, pieces that leave a gap, and pieces over the limit or unlike the text."""
    docs = table(spark, d, "documents")
    p = split_pieces(docs, "doc_id", "text", limit=512, overlap=64, keep_small=True)
    w = W.partitionBy("id").orderBy("piece_no")
    bad = (F.col("n_tokens") > 512) | (F.length("piece") != F.col("end_char") - F.col("start_char"))
    p = p.select("id", "end_char", (F.col("start_char") > F.coalesce(F.lag("end_char").over(w), F.lit(0))).alias("gap"), bad.alias("bad"))
    return p.groupBy(F.col("id").alias("doc_id")).agg(F.max("end_char").cast("bigint").alias("reached"), F.count_if("gap").alias("gaps"), F.count_if("bad").alias("bad"))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_pieces(table(spark, d, "documents"), "doc_id", "text", limit=512, overlap=64).withColumnRenamed("id", "doc_id")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "text")


def p8_edited(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a window as long as the item with up to one word in twelve edited."""
    return leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "text", Leak(max_edits=1, item_sized=True, sampled=6))


QUERIES = {
    "p1_found": p1_found, "p1_bodies": p1_bodies,
    "p2_found": p2_found, "p2_split": p2_split, "p2_whole": p2_whole,
    "p3_found": p3_found, "p3_sets": p3_sets,
    "p4_found": p4_found,
    "p5_found": p5_found, "p5_clean": p5_clean,
    "p6_found": p6_found, "p6_repaired": p6_repaired,
    "p7_pack": p7_pack, "p7_cover": p7_cover,
    "p8_found": p8_found, "p8_edited": p8_edited,
    "p9_pieces": p9_pieces, "p9_cover": p9_cover,
}
SQL: dict[str, str] = oracles.SQL
