"""Writing: documents, manifests, feedback sets, the visited store, training copies."""

from __future__ import annotations

import re
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup

# Content types of stored objects.
OBJECT_TYPES = {"pdf": "application/pdf", "doc": "application/msword", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document"}


def object_type(file_type: Column) -> Column:
    pairs = [F.lit(x) for kv in OBJECT_TYPES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(file_type)), F.lit("application/octet-stream"))


def document_key(hostname: Column, job_id: Column, filename: Column, root: str = "scraped") -> Column:
    return F.concat_ws("/", F.lit(root), hostname, job_id, filename)


def write_documents(items: DataFrame, root: str) -> None:
    """Files of (hostname, job_id, filename, content) below the root, a path or URI of any file system the
    tasks can reach, written by the tasks that hold them: each beside its place first, then moved there."""

    def put(rows):
        fs, base = pyarrow.fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for r in rows:
            folder = f"{base.rstrip('/')}/{r['hostname'] or 'unknown'}/{r['job_id'] or 'none'}"
            fs.create_dir(folder, recursive=True)
            part = f"{folder}/.{uuid.uuid4().hex}"
            with fs.open_output_stream(part) as f:
                f.write(bytes(r["content"] or b""))
            fs.move(part, f"{folder}/{(r['filename'] or 'document').rsplit('/', 1)[-1]}")

    items.select("hostname", "job_id", "filename", "content").foreachPartition(put)


def append_manifest(manifest: DataFrame, root: str) -> None:
    manifest.write.mode("append").partitionBy("job_id").json(root)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions of a store, oldest first: those whose writer left its mark of success."""
    at, fs = _files(spark, path)
    if not fs.exists(at):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(at)]
    done = [n for n in names if re.fullmatch(r"v=\d+", n) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n[2:]) for n in done)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the last complete version."""
    have = versions(spark, path)
    return f"{path.rstrip('/')}/v={have[-1]}" if have else None


def _swap(spark: SparkSession, df: DataFrame, path: str, fmt: str, keep: int = 2) -> None:
    """Write the next version beside the last; readers see the one or the other at any moment, and old ones go."""
    have = versions(spark, path)
    df.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/v={have[-1] + 1 if have else 0}")
    for n in have[:max(0, len(have) + 1 - keep)]:
        old, fs = _files(spark, f"{path.rstrip('/')}/v={n}")
        fs.delete(old, True)


def rewrite_feedback(spark: SparkSession, stored: DataFrame, batch: DataFrame, path: str) -> None:
    """The stored verdicts with the batch's in their place, in order of position."""
    _swap(spark, dedup.upsert(stored, batch, ["job_id", "line_index"]).orderBy("job_id", "line_index"), path, "json")


def rewrite_visited(spark: SparkSession, state: DataFrame, path: str) -> None:
    _swap(spark, state, path, "parquet")


def read_visited(spark: SparkSession, path: str) -> DataFrame:
    """The store, or an empty one where nothing is there yet."""
    schema = "url_norm string, job_id string, scraped_at timestamp_ntz, metadata map<string,string>"
    at = current(spark, path)
    return spark.read.schema(schema).parquet(at) if at else spark.createDataFrame([], schema)


def rewrite_cache(spark: SparkSession, cache: DataFrame, extracted: DataFrame, path: str) -> None:
    """The extraction cache with new entries in place of those of the same key."""
    _swap(spark, dedup.upsert(cache, extracted, ["cache_key"]), path, "parquet")


def read_feedback(spark: SparkSession, schema: str, *places: str) -> DataFrame:
    """Verdicts of the first of the places that holds any version; none at all give an empty table."""
    for path in places:
        if at := current(spark, path):
            return spark.read.schema(schema).json(at)
    return spark.createDataFrame([], schema)


def write_url_list(urls: DataFrame, path: str) -> None:
    """One URL a line, for a later run to take up."""
    urls.select("url").where("url is not null").write.mode("overwrite").text(path)


def summary_text(report: DataFrame, marker: str = "__SCRAPE_SUMMARY__") -> DataFrame:
    """(value): the marker and the one row of a report as JSON."""
    return report.select(F.concat(F.lit(marker + " "), F.to_json(F.struct(*report.columns))).alias("value"))
