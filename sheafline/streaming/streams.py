"""Streams: event payloads to seeds, manifests as they grow, the visited store as state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import jobs
from ..sources import readers, writers


def event_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of seed URLs from files of event payloads, one a line."""
    lines = spark.readStream.schema("value string").text(folder)
    return lines.select(F.explode(readers.event_urls(F.col("value"))).alias("url"))


def new_seeds(seeds: DataFrame) -> DataFrame:
    """Seeds whose normalised URL the stream has not brought before."""
    return seeds.withColumn("url_norm", urls.normalize_url(F.col("url"))).dropDuplicates(["url_norm"])


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(readers.MANIFEST).json(folder)


def keep_visited(results: DataFrame, path: str, checkpoint: str):
    """Fold a stream of (url, job_id, scraped_at) into the store, batch by batch; runs what is there, then stops."""

    def fold(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        old = writers.read_visited(spark, path).withColumnRenamed("url_norm", "url")
        writers.rewrite_visited(spark, jobs.visited_state(old.unionByName(batch.select("url", "job_id", "scraped_at"), allowMissingColumns=True)), path)

    return results.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(query) -> list[tuple[int, int]]:
    """(batch, rows taken in) of a stream's recent batches, for whoever watches it."""
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress]
