"""Batches of jobs: summaries, counters, the visited store, the registry, logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import urls
from . import dedup


def batch_summary(results: DataFrame) -> DataFrame:
    """One row a status: jobs, files found and downloaded, bytes."""
    return results.groupBy("status").agg(
        F.count("*").alias("n_jobs"), F.sum("files_found").alias("files_found"), F.sum("files_downloaded").alias("files_downloaded"), F.sum("bytes_downloaded").alias("bytes_downloaded"))


def job_counters(manifest: DataFrame) -> DataFrame:
    """One row a job: documents classified by outcome, and skipped because they cannot be."""
    pdf = F.lower("file_type") == "pdf"
    is_ = lambda d: F.count_if(pdf & (F.col("decision") == d))
    return manifest.groupBy("job_id").agg(
        F.count_if(pdf).alias("classified"), is_("automatic_positive").alias("positive"), is_("automatic_negative").alias("negative"), is_("needs_review").alias("review"),
        F.count_if(~pdf | pdf.isNull()).alias("skipped"))


def not_visited(jobs: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """Jobs whose normalised URL is not in the store."""
    seen = visited.select(urls.normalize_url(F.col("url")).alias("url_norm")).where("url_norm is not null").distinct()
    return jobs.withColumn("url_norm", urls.normalize_url(F.col(url))).join(seen, "url_norm", "left_anti")


def visited_state(visited: DataFrame) -> DataFrame:
    """The latest entry of each normalised URL, with its metadata: null times first, ties by job."""
    meta = F.col("metadata") if "metadata" in visited.columns else F.lit(None).cast("map<string,string>")
    v = visited.select(urls.normalize_url(F.col("url")).alias("url_norm"), "job_id", "scraped_at", meta.alias("metadata")).where("url_norm is not null")
    return dedup.last_wins(v, ["url_norm"], [F.coalesce("scraped_at", F.lit("1900-01-01").cast("timestamp_ntz")), F.col("job_id")])


def prune_registry(jobs: DataFrame, keep: int, finished: Column, order: list[Column]) -> DataFrame:
    """Jobs left when only ``keep`` may stay: the oldest finished ones go, as many as are too many.

    So every unfinished job stays, and of the finished ones the newest that still fit: at most
    ``keep`` rows are picked, however many there are.
    """
    open_jobs = jobs.where(~finished)
    room = max(0, keep - open_jobs.count())
    return open_jobs.unionByName(jobs.where(finished).orderBy(*[c.desc() for c in order]).limit(room))


def last_section(lines: DataFrame, pos: str, is_marker: Column) -> DataFrame:
    """Lines from the last marker on; all lines if there is none.  Two aggregations, no global sort."""
    last = lines.agg(F.max(F.when(is_marker, F.col(pos))).alias("_last"))
    return lines.crossJoin(F.broadcast(last)).where(F.col("_last").isNull() | (F.col(pos) >= F.col("_last"))).drop("_last")


def elapsed(started: Column, finished: Column, now: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.coalesce(finished, now) - started), 1)


def outcomes(asked: DataFrame, visited: DataFrame, crawled: DataFrame, force: bool = False) -> DataFrame:
    """(url, job_id, status, detail, files_found, files_downloaded, bytes_downloaded): what became of each asked (url, job_id).

    A URL seen before is skipped, one that can't be fetched is invalid; others are scraped, or in
    error, as ``crawled`` (url, error and the counts) tells, and pending while it says nothing.
    """
    seen = visited.select(urls.normalize_url(F.col("url")).alias("url_norm")).where("url_norm is not null").distinct().withColumn("_seen", F.lit(not force))
    a = asked.select("url", "job_id", urls.normalize_url(F.col("url")).alias("url_norm"), urls.invalid_reason(F.col("url")).alias("_bad")).join(seen, "url_norm", "left")
    counts = ["files_found", "files_downloaded", "bytes_downloaded"]
    c = crawled.select(F.trim("url").alias("_url"), "error", *counts, F.lit(True).alias("_done"))
    a = a.withColumn("_url", F.trim("url")).join(c, "_url", "left")
    old, bad = F.coalesce("_seen", F.lit(False)), F.col("_bad").isNotNull()
    status = F.when(old, "skipped").when(bad, "invalid").when(F.col("_done").isNull(), "pending").when(F.col("error").isNotNull(), "error").otherwise("scraped")
    detail = F.when(old, "already in visited store").when(bad, F.col("_bad")).otherwise(F.coalesce("error", F.lit("")))
    ran = ~old & ~bad
    return a.select("url", "job_id", status.alias("status"), detail.alias("detail"), *[F.coalesce(F.when(ran, F.col(x)), F.lit(0)).alias(x) for x in counts])


def newly_visited(results: DataFrame, now: Column) -> DataFrame:
    """Entries of the visited store that a batch adds: its scraped URLs, found files or not."""
    return results.where("status = 'scraped'").select(F.trim("url").alias("url"), "job_id", now.alias("scraped_at"))


def batch_report(results: DataFrame, started: Column, finished: Column) -> DataFrame:
    """One row: counts by status, totals, seconds, and every URL's outcome in order of URL and job."""
    by = results.groupBy("status").agg(F.count("*").alias("n"))
    counts = by.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("counts"))
    per_url = F.array_sort(F.collect_list(F.struct("url", "job_id", "status", "files_found", "files_downloaded", "bytes_downloaded")))
    total = results.agg(
        F.count("*").alias("jobs"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files_found", "files_downloaded", "bytes_downloaded")],
        F.round(F.greatest(F.lit(0.0), F.max(finished).cast("double") - F.min(started).cast("double")), 2).alias("seconds"), per_url.alias("per_url"))
    return total.crossJoin(counts)  # one row each


def exit_code(results: DataFrame) -> DataFrame:
    """One row: 1 for no URLs, 2 if any failed, else 0; and the status a caller over the network is given."""
    code = F.when(F.count("*") == 0, 1).when(F.count_if(F.col("status") == "error") > 0, 2).otherwise(0)
    return results.agg(code.alias("exit_code")).withColumn("http_status", F.when(F.col("exit_code") == 0, 200).when(F.col("exit_code") == 1, 422).otherwise(500))


def backend(n_urls: Column, bulk: bool, function: bool, threshold: int = 10) -> Column:
    """Where a run of so many URLs goes: to the bulk service if it is large and there is one, to a function, or here."""
    here = F.lit("lambda" if function else "local")
    return F.when(n_urls > threshold, F.lit("bulk")).otherwise(here) if bulk else here


def file_type_list(text: Column) -> Column:
    """The file types of a comma-separated text, or null for none."""
    kept = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(kept) > 0, kept)


def size_text(n: Column) -> Column:
    """Bytes as KB below a megabyte, else as MB, with one digit."""
    number = lambda x: F.format_string("%.1f", x)
    return F.when(n >= 1048576, F.concat(number(n / 1048576.0), F.lit(" MB"))).otherwise(F.concat(number(n / 1024.0), F.lit(" KB")))


def percent(value: Column, most: Column) -> Column:
    """Whole percent of the most there can be; 0 where that is 0."""
    return F.when(most > 0, F.floor(100.0 * value / F.nullif(most, F.lit(0)) + 0.5)).otherwise(0)


def run_header(at: Column) -> Column:
    return F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def chained(items: DataFrame, stages: list[tuple[int, bool, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Items through the stages (priority, whether it is on, step) that are on, the lowest priority first."""
    for _, on, step in sorted(stages, key=lambda s: s[0]):
        items = items.transform(step) if on else items
    return items
