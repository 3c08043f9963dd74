"""Manifests and human verdicts: positions, joins, counts, relevant documents, training copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import dedup

RELEVANT = ("automatic_positive", "needs_review")


def with_index(manifest: DataFrame, job: str = "job_id", order: str = "manifest_id") -> DataFrame:
    """Position of each line within its job, from 0.  Jobs are small; a null job is one like any other."""
    return manifest.withColumn("line_index", F.row_number().over(W.partitionBy(job).orderBy(order)) - 1)


def verdict(c: Column) -> Column:
    """'positive' or 'negative' in any case and with spaces; null for anything else."""
    v = F.lower(F.trim(c))
    return F.when(v.isin("positive", "negative"), v)


def last_verdicts(feedback: DataFrame, order: str = "feedback_id") -> DataFrame:
    """The last valid verdict of each line of each job."""
    f = feedback.select("job_id", "line_index", verdict(F.col("verdict")).alias("verdict"), "reviewer", order).where("verdict is not null")
    return dedup.last_wins(f, ["job_id", "line_index"], [F.col(order)])


def reviewed(manifest: DataFrame, feedback: DataFrame) -> DataFrame:
    """Each manifest line with its last verdict and reviewer, if any."""
    v = last_verdicts(feedback).select("job_id", "line_index", "verdict", "reviewer")
    return with_index(manifest).join(v, ["job_id", "line_index"], "left")


def relevant(manifest: DataFrame, feedback: DataFrame) -> DataFrame:
    """Relevant lines ranked within their job by score, unscored last, ties in line order."""
    r = reviewed(manifest, feedback).where(F.col("decision").isin(*RELEVANT))
    w = W.partitionBy("job_id").orderBy(F.col("module_handbook_score").desc_nulls_last(), "line_index")
    return r.withColumn("place", F.row_number().over(w))


def decision_counts(manifest: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row a job: lines by decision, in all, and reviewed."""
    is_ = lambda d: F.count_if(F.col("decision") == d)
    c = manifest.groupBy("job_id").agg(
        is_("automatic_positive").alias("n_positive"), is_("needs_review").alias("n_review"), is_("automatic_negative").alias("n_negative"), F.count("*").alias("total"))
    v = last_verdicts(feedback).groupBy("job_id").agg(F.count("*").alias("reviewed"))
    return c.join(v, "job_id", "left").withColumn("reviewed", F.coalesce("reviewed", F.lit(0)))


def training_copies(verdicts: DataFrame, existing: DataFrame) -> DataFrame:
    """Verdicts that become new training records: the first of each (label, group, name) that is not there yet."""
    keys = ["label", "grp", "filename"]
    new = verdicts.join(existing.select(*keys).distinct(), keys, "left_anti")
    return new.groupBy(*keys).agg(F.min("pos").alias("pos"))


def checked_verdicts(batch: DataFrame) -> DataFrame:
    """A batch with its verdicts in order; one that isn't a verdict makes the whole batch an error, before anything is applied."""
    v = batch.withColumn("verdict", verdict(F.col("verdict")))
    if v.where("verdict is null").limit(1).count():
        raise ValueError("a batch of verdicts holds something else; none was applied")
    return v


def preselected(stored: Column, decision: Column) -> Column:
    """The verdict a reviewer is shown first: the stored one, else positive where the model was sure of it."""
    return F.coalesce(verdict(stored), F.when(decision == "automatic_positive", "positive"))


def document_at(manifest: DataFrame, asked: DataFrame, root: str) -> DataFrame:
    """Asked positions (job_id, line_index) with ``document``: the saved path, but only below the root, else the key in the store."""
    m = with_index(manifest).select("job_id", "line_index", "saved_path", "s3_key")
    below = F.startswith("saved_path", F.lit(root.rstrip("/") + "/")) & ~F.col("saved_path").contains("/../")
    return asked.join(m, ["job_id", "line_index"]).withColumn("document", F.when(below, F.col("saved_path")).otherwise(F.col("s3_key"))).drop("saved_path", "s3_key")
