"""Documents and verdicts on their way into the training set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import review

# Spellings of the two labels.
POSITIVE = ("positiv", "positive", "pos", "1")
NEGATIVE = ("negativ", "negative", "neg", "0")


def label_folder(label: Column, strict: bool = False) -> Column:
    """The folder of a label in any of its spellings; null, or an error if ``strict``, for anything else."""
    low = F.lower(label)
    other = F.raise_error(F.concat(F.lit("unknown label "), F.coalesce(label, F.lit("null")))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(low.isin(*POSITIVE), POSITIVE[0]).when(low.isin(*NEGATIVE), NEGATIVE[0]).otherwise(other)


def outcomes(verdicts: DataFrame, existing: DataFrame) -> DataFrame:
    """Each verdict (label, grp, filename, pos) with ``copied``: whether it becomes a record, as the first of its kind and none yet there."""
    first = review.training_copies(verdicts, existing).withColumn("copied", F.lit(True))
    return verdicts.join(first, ["label", "grp", "filename", "pos"], "left").withColumn("copied", F.coalesce("copied", F.lit(False)))


def breakdown(done: DataFrame) -> DataFrame:
    """One row: verdicts by label, copied, skipped, in all."""
    return done.agg(F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("label") == 0).alias("negative"),
                    F.count_if("copied").alias("copied"), F.count_if(~F.col("copied")).alias("skipped"), F.count("*").alias("total"))


def located(verdicts: DataFrame, saved: DataFrame, stored: DataFrame) -> DataFrame:
    """Verdicts with ``source``: the saved path if that file is there, else the key if the store has it, else null.

    ``saved`` (saved_path) and ``stored`` (s3_key) list what is there; each is met once.
    """
    have = lambda t, c, n: t.select(c).where(F.col(c).isNotNull()).distinct().withColumn(n, F.lit(True))
    v = verdicts.join(have(saved, "saved_path", "_saved"), "saved_path", "left").join(have(stored, "s3_key", "_stored"), "s3_key", "left")
    return v.withColumn("source", F.when(F.col("_saved"), F.col("saved_path")).when(F.col("_stored"), F.col("s3_key"))).drop("_saved", "_stored")


def from_paths(spark: SparkSession, root: str, label: str, group: str | None = None) -> DataFrame:
    """(path, label, grp, filename, content): PDFs at or below a path, of one label; their group is given, or the folder's name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    keep = F.lower(name).endswith(".pdf") if root.lower().endswith(".pdf") else name.endswith(".pdf")
    grp = F.lit(group) if group else F.element_at(F.split("path", "/"), -2)
    return files.where(keep).select("path", label_folder(F.lit(label), strict=True).alias("label"), grp.alias("grp"), name.alias("filename"), "content")


def retrained(verdicts: DataFrame, existing: DataFrame, train: Callable[[DataFrame], dict]) -> tuple[dict, dict | None]:
    """(breakdown, report): the model is trained anew, on the old records and the new copies, only if anything was copied."""
    done = outcomes(verdicts, existing)
    told = breakdown(done).first().asDict()
    if not told["copied"]:
        return told, None
    return told, train(existing.select("label", "grp", "filename").unionByName(done.where("copied").select("label", "grp", "filename")))
