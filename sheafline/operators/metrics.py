"""Metrics and thresholds of scored labels, each from one row a distinct score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import durable

BUCKETS = 64


def by_score(scored: DataFrame) -> DataFrame:
    """(s, n, p): rows and positives of each distinct score; nulls dropped."""
    return scored.where("s is not null and y is not null").groupBy("s").agg(F.count("*").alias("n"), F.sum(F.col("y").cast("bigint")).alias("p"))


def curve(scored: DataFrame) -> DataFrame:
    """(s, n, p, cn, cp, all_n, all_p): running counts over scores from high to low.

    Scores are cut into value ranges first; each range is summed on its own, and only the ranges'
    totals are summed across, so no task sorts all scores.
    """
    d = by_score(scored)
    span = d.agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    b = d.crossJoin(F.broadcast(span)).withColumn("b", F.when(F.col("hi") > F.col("lo"), F.floor((F.col("hi") - F.col("s")) / (F.col("hi") - F.col("lo")) * BUCKETS)).otherwise(0))
    per = b.groupBy("b").agg(F.sum("n").alias("bn"), F.sum("p").alias("bp"))
    up = W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("b").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = per.select("b", F.coalesce(F.sum("bn").over(up), F.lit(0)).alias("n0"), F.coalesce(F.sum("bp").over(up), F.lit(0)).alias("p0"),
                        F.sum("bn").over(every).alias("all_n"), F.sum("bp").over(every).alias("all_p"))  # BUCKETS + 1 rows
    w = W.partitionBy("b").orderBy(F.desc("s"))
    return b.join(F.broadcast(before), "b").select(
        "s", "n", "p", (F.col("n0") + F.sum("n").over(w)).alias("cn"), (F.col("p0") + F.sum("p").over(w)).alias("cp"), "all_n", "all_p")


def pr_curve(scored: DataFrame) -> DataFrame:
    return curve(scored).select("s", (F.col("cp") / F.col("cn")).alias("precision"), (F.col("cp") / F.greatest(F.col("all_p"), F.lit(1))).alias("recall"))


def average_precision(scored: DataFrame) -> DataFrame:
    """One row: the sum of precision times the gain of recall over distinct scores; 0 without positives."""
    step = F.col("p") / F.greatest(F.col("all_p"), F.lit(1)) * F.col("cp") / F.col("cn")
    return curve(scored).agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row: the share of positive-negative pairs in the right order, ties counting half; null if a class is missing."""
    below = F.col("all_n") - F.col("cn") - (F.col("all_p") - F.col("cp"))
    own = F.col("n") - F.col("p")
    pairs = F.col("p") * below + F.col("p") * own * 0.5
    good = F.sum(pairs)
    pos, neg = F.max("all_p"), F.max(F.col("all_n") - F.col("all_p"))
    return curve(scored).agg(F.when((pos > 0) & (neg > 0), good / (pos * neg)).alias("roc_auc"))


def fbeta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b = beta * beta
    bottom = (1 + b) * tp + b * fn + fp
    return F.when(bottom == 0, F.lit(0.0)).otherwise((1 + b) * tp / F.nullif(bottom, F.lit(0)))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row: tn, fp, fn, tp, precision, recall, f1, f2 at ``score >= threshold``; ratios 0 where undefined."""
    hit, pos = F.col("s") >= threshold, F.col("y") == 1
    c = scored.where("s is not null and y is not null").agg(
        F.count_if(~hit & ~pos).alias("tn"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"), F.count_if(hit & pos).alias("tp"))
    ratio = lambda a, b: F.when(F.col(a) + F.col(b) == 0, F.lit(0.0)).otherwise(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)))
    return c.select("tn", "fp", "fn", "tp", F.round(ratio("tp", "fp"), 4).alias("precision"), F.round(ratio("tp", "fn"), 4).alias("recall"),
                    F.round(fbeta(F.col("tp"), F.col("fp"), F.col("fn"), 1.0), 4).alias("f1"), F.round(fbeta(F.col("tp"), F.col("fp"), F.col("fn"), 2.0), 4).alias("f2"))


def threshold_for_recall(scored: DataFrame, target: float, on: DataFrame | None = None) -> DataFrame:
    """One row: the highest score whose recall reaches the target, else the lowest score; 0 for no rows.

    ``on`` is the curve of the scores, if it was made already.
    """
    c = curve(scored) if on is None else on
    ok = F.col("cp") >= F.lit(target) * F.greatest(F.col("all_p"), F.lit(1))
    return c.agg(F.coalesce(F.max(F.when(ok, F.col("s"))), F.min("s"), F.lit(0.0)).alias("threshold"))


def threshold_for_precision(scored: DataFrame, target: float, on: DataFrame | None = None) -> DataFrame:
    """One row: from the highest score with the target precision down, the last before it is first lost; null if never.

    The curve is made once and written; the three look-ups read one row a distinct score.
    """
    c = (durable(curve(scored)) if on is None else on).select("s", (F.col("cp") / F.col("cn") >= target).alias("hit"))
    top = c.where("hit").agg(F.max("s").alias("top"))
    lost = c.crossJoin(F.broadcast(top)).where("not hit and s < top").agg(F.max("s").alias("lost"))
    return c.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(lost)).where("hit and s <= top and (lost is null or s > lost)").agg(F.min("s").alias("threshold"))


def thresholds(scored: DataFrame, recall: float = 0.95, precision: float = 0.95, fallback: float = 0.80) -> DataFrame:
    """One row: lower and upper threshold; upper falls back where precision is never reached or below lower."""
    c = durable(curve(scored))
    lower = threshold_for_recall(scored, recall, c).withColumnRenamed("threshold", "lower")
    upper = threshold_for_precision(scored, precision, c).withColumnRenamed("threshold", "upper")
    bad = F.col("upper").isNull() | (F.col("upper") < F.col("lower"))
    return lower.crossJoin(upper).select("lower", F.when(bad, F.greatest(F.col("lower"), F.lit(fallback))).otherwise(F.col("upper")).alias("upper"))
