"""Problem 2: train, validation and test splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cluster import durable
from .components import mate_components

DEFAULT = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def slug(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def entities(records: DataFrame, group: Column, label: Column, links: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """(slug, root) for every group of records or links, and (slug, label class, count) of the records.

    Groups joined by a chain of links share a root, found by random-mate contraction.  Records are
    counted by group and label before anything else, so a hot group is one row.
    """
    weight = durable(
        records.select(group.alias("slug"), F.coalesce(label.cast("string"), F.lit("none")).alias("label"))
        .where("slug is not null").groupBy("slug", "label").agg(F.count("*").alias("n"))
    )
    own = weight.select(F.col("slug").alias("a"), F.col("slug").alias("b")).distinct()
    pairs = links.select(slug(links[a]).alias("a"), slug(links[b]).alias("b")).where("a is not null and b is not null")
    roots = mate_components(own.union(pairs)).select(F.col("id").alias("slug"), "root")
    return durable(roots), weight


def assign_splits(roots: DataFrame, weight: DataFrame, shares=DEFAULT, large: float = 0.002, strata: int = 5, buckets: int = 1024) -> DataFrame:
    """(root, split): whole components placed by cumulative weight, balanced by label.

    Components with more than ``large`` of all records (at most 1 / large of them, so the driver
    can hold them) go one by one, largest first, to the split that lacks most of their labels.
    All others are ordered within strata of like label mix, and cut where their cumulative weight
    passes the shares still open.  The running sum is taken within hash buckets on top of the
    buckets' totals, so no task sees all components.
    """
    comp = durable(
        weight.join(roots, "slug").groupBy("root").pivot("label", ["0", "1", "none"]).agg(F.sum("n")).na.fill(0)
        .withColumn("n", F.col("0") + F.col("1") + F.col("none"))
    )
    names = [s for s, _ in shares]
    labels = ["0", "1", "none"]
    sums = comp.agg(*[F.sum(F.col(x)).alias(x) for x in [*labels, "n"]]).first()
    total = {x: sums[x] or 0 for x in labels}
    everything = sums["n"] or 0
    lack = {s: {x: share * total[x] for x in labels} for s, share in shares}
    placed = []
    for r in comp.where(F.col("n") > large * everything).orderBy(F.desc("n"), "root").collect():
        def gain(s):
            return sum(min(r[x], max(0.0, lack[s][x])) for x in labels), sum(lack[s].values())
        best = max(names, key=gain)
        placed.append((r["root"], best))
        for x in labels:
            lack[best][x] -= r[x]
    spark = comp.sparkSession
    fixed = spark.createDataFrame(placed, "root string, split string")
    small = comp.where(F.col("n") <= large * everything).withColumn(
        "stratum", F.least(F.lit(strata - 1), F.floor(strata * F.col("1") / F.greatest(F.lit(1), F.col("0") + F.col("1"))))
    ).withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(buckets)))
    per = small.groupBy("stratum", "bucket").agg(F.sum("n").alias("m"))
    before = per.select("stratum", "bucket", (F.sum("m").over(W.partitionBy("stratum").orderBy("bucket")) - F.col("m")).alias("base"),
                        F.sum("m").over(W.partitionBy("stratum")).alias("all"))
    run = small.join(F.broadcast(before), ["stratum", "bucket"]).withColumn(  # strata * buckets rows at most
        "mid", F.col("base") + F.sum("n").over(W.partitionBy("stratum", "bucket").orderBy(F.xxhash64("root", F.lit(1)), "root")) - F.col("n") / 2)
    gap = {x: {s: max(0.0, lack[s][x]) for s in names} for x in labels}
    choose = F.lit(names[-1])
    for k in range(strata):
        q = (k + 0.5) / strata  # labelled 1 by this share: what a split lacks of either label counts accordingly
        part = {s: sum(w * gap[x][s] / (sum(gap[x].values()) or 1.0) for x, w in (("1", q), ("0", 1 - q))) for s in names}
        whole = sum(part.values()) or 1.0
        cut, own = 0.0, F.lit(names[-1])
        for s in reversed(names[:-1]):
            cut = sum(part[x] for x in names[:names.index(s) + 1]) / whole
            own = F.when(F.col("mid") < F.lit(cut) * F.col("all"), s).otherwise(own)
        choose = F.when(F.col("stratum") == k, own).otherwise(choose)
    return fixed.union(run.select("root", choose.alias("split")))


def split_records(records: DataFrame, id_col: str, group: Column, label: Column, links: DataFrame, a: str, b: str, shares=DEFAULT) -> DataFrame:
    """(id, slug, root, split) of every record with a group.

    Records of one group, and of groups linked directly or through others, share a split.  Null
    labels count as a class of their own.  Null, empty, reversed, repeated and self links are
    harmless.  Records without any group stand alone under a name made of their id.
    """
    own = F.coalesce(group, F.concat(F.lit("\u0000record "), records[id_col].cast("string")))
    roots, weight = entities(records, own, label, links, a, b)
    placed = assign_splits(roots, weight, shares)
    where = roots.join(placed, "root")
    return records.select(records[id_col].alias("id"), own.alias("slug")).join(where, "slug").select("id", "slug", "root", "split")


def linked_pairs(roots: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    """All pairs (slug_a < slug_b) of different linked groups that are one entity."""
    pairs = links.select(slug(links[a]).alias("a"), slug(links[b]).alias("b")).where("a is not null and b is not null")
    named = pairs.select(F.col("a").alias("slug")).union(pairs.select(F.col("b").alias("slug"))).distinct()
    m = roots.join(named, "slug", "left_semi")
    return m.select("root", F.col("slug").alias("slug_a")).join(m.select("root", F.col("slug").alias("slug_b")), "root").where(
        "slug_a < slug_b").select("slug_a", "slug_b")
