"""Connected components with SQL joins: random-mate contraction, and star rounds for small sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import durable


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root) for each vertex of ``edges(a, b)``; root is the smallest id of the component.

    Alternating large-star and small-star rounds: each round links all larger neighbours of a
    vertex to its smallest one, then all others.  Neither step makes more rows than there are
    edges, and the aggregation is a plain partial ``min``; a hub's edges spread over tasks by
    their other end.  Edges with a null end or equal ends are ignored.  No edges: no rows.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    e = durable(e)
    before = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        keep = e.join(low.select(F.col("u").alias("v"), F.col("m")), "v").select("u", F.col("m").alias("v"))
        large = large.union(keep).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        ).where("u <> v").distinct()
        e = durable(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("id"), "root").union(
        e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )


def mate_components(edges: DataFrame, seed: int = 11, max_rounds: int = 200) -> DataFrame:
    """(id, root) for each vertex of ``edges(a, b)`` by random-mate contraction.

    Each round every vertex tosses a coin (a hash of vertex and round); each tail with a head
    neighbour collapses into its smallest head neighbour, edges are renamed and loops dropped,
    until no edge is left.  The rounds' hooks are then unwound from last to first, so every
    vertex ends at the vertex its component collapsed into; roots are named after the
    component's smallest id.  Null ends are ignored, a loop makes a component of one.
    """
    raw = edges.where("a is not null and b is not null").select("a", "b")
    verts = durable(raw.select(F.col("a").alias("id")).union(raw.select(F.col("b").alias("id"))).distinct())
    e = durable(raw.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    hooks: list[DataFrame] = []
    for turn in range(max_rounds):
        if e.isEmpty():
            break
        coin = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(seed), F.lit(turn)), F.lit(2)) == 1
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = durable(both.where(~coin("a") & coin("b")).groupBy(F.col("a").alias("child")).agg(F.min("b").alias("into")))
        hooks.append(hook)
        ha, hb = (hook.select(F.col("child").alias(c), F.col("into").alias(f"to_{c}")) for c in "ab")
        e = durable(
            e.join(ha, "a", "left").join(hb, "b", "left")
            .select(F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"))
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    else:
        raise RuntimeError("components did not settle")
    # A vertex hooks in one round only: it is gone afterwards.  Unwinding from the last round back,
    # the root of what it hooked into is known already.
    known = None
    for hook in reversed(hooks):
        if known is None:
            known = hook.select(F.col("child").alias("id"), F.col("into").alias("root"))
        else:
            step = hook.join(known.select(F.col("id").alias("into"), "root"), "into", "left").select(
                F.col("child").alias("id"), F.coalesce("root", "into").alias("root"))
            known = durable(known.union(step))
    if known is None:
        return verts.select("id", F.col("id").alias("root"))
    full = verts.join(known, "id", "left").select("id", F.coalesce("root", "id").alias("r"))
    name = full.groupBy("r").agg(F.min("id").alias("root"))
    return full.join(name, "r").select("id", "root")
