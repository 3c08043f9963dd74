"""Best-first crawling over a table of fetched pages, as rounds of DataFrame steps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import urls
from ..session import durable
from .profiles import Profile

@dataclass(frozen=True)
class Limits:
    depth: int = 2
    pages: int = 60
    sitemap_urls: int = 50
    child_sitemaps: int = 10
    subdomain_sitemaps: int = 15
    items: int = 200
    requests: int = 400
    per_round: int = 8


def longest_anchors(links: DataFrame) -> DataFrame:
    """(page, url, anchor, pos): the longest non-empty anchor text of each URL of a page, the first of equal ones."""
    return links.where(F.length("anchor") > 0).groupBy("page", "url").agg(
        F.max_by("anchor", F.struct(F.length("anchor"), -F.col("pos"))).alias("anchor"), F.min("pos").alias("pos"))


def candidates(links: DataFrame, assets: DataFrame | None) -> DataFrame:
    """Anchored links, and assets (page, url, pos) of URLs without one, with an empty anchor."""
    best = longest_anchors(links)
    if assets is None:
        return best
    rest = assets.groupBy("page", "url").agg(F.min("pos").alias("pos")).join(best, ["page", "url"], "left_anti")
    return best.unionByName(rest.withColumn("anchor", F.lit("")))


def routed(cands: DataFrame, profile: Profile, seed: str = "seed", depth: str = "depth", max_depth: int = 2) -> DataFrame:
    """Candidates with score, kind ('target' or 'page'), next depth and priority; all others dropped.

    Targets must lie on the seed's site; a target elsewhere is dropped, not followed.  A page on
    another subdomain with a positive score starts again at depth 0.
    """
    u, s = F.col("url"), F.col(seed)
    c = cands.withColumn("score", profile.score(u, F.col("anchor"))).withColumn("target", profile.is_target(u))
    c = c.withColumn("site", urls.same_site(u, s))
    hop = (urls.netloc(u) != urls.netloc(F.col("page"))) & (F.col("score") > 0)
    c = c.withColumn("hop", hop)
    kind = F.when(F.col("target"), F.when(F.col("site"), F.lit("target"))).when(
        urls.is_followable(u, s) & (F.col("hop") | (F.col(depth) < max_depth)), F.lit("page"))
    return c.withColumn("kind", kind).where("kind is not null").withColumn(
        "next_depth", F.when(F.col("kind") == "target", F.col(depth)).when(F.col("hop"), 0).otherwise(F.col(depth) + 1)).withColumn(
        "priority", F.when(F.col("kind") == "target", 1000 + F.col("score")).when(F.col("hop"), F.col("score") + 50).otherwise(F.col("score")))


def top_links(cands: DataFrame, k: int, part: str = "page") -> DataFrame:
    """The k best links of each page with a positive score: planned as a window group limit."""
    w = W.partitionBy(part).orderBy(F.desc("score"), "pos")
    return cands.where("score > 0").withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def sitemap_requests(locs: DataFrame, profile: Profile, max_depth: int, limits: Limits) -> DataFrame:
    """Requests from sitemap entries (seed, sitemap, url, pos, is_index, sitemap_depth).

    An index gives its most promising child sitemaps, down to two levels; a list of pages gives all
    documents and the most promising pages with a positive score, both on the seed's site only.
    """
    c = locs.withColumn("url", F.trim("url")).where("url <> ''").withColumn("score", profile.score(F.col("url"), F.lit("")))
    c = c.where(F.col("is_index") | urls.same_site(F.col("url"), F.col("seed"))).withColumn("target", ~F.col("is_index") & profile.is_target(F.col("url")))
    kinds = W.partitionBy("seed", "sitemap", "is_index", "target").orderBy(F.desc("score"), "pos")
    place = F.row_number().over(kinds)
    ranked = c.where("is_index or target or score > 0").withColumn("place", place)
    child = F.col("is_index") & (F.col("sitemap_depth") < 2) & (F.col("place") <= limits.child_sitemaps)
    page = ~F.col("is_index") & ~F.col("target") & (F.col("place") <= limits.sitemap_urls)
    kind = F.when(child, "sitemap").when(F.col("target"), "target").when(page, "page")
    return ranked.withColumn("kind", kind).where("kind is not null").select(
        "seed", "sitemap", "url", "pos", "kind",
        F.when(F.col("kind") == "page", F.lit(max(0, max_depth - 1))).when(F.col("kind") == "sitemap", F.col("sitemap_depth") + 1).otherwise(0).alias("depth"),
        F.when(F.col("kind") == "sitemap", 50).when(F.col("kind") == "target", 1000 + F.col("score")).otherwise(F.col("score")).alias("priority"))


def _origin(url):
    return F.concat(urls.scheme(url), F.lit("://"), urls.netloc(url))


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], profile: Profile, limits: Limits = Limits(),
          locate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(seed, url, kind, depth, source_page, round): what a crawl of each seed requests, in rounds.

    ``fetch`` takes (url) and returns links (page, url, anchor, pos), and if it has a column
    ``asset`` the resources a page embeds, which count as links without an anchor.  A page without
    links, or no page at all, is charged to the budget and gives nothing.  ``locate``, if given,
    takes (url) of sitemaps and robots files and returns (sitemap, url, pos, is_index); of a robots
    file, the sitemaps it names.  The seed's host, and each further host a promising link leads to
    (up to ``subdomain_sitemaps``, the seed's among them), has its sitemap asked for once.

    Each round pops the best ``per_round`` requests of each seed by (priority desc, seq); with 1 it
    is a sequential best-first crawl.  URLs are requested once a seed, by their normalised form.
    Pages, or documents, whose budget is spent leave the frontier and take no round.
    """
    spark = seeds.sparkSession
    u = F.col("url")
    first = seeds.select(u.alias("seed"), "url", F.lit("page").alias("kind"), F.lit(0).alias("priority"), F.lit(0).alias("rank"))
    if locate:
        for n, (name, kind) in enumerate((("/sitemap.xml", "sitemap"), ("/robots.txt", "robots")), 1):
            first = first.unionByName(seeds.select(u.alias("seed"), F.concat(_origin(u), F.lit(name)).alias("url"), F.lit(kind).alias("kind"), F.lit(60).alias("priority"), F.lit(n).alias("rank")))
    frontier = first.select("seed", "url", "kind", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("source_page"), "priority",
                            F.col("rank").cast("bigint").alias("seq"), urls.normalize_url(u).alias("key"))
    frontier = durable(frontier.dropDuplicates(["seed", "key"]))
    seen = frontier.select("seed", "key")
    hosts = durable(seeds.select(u.alias("seed"), urls.netloc(u).alias("host")).distinct())
    spent = spark.createDataFrame([], "seed string, n_pages bigint, n_items bigint, n_all bigint")
    out = None
    turn = 0
    while not frontier.isEmpty():
        w = W.partitionBy("seed").orderBy(F.desc("priority"), "seq")
        popped = durable(frontier.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limits.per_round))
        wk = W.partitionBy("seed", "kind").orderBy("_n")
        had = lambda c: F.coalesce(c, F.lit(0))
        within = F.when(F.col("kind") == "page", had("n_pages") + F.col("_k") <= limits.pages).when(F.col("kind") == "target", had("n_items") + F.col("_k") <= limits.items).otherwise(True)
        allowed = popped.join(spent, "seed", "left").withColumn("_k", F.row_number().over(wk)).where(within & (had("n_all") + F.col("_n") <= limits.requests))
        allowed = durable(allowed.select(*frontier.columns, F.lit(turn).alias("round")))
        out = allowed if out is None else out.unionByName(allowed)
        now = allowed.groupBy("seed").agg(F.count_if(F.col("kind") == "page").alias("n_pages"), F.count_if(F.col("kind") == "target").alias("n_items"), F.count("*").alias("n_all"))
        spent = durable(spent.unionByName(now).groupBy("seed").agg(*[F.sum(c).alias(c) for c in ("n_pages", "n_items", "n_all")]))

        pages = allowed.where("kind = 'page'").select("seed", F.col("url").alias("page"), "depth", F.col("seq").alias("page_seq"))
        links = fetch(pages.select(F.col("page").alias("url")).distinct())
        assets = links.where("asset").select("page", "url", "pos") if "asset" in links.columns else None
        plain = links.where("not asset").drop("asset") if assets is not None else links
        found = routed(candidates(plain, assets).join(pages, "page"), profile, max_depth=limits.depth).select(
            "seed", "url", "kind", F.col("next_depth").alias("depth"), F.col("page").alias("source_page"), F.col("priority").cast("int").alias("priority"),
            "page_seq", "score", "pos", "hop")
        if locate:
            found, hosts = _with_sitemaps(found, allowed, hosts, locate, profile, limits)
        found = found.withColumn("key", urls.normalize_url(u)).join(seen, ["seed", "key"], "left_anti")
        once = W.partitionBy("seed", "key").orderBy(F.desc("priority"), "page_seq", "pos")
        found = found.withColumn("_f", F.row_number().over(once)).where("_f = 1")
        order = W.partitionBy("seed").orderBy("page_seq", F.desc("score"), "pos", "url")
        fresh = durable(found.select("seed", "url", "kind", "depth", "source_page", "priority",
                                     (F.row_number().over(order) + F.lit(turn + 1) * F.lit(2**40)).cast("bigint").alias("seq"), "key"))
        seen = durable(seen.union(fresh.select("seed", "key")))
        open_ = frontier.join(popped.select("seed", "key"), ["seed", "key"], "left_anti").unionByName(fresh)
        # What a spent budget would refuse is not popped round by round: the rounds follow the budgets, not the frontier.
        kept = (had("n_all") < limits.requests) & F.when(F.col("kind") == "page", had("n_pages") < limits.pages).when(F.col("kind") == "target", had("n_items") < limits.items).otherwise(True)
        frontier = durable(open_.join(spent, "seed", "left").where(kept).select(*frontier.columns))
        turn += 1
    return out.select("seed", "url", "kind", "depth", "source_page", "round") if out is not None else spark.createDataFrame([], "seed string, url string, kind string, depth int, source_page string, round int")


def _with_sitemaps(found: DataFrame, allowed: DataFrame, hosts: DataFrame, locate: Callable, profile: Profile, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """What the pages of a round gave, with what its sitemaps and robots files name and the sitemaps of hosts met first."""
    maps = allowed.where("kind in ('sitemap', 'robots')").select("seed", F.col("url").alias("sitemap"), "kind", F.col("depth").alias("sitemap_depth"), F.col("seq").alias("page_seq"))
    locs = locate(maps.select(F.col("sitemap").alias("url")).distinct()).join(maps, "sitemap")
    more = sitemap_requests(locs.where("kind = 'sitemap'"), profile, limits.depth, limits).join(maps.select("seed", "sitemap", "page_seq"), ["seed", "sitemap"])
    source = F.when(F.col("kind") == "target", F.col("sitemap"))
    more = more.select("seed", "url", "kind", F.col("depth").cast("int").alias("depth"), source.alias("source_page"), F.col("priority").cast("int").alias("priority"),
                       "page_seq", F.col("priority").alias("score"), "pos", F.lit(False).alias("hop"))
    named = locs.where("kind = 'robots' and trim(url) <> ''").select(
        "seed", F.trim("url").alias("url"), F.lit("sitemap").alias("kind"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("source_page"), F.lit(50).alias("priority"),
        "page_seq", F.lit(0).alias("score"), "pos", F.lit(False).alias("hop"))
    met = found.where("kind = 'page' and hop").withColumn("host", urls.netloc(F.col("url"))).where("host <> ''")
    met = met.groupBy("seed", "host").agg(F.min(F.struct("page_seq", (-F.col("score")).alias("s"), "pos", "url")).alias("m")).join(hosts, ["seed", "host"], "left_anti")
    count = hosts.groupBy("seed").agg(F.count("*").alias("n"))
    met = durable(met.join(count, "seed").withColumn("_r", F.row_number().over(W.partitionBy("seed").orderBy("m"))).where(F.col("n") + F.col("_r") <= limits.subdomain_sitemaps))
    asked = met.select("seed", F.concat(_origin(F.col("m.url")), F.lit("/sitemap.xml")).alias("url"), F.lit("sitemap").alias("kind"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("source_page"),
                       F.lit(55).alias("priority"), F.col("m.page_seq").alias("page_seq"), F.lit(0).alias("score"), F.col("m.pos").alias("pos"), F.lit(False).alias("hop"))
    return found.unionByName(more).unionByName(named).unionByName(asked), durable(hosts.unionByName(met.select("seed", "host")))


def closure(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """(node, depth): nodes within ``max_depth`` steps of a seed, at their least depth."""
    e = edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct()
    seen = durable(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    edge = seen
    for d in range(1, max_depth + 1):
        edge = durable(edge.join(e, edge["node"] == e["a"]).select(F.col("b").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(d)))
        if edge.isEmpty():
            break
        seen = seen.unionByName(edge)
    return seen
