"""Duplicates, metrics, review, jobs, roles, crawl and features on small cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sheafline.operators import crawl, dedup, features, ingest, jobs, metrics, model, predict, profiles, rbac, review

GOLD = [(1, 0.9)] * 212 + [(0, 0.9)] * 66 + [(1, 0.1)] * 11 + [(0, 0.1)] * 658


def frame(spark, rows):
    return spark.createDataFrame(rows, "y int, s double")


def test_first_wins_in_order_of_path_parts(spark):
    rows = [(1, "r/a-b/x", "h", 1, "g"), (2, "r/a/x", "h", 0, "g"), (3, "r/z", "", 1, "g"), (4, "r/y", None, 1, None), (5, "r/a/x2", "h", 1, "k")]
    df = spark.createDataFrame(rows, "id int, path string, h string, label int, grp string")
    order = [dedup.order_key(F.col("path"))]
    assert {r.id for r in dedup.first_wins(df, "h", order, ["id"]).collect()} == {2, 3, 4}
    c = dedup.conflicts(df, "h", order, "label", "grp").collect()
    assert [(r.n_dropped, r.n_conflicts) for r in c] == [(2, 2)]
    assert dedup.first_wins(df.limit(0), "h", order, ["id"]).count() == 0


def test_upsert_and_order(spark):
    a = spark.createDataFrame([("j", 1, "x"), ("j", 2, "y")], "job string, i int, v string")
    b = spark.createDataFrame([("j", 2, "z"), (None, 3, "n")], "job string, i int, v string")
    assert {tuple(r) for r in dedup.upsert(a, b, ["job", "i"]).collect()} == {("j", 1, "x"), ("j", 2, "z"), (None, 3, "n")}
    d = spark.createDataFrame([("b", 3), ("a", 2), ("b", 1), (None, 0)], "u string, p int")
    assert [tuple(r) for r in dedup.distinct_in_order(d, "u", F.col("p")).orderBy("pos").collect()] == [("b", 1), ("a", 2)]


def test_metrics_match_the_published_report(spark):
    r = metrics.confusion(frame(spark, GOLD), 0.3317).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (658, 66, 11, 212) and (r.precision, r.recall, r.f1, r.f2) == (0.7626, 0.9507, 0.8463, 0.906)


def brute(rows):
    pos = sum(y for y, _ in rows)
    ap, prev, tp, n = 0.0, 0.0, 0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp += sum(y for y, t in rows if t == s)
        n += sum(1 for _, t in rows if t == s)
        rec = tp / max(pos, 1)
        ap += (rec - prev) * tp / n
        prev = rec
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    auc = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs) if pairs else None
    return ap, auc


def recall_threshold(rows, target):
    pos, tp = max(sum(y for y, _ in rows), 1), 0
    for y, s in sorted(rows, key=lambda r: -r[1]):
        tp += y
        if tp / pos >= target:
            return s
    return min((s for _, s in rows), default=0.0)


def precision_threshold(rows, target):
    best = None
    for s in sorted({s for _, s in rows}, reverse=True):
        hit = [y for y, t in rows if t >= s]
        if sum(hit) / len(hit) >= target:
            best = s
        elif best is not None:
            break
    return best


@pytest.mark.parametrize("seed", range(4))
def test_curves_and_thresholds_against_loops(spark, seed):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1 + seed % 2)) for _ in range(60)]
    df = frame(spark, rows)
    ap, auc = brute(rows)
    assert abs(metrics.average_precision(df).first()[0] - ap) < 1e-9 and abs(metrics.roc_auc(df).first()[0] - auc) < 1e-9
    assert metrics.threshold_for_recall(df, 0.9).first()[0] == recall_threshold(rows, 0.9)
    for t in (0.3, 0.6, 0.99):
        assert metrics.threshold_for_precision(df, t).first()[0] == precision_threshold(rows, t)


def test_metrics_on_nothing_and_one_class(spark):
    none = frame(spark, [])
    assert metrics.average_precision(none).first()[0] == 0 and metrics.roc_auc(none).first()[0] is None and metrics.threshold_for_recall(none, 0.9).first()[0] == 0
    one = frame(spark, [(1, 0.5), (1, 0.5), (None, 0.2), (1, None)])
    assert metrics.roc_auc(one).first()[0] is None and metrics.average_precision(one).first()[0] == 1
    assert metrics.thresholds(frame(spark, [(0, 0.4), (1, 0.3)])).first().upper == 0.8


def test_decisions(spark):
    df = spark.createDataFrame([(0.6511,), (0.3317,), (0.5,), (None,)], "s double")
    assert [r[0] for r in df.select(predict.decide(F.col("s"))).collect()] == ["automatic_positive", "automatic_negative", "needs_review", "needs_review"]
    assert predict.resolve(0.3, 0.6, "0.9", "bad") == (0.6, 0.6)


def test_review(spark):
    m = spark.createDataFrame([(10, "j", "needs_review", None), (11, "j", "automatic_positive", 0.7), (12, "j", "automatic_negative", 0.1), (13, None, "needs_review", 0.5)],
                              "manifest_id int, job_id string, decision string, module_handbook_score double")
    f = spark.createDataFrame([(1, "j", 1, " Positive ", "a"), (2, "j", 1, "NEGATIVE", "b"), (3, "j", 0, "maybe", "c"), (4, "j", 9, "positive", "d")],
                              "feedback_id int, job_id string, line_index int, verdict string, reviewer string")
    got = {(r.manifest_id, r.place, r.verdict) for r in review.relevant(m, f).collect()}
    assert got == {(11, 1, "negative"), (10, 2, None), (13, 1, None)}
    assert {(r.job_id, r.total, r.reviewed) for r in review.decision_counts(m, f).collect()} == {("j", 3, 2), (None, 1, 0)}


def test_jobs(spark):
    v = spark.createDataFrame([("https://A.example/x/", "j1"), (None, "j2")], "url string, job_id string").withColumn("scraped_at", F.lit(None).cast("timestamp_ntz"))
    j = spark.createDataFrame([("https://a.example/x", 1), ("https://a.example/y", 2)], "url string, n int")
    assert [r.n for r in jobs.not_visited(j, v).collect()] == [2]
    assert [r.url_norm for r in jobs.visited_state(v).collect()] == ["https://a.example/x"]
    lines = spark.createDataFrame([(i, "== RUN" if i in (1, 4) else "x") for i in range(6)], "n int, v string")
    assert sorted(r.n for r in jobs.last_section(lines, "n", F.col("v").startswith("== RUN")).collect()) == [4, 5]
    reg = spark.createDataFrame([(str(i), i if i < 4 else None) for i in range(6)], "job_id string, f int")
    assert {r.job_id for r in jobs.prune_registry(reg, 4, F.col("f").isNotNull(), [F.col("f")]).collect()} == {"2", "3", "4", "5"}


def test_roles(spark):
    ur = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "user_id int, role_id int")
    mr = spark.createDataFrame([(7, 1), (7, 2), (8, 2)], "model_id int, role_id int")
    m = spark.createDataFrame([(7, "a"), (8, "b")], "model_id int, name string")
    assert {tuple(r)[:2] for r in rbac.user_models(ur, mr, m).select("user_id", "model_id").collect()} == {(1, 7), (1, 8), (2, 7), (2, 8)}
    ask = spark.createDataFrame([(1, 8), (2, 9), (1, 8)], "user_id int, model_id int")
    assert [tuple(r) for r in rbac.model_allowed(ask, ur, mr).collect()] == [(1, 8)]
    with pytest.raises(ValueError):
        rbac.insert_strict(ur, ur.limit(1), ["user_id", "role_id"])
    assert rbac.insert_or_ignore(ur, spark.createDataFrame([(1, 1), (3, 3), (3, 3)], "user_id int, role_id int"), ["user_id", "role_id"]).count() == 4
    names = rbac.get_or_create(spark.createDataFrame([(5, "x")], "id int, name string"), spark.createDataFrame([("y",), ("x",)], "name string"), "name", "id")
    assert {tuple(r) for r in names.collect()} == {(5, "x"), (6, "y")}
    assert rbac.delete_cascade(m, [mr], "model_id", m.where("model_id = 7"))[1].count() == 1
    assert {r.name for r in rbac.update_where(m, "model_id", m.where("model_id = 7"), "name", "z").collect()} == {"z", "b"}


def test_totals_of_users_are_the_pairs_counted(spark):
    """Over two blocks of models, with ids far apart, doubled rows, nulls and links to nothing."""
    models = spark.range(40_000).select((F.col("id") * 1_000_003 - 7_000_000_000).alias("model_id"), F.lit("m").alias("name"))
    mr = models.withColumn("role_id", F.explode(F.array((F.hash("model_id") % 5).cast("bigint"), F.lit(9).cast("bigint")))).where("role_id <> 9 or model_id % 7 = 0").select("model_id", "role_id")
    mr = mr.unionByName(spark.createDataFrame([(None, 1), (1, 1), (2, None)], "model_id bigint, role_id bigint")).unionByName(mr.where("role_id = 2"))
    ur = spark.createDataFrame([(1, 1), (1, 1), (1, 9), (2, 3), (2, -3), (2, 4), (3, 77), (None, 0), (4, None), (5, 0), (5, 1), (5, 2), (5, 3), (5, 4), (5, -1), (5, -2), (5, -3), (5, -4)], "user_id int, role_id bigint")
    want = rbac.user_models(ur, mr, models).groupBy("user_id").agg(F.count("*").alias("n_models"), F.sum("model_id").alias("model_sum"))
    got = rbac.user_model_totals(ur, mr, models)
    assert got.dtypes == want.dtypes
    got = {tuple(r) for r in got.collect()}
    assert got == {tuple(r) for r in want.collect()} and {r[0] for r in got} == {1, 2, 5, None} and (5, 40_000) in {r[:2] for r in got}
    assert rbac.user_model_totals(ur, mr, models.limit(0)).collect() == []


def test_totals_of_users_move_packed_links(spark, monkeypatch):
    """No checkpoint has a row a link or a bitmap a role and block; roles lie over many blocks."""
    models = spark.range(5_000).select((F.col("id") * 3).alias("model_id"), F.lit("m").alias("name"))
    mr = models.select("model_id", F.explode(F.array(*[F.pmod(F.hash("model_id", F.lit(i)), F.lit(300)) for i in range(3)])).alias("role_id"))
    ur = spark.range(6_000).select((F.col("id") % 400).alias("user_id"), F.pmod(F.hash("id"), F.lit(300)).alias("role_id"))
    want = {tuple(r) for r in rbac.user_models(ur, mr, models).groupBy("user_id").agg(F.count("*"), F.sum("model_id")).collect()}
    rows, real = [], rbac.durable

    def durable(df):
        out = real(df)
        if "model_id" not in out.columns:
            rows.append(out.count())
        return out

    monkeypatch.setattr(rbac, "durable", durable)
    assert {tuple(r) for r in rbac.user_model_totals(ur, mr, models).collect()} == want
    assert max(rows) < 300, rows
    monkeypatch.setattr(rbac, "TASK_ROWS", 300)
    assert {tuple(r) for r in rbac.user_model_totals(ur, mr, models, chunk=100).collect()} == want
    monkeypatch.setattr(rbac, "_layout", lambda *_: (7, 2))
    assert {tuple(r) for r in rbac.user_model_totals(ur, mr, models, chunk=100).collect()} == want
    monkeypatch.setattr(rbac, "SENT_ROWS", 0)  # every link to every block
    assert {tuple(r) for r in rbac.user_model_totals(ur, mr, models, chunk=100).collect()} == want


def test_longest_anchor(spark):
    rows = [("p", "u", "ab", 2), ("p", "u", "cd", 1), ("p", "u", "", 0), ("p", "e", "", 3), ("p", "v", "x", 4)]
    links = spark.createDataFrame(rows, "page string, url string, anchor string, pos int")
    assert {tuple(r) for r in crawl.longest_anchors(links).select("url", "anchor", "pos").collect()} == {("u", "cd", 1), ("v", "x", 4)}
    assets = spark.createDataFrame([("p", "u", 9), ("p", "i", 8)], "page string, url string, pos int")
    assert {r.url: r.anchor for r in crawl.candidates(links, assets).collect()} == {"u": "cd", "v": "x", "i": ""}


def test_crawl_respects_depth_site_and_budget(spark):
    s = "https://www.u.example/"
    web = [(s, s + "a", "Studium", 0), (s, s + "m.pdf", "Modulhandbuch", 1), (s, "https://other.example/x.pdf", "x", 2), (s + "a", s + "b", "b", 0), (s + "b", s + "c", "c", 0), (s + "c", s + "d", "d", 0),
           (s + "a", "https://sub.u.example/modul", "Modul", 1), ("https://sub.u.example/modul", "https://sub.u.example/k.docx", "k", 0), (s + "a", s, "back", 5)]
    links = spark.createDataFrame(web, "page string, url string, anchor string, pos int")
    fetch = lambda u: links.join(u.withColumnRenamed("url", "page"), "page", "left_semi")
    seeds = spark.createDataFrame([(s,)], "url string")
    got = {r.url: (r.kind, r.depth) for r in crawl.crawl(seeds, fetch, profiles.PROFILES["modulhandbuch"], crawl.Limits(depth=2)).collect()}
    assert got == {s: ("page", 0), s + "a": ("page", 1), s + "m.pdf": ("target", 0), s + "b": ("page", 2), "https://sub.u.example/modul": ("page", 0), "https://sub.u.example/k.docx": ("target", 0)}
    small = crawl.crawl(seeds, fetch, profiles.PROFILES["modulhandbuch"], crawl.Limits(depth=2, pages=2, per_round=1)).collect()
    assert sum(r.kind == "page" for r in small) == 2


def test_crawl_takes_no_rounds_for_what_a_spent_budget_refuses(spark):
    s = "https://www.u.example/"
    web = [(s, s + f"m{i}.pdf", "Modul", i) for i in range(20)] + [(s, s + f"p{i}", "Modul", 20 + i) for i in range(20)] + [(s + "p0", s + "deep", "x", 0)]
    links = spark.createDataFrame(web, "page string, url string, anchor string, pos int")
    rounds = []

    def fetch(u):
        rounds.append(1)
        return links.join(u.withColumnRenamed("url", "page"), "page", "left_semi")

    got = crawl.crawl(spark.createDataFrame([(s,)], "url string"), fetch, profiles.PROFILES["modulhandbuch"], crawl.Limits(items=5, pages=3, per_round=5)).collect()
    assert {r.url for r in got} == {s, s + "p0", s + "p1", *(s + f"m{i}.pdf" for i in range(5))}
    assert len(rounds) == 3


def sequential(seed, pages, maps, profile_score, limits):
    """A best-first crawl in a loop: (url, kind, depth) in order."""
    from urllib.parse import urlsplit

    base = lambda u: ".".join(urlsplit(u).netloc.split(".")[-2:])
    origin = lambda u: "{0.scheme}://{0.netloc}".format(urlsplit(u))
    target = lambda u: u.endswith((".pdf", ".doc", ".docx"))
    queue, seen, hosts, out = [], set(), {urlsplit(seed).netloc}, []

    def push(new):
        best = {}
        for n, (url, kind, depth, prio) in enumerate(new):
            k = url.rstrip("/")
            if k not in seen and (k not in best or prio > best[k][1][3]):
                best[k] = (n, (url, kind, depth, prio))
        for _, (url, kind, depth, prio) in sorted(best.values()):
            seen.add(url.rstrip("/"))
            queue.append((-prio, len(seen), url, kind, depth))

    push([(seed, "page", 0, 0), (origin(seed) + "/sitemap.xml", "sitemap", 0, 60), (origin(seed) + "/robots.txt", "robots", 0, 60)])
    n_pages = 0
    while queue:
        queue.sort()
        _, _, url, kind, depth = queue.pop(0)
        if kind == "page" and n_pages >= limits.pages:
            continue
        out.append((url, kind, depth))
        new = []
        if kind == "page":
            n_pages += 1
            ranked = sorted(((-profile_score(u, a), n, u, a) for n, (u, a) in enumerate(pages.get(url, []))))
            for minus, _, u, a in ranked:
                score = -minus
                if base(u) != base(seed):
                    continue
                hop = urlsplit(u).netloc != urlsplit(url).netloc and score > 0
                if target(u):
                    new.append((u, "target", depth, 1000 + score))
                elif hop or depth < limits.depth:
                    new.append((u, "page", 0 if hop else depth + 1, score + 50 if hop else score))
                    host = urlsplit(u).netloc
                    if hop and host not in hosts and len(hosts) < limits.subdomain_sitemaps:
                        hosts.add(host)
                        new.append((origin(u) + "/sitemap.xml", "sitemap", 0, 55))
        elif kind == "sitemap":
            index, locs = maps.get(url, (False, []))
            ranked = sorted((-profile_score(u, ""), n, u) for n, u in enumerate(locs))
            if index:
                new += [(u, "sitemap", depth + 1, 50) for _, _, u in ranked[:limits.child_sitemaps]] if depth < 2 else []
            else:
                own = [(-m, u) for m, _, u in ranked if base(u) == base(seed)]
                new += [(u, "target", 0, 1000 + x) for x, u in own if target(u)]
                new += [(u, "page", max(0, limits.depth - 1), x) for x, u in own if not target(u) and x > 0][:limits.sitemap_urls]
        elif kind == "robots":
            new += [(u, "sitemap", 0, 50) for u in maps.get(url, (False, []))[1]]
        push(new)
    return out


def test_crawl_with_sitemaps_is_the_sequential_crawl(spark):
    s = "https://www.u.example/"
    pages = {
        s: [(s + "studium", "Studium"), (s + "news", "News"), ("https://fb1.u.example/module", "Module"), (s + "modulhandbuch.pdf", "Modulhandbuch"), ("https://else.example/modul.pdf", "x")],
        s + "studium": [(s + "studium/bachelor", "Bachelor"), ("https://fb2.u.example/lehre", "Lehre"), (s + "logo.png", "Logo")],
        s + "studium/bachelor": [(s + "tief", "Modul tief"), (s + "ordnung.docx", "Ordnung")], "https://fb1.u.example/module": [("https://fb1.u.example/k.pdf", "k")],
        s + "kurs/modul3": [(s + "news", "News"), (s + "tiefer", "Module tiefer")]}
    maps = {
        s + "sitemap.xml": (True, [s + "sm-news.xml", s + "sm-modul.xml", s + "sm-studium.xml"]), s + "robots.txt": (False, [s + "sm-robots.xml"]),
        s + "sm-modul.xml": (False, [s + f"kurs/modul{i}" for i in range(6)] + [s + "m2.pdf", s + "kontakt"]), s + "sm-studium.xml": (False, [s + "studium"]),
        s + "sm-robots.xml": (False, [s + "curriculum"]), "https://fb1.u.example/sitemap.xml": (False, ["https://fb1.u.example/modulkatalog"]),
        "https://fb2.u.example/sitemap.xml": (False, ["https://fb2.u.example/modulkatalog"])}
    links = spark.createDataFrame([(p, u, a, n) for p, ls in pages.items() for n, (u, a) in enumerate(ls)], "page string, url string, anchor string, pos int")
    locs = spark.createDataFrame([(m, u, n, i) for m, (i, ls) in maps.items() for n, u in enumerate(ls)], "sitemap string, url string, pos int, is_index boolean")
    p = profiles.PROFILES["modulhandbuch"]
    texts = {(u, a) for ls in pages.values() for u, a in ls} | {(u, "") for _, ls in maps.values() for u in ls}
    known = {(r.u, r.a): r.s for r in spark.createDataFrame(sorted(texts), "u string, a string").select("u", "a", p.score(F.col("u"), F.col("a")).alias("s")).collect()}
    limits = crawl.Limits(depth=2, pages=3, sitemap_urls=2, child_sitemaps=2, subdomain_sitemaps=2, per_round=1)
    # The picture of one page has no anchor of its own there.
    fetch = lambda u: links.withColumn("asset", F.lit(False)).join(u.withColumnRenamed("url", "page"), "page", "left_semi")
    locate = lambda u: locs.join(u.withColumnRenamed("url", "sitemap"), "sitemap", "left_semi")
    rows = crawl.crawl(spark.createDataFrame([(s,)], "url string"), fetch, p, limits, locate).orderBy("round").collect()
    pages = {k: [x for x in v if not x[0].endswith(".png")] for k, v in pages.items()}
    assert [(r.url, r.kind, r.depth) for r in rows] == sequential(s, pages, maps, lambda u, a: known[u, a], limits)
    assert {r.kind for r in rows} == {"page", "target", "sitemap", "robots"}
    assert len(crawl.crawl(spark.createDataFrame([(s,)], "url string"), fetch, p, crawl.Limits(requests=5, per_round=5), locate).collect()) == 5


def test_ingest_and_outcomes(spark, tmp_path):
    v = spark.createDataFrame([(1, "g", "a.pdf", 0), (1, "g", "a.pdf", 1), (0, "g", "b.pdf", 2), (1, "h", "c.pdf", 3)], "label int, grp string, filename string, pos int")
    have = spark.createDataFrame([(0, "g", "b.pdf")], "label int, grp string, filename string")
    told, report = ingest.retrained(v, have, lambda t: {"n": t.count()})
    assert told == {"positive": 3, "negative": 1, "copied": 2, "skipped": 2, "total": 4} and report == {"n": 3}
    assert ingest.retrained(v.where("label = 0"), have, lambda t: {})[1] is None
    with pytest.raises(Exception, match="unknown label"):
        spark.createDataFrame([("maybe",)], "l string").select(ingest.label_folder(F.col("l"), strict=True)).collect()
    for name in ("g1/a.pdf", "g1/b.PDF", "g2/c.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert {(r.label, r.grp, r.filename) for r in ingest.from_paths(spark, str(tmp_path), "POS").collect()} == {("positiv", "g1", "a.pdf"), ("positiv", "g2", "c.pdf")}
    assert ingest.from_paths(spark, str(tmp_path / "g1/b.PDF"), "0", "own").first().grp == "own"
    asked = spark.createDataFrame([("https://a.example/", "1"), ("ftp://x", "2"), (" https://b.example ", "3"), ("https://c.example", "4"), ("https://d.example", "5")], "url string, job_id string")
    seen = spark.createDataFrame([("HTTPS://A.example/",)], "url string")
    done = spark.createDataFrame([("https://b.example", None, 3, 2, 9), ("https://c.example", "boom", 1, 0, 0)], "url string, error string, files_found int, files_downloaded int, bytes_downloaded long")
    out = jobs.outcomes(asked, seen, done)
    assert {r.job_id: (r.status, r.files_found) for r in out.collect()} == {"1": ("skipped", 0), "2": ("invalid", 0), "3": ("scraped", 3), "4": ("error", 1), "5": ("pending", 0)}
    assert [r.url for r in jobs.newly_visited(out, F.current_timestamp()).collect()] == ["https://b.example"]
    assert jobs.outcomes(asked, seen, done, force=True).where("status = 'skipped'").count() == 0
    assert tuple(jobs.exit_code(out).first()) == (2, 500) and tuple(jobs.exit_code(out.limit(0)).first()) == (1, 422)
    with pytest.raises(ValueError):
        review.checked_verdicts(spark.createDataFrame([("positive",), ("perhaps",)], "verdict string"))
    f = spark.createDataFrame([("pdf, docx ,",), (" ,",)], "t string").select(jobs.file_type_list(F.col("t")).alias("l")).collect()
    assert [r.l for r in f] == [["pdf", "docx"], None]
    steps = [(300, True, lambda d: d.withColumn("x", F.col("x") * 2)), (200, True, lambda d: d.withColumn("x", F.col("x") + 1)), (250, False, lambda d: d.limit(0))]
    assert [r.x for r in jobs.chained(spark.range(1).withColumnRenamed("id", "x"), steps).collect()] == [2]
    one = spark.createDataFrame([(1, 5)], "user_id int, role_id int")
    assert rbac.assign_role(one, one, one, one).count() == 1
    with pytest.raises(ValueError):
        rbac.assign_role(one, one, one.where("role_id = 0"), one)


def test_sitemap_requests(spark):
    rows = [("s", f"https://u.example/modul{i}", i, False, 0) for i in range(5)] + [("s", "https://u.example/x.pdf", 9, False, 0), ("i", "https://u.example/sm.xml", 0, True, 2), ("k", "https://u.example/sm.xml", 0, True, 1)]
    locs = spark.createDataFrame(rows, "sitemap string, url string, pos int, is_index boolean, sitemap_depth int").withColumn("seed", F.lit("https://u.example/"))
    got = crawl.sitemap_requests(locs, profiles.PROFILES["modulhandbuch"], 2, crawl.Limits(sitemap_urls=3)).collect()
    assert sorted((r.sitemap, r.kind) for r in got) == [("k", "sitemap"), ("s", "page"), ("s", "page"), ("s", "page"), ("s", "target")]


def test_tfidf_rows_have_unit_length(spark):
    df = spark.createDataFrame([(1, "rot blau rot"), (2, "blau grün"), (3, None)], "id int, t string")
    c = features.term_counts(df, "id", "t")
    v = features.document_frequencies(c, 1, None)
    assert {r.term: r.df for r in v.collect()}["blau"] == 2
    w = features.tfidf(c, v, 3)
    assert all(abs(r[1] - 1) < 1e-9 for r in w.groupBy("id").agg(F.sum(F.col("weight") ** 2)).collect())
    raw = {r.term: r.n for r in c.where("id = 1").collect()}
    assert raw == {"rot": 2, "blau": 1, "rot blau": 1, "blau rot": 1}
    assert features.char_ngrams("ab") == [" ab", "ab ", " ab "] and features.char_ngrams("") == []
    idf = math.log(4 / 3) + 1
    one = {r.term: r.weight for r in w.where("id = 2").collect()}
    assert abs(one["blau"] / one["grun"] - idf / (math.log(4 / 2) + 1)) < 1e-9


def test_folds_keep_groups_and_model_learns(spark):
    rng = random.Random(1)
    rows = [(f"g{i % 8}", i % 2, ("modul lernziele ects " if i % 2 else "termin mensa sport ") + " ".join(rng.choice("abcdefgh") * 3 for _ in range(5))) for i in range(64)]
    df = spark.createDataFrame(rows, "grp string, y int, text string")
    f = model.grouped_folds(df, "grp", "y", 4)
    assert f.count() == 8 and f.select("fold").distinct().count() == 4
    s = model.out_of_fold(df.withColumn("grp", F.concat("grp", (F.rand(3) * 2).cast("int"))), "grp", folds=2, max_iter=5)
    assert s.count() == 64 and metrics.average_precision(s).first()[0] > 0.9
    with pytest.raises(ValueError):
        model.out_of_fold(df.limit(5), "grp")


def test_folds_share_one_count_of_terms(spark, monkeypatch):
    """The scores of models fitted fold by fold, with no fit of a vocabulary a fold."""
    rng = random.Random(2)
    rows = [(i, f"g{i % 6}", i % 2, None if i == 7 else " ".join(rng.choice(["Modul", "lehre", "Prüfung" if i % 2 else "ﬁx", "a", "haus-berg", "ECTS"]) for _ in range(i % 9)),
             f"m_{i % 3}.pdf", None if i % 4 else "Der Titel", 3, 50 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, grp string, y int, text string, filename string, title string, page_count int, text_length int")
    fold = model.grouped_folds(df, "grp", "y", 2)
    want = {}
    for variant in model.VARIANTS:
        ready = model.with_terms(df.join(fold, "grp"), variant=variant).persist()
        parts = [model.Classifier.fit(ready.where(F.col("fold") != i), max_iter=3, variant=variant).score(ready.where(F.col("fold") == i)) for i in range(2)]
        want[variant] = {r.id: r.s for p in parts for r in p.select("id", "s").collect()}
    monkeypatch.setattr(features.Tfidf, "fit", None)
    for variant, scores in want.items():
        got = {r.id: r.s for r in model.out_of_fold(df, "grp", folds=2, max_iter=3, variant=variant).select("id", "s").collect()}
        assert got.keys() == scores.keys() and all(abs(s - scores[i]) < 1e-9 for i, s in got.items())


def test_metadata_variant_is_fitted_saved_and_read(spark, tmp_path):
    rows = [(i, f"g{i % 4}", i % 2, ("modul lehre " if i % 2 else "haus berg ") * 5, ("modulkatalog" if i % 2 else "bericht") + f"_{i}.pdf", None, 3, 50) for i in range(24)]
    df = spark.createDataFrame(rows, "id int, grp string, y int, text string, filename string, title string, page_count int, text_length int").repartition(2)
    ready = model.with_terms(df, variant="metadata").persist()
    fitted = model.Classifier.fit(ready, max_iter=2, variant="metadata")
    fitted.save(spark, str(tmp_path / "m"))
    again = model.Classifier.load(spark, str(tmp_path / "m"))
    score = lambda m: {r.id: round(r.s, 9) for r in m.score(ready).collect()}
    assert score(fitted) == score(again) and set(again.blocks) == {"_words", "_chars", "_names", "_titles"} and len(again.scale) == 6
    assert model.choose_variant(0.90, 0.93) == "metadata" and model.choose_variant(0.90, 0.915) == "content" and model.choose_variant(0.9, 0.1, "metadata") == "metadata"


def test_folds_lay_out_few_records_a_task(spark, monkeypatch):
    class Seen(Exception):
        pass

    def statistics(df, *_):
        raise Seen(df.rdd.getNumPartitions())

    monkeypatch.setattr(model, "TASK_RECORDS", 10, raising=False)
    monkeypatch.setattr(features, "term_statistics", statistics)
    df = spark.range(200).select((F.col("id") % 20).cast("string").alias("g"), (F.col("id") % 2).cast("int").alias("y"), F.lit("some text").alias("text"))
    with pytest.raises(Seen) as e:
        model.out_of_fold(df, "g")
    assert e.value.args[0] == 20
