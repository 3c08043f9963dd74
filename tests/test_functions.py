"""URL, text and HTML functions against the standard library and hand-made cases."""

import gzip
import hashlib
import math
import re
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from sheafline.functions import html, text, urls
from sheafline.operators import profiles

URLS = [
    "https://Www.Uni-X.example:8080/A/b.PDF?q=1#frag", "HTTP://user@host_x.example/a b/;p.pdf", "https://x.example", "https://x.example/", "https://x.example/a///",
    "//host/path", "/only/path", "mailto:a@b.example", "", "https://x.example/a/b;params?x=y", "ftp://x.example/f.doc", "https://x.example/?q", "http://localhost/x",
]


def test_pieces_follow_the_standard_library(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    u = F.col("u")
    for r in df.select(u, urls.scheme(u).alias("s"), urls.netloc(u).alias("n"), urls.path(u).alias("p"), urls.hostname(u).alias("h")).collect():
        want = urlparse(r.u)
        assert (r.s, r.n, r.h) == (want.scheme, want.netloc, want.hostname or ""), r.u
        assert r.p == want.path or ";" in r.u, r.u


def test_normalize(spark):
    cases = {"  HTTPS://Host.Example/A/ ": "https://host.example/A", "https://h.example/": "https://h.example/", "https://h.example/a///": "https://h.example/a",
             "https://h.example/a?b=C#x": "https://h.example/a?b=C", "https://U@H.example:80/x": "https://u@h.example:80/x"}
    df = spark.createDataFrame(list(cases), "string").withColumnRenamed("value", "u")
    got = {r.u: r.n for r in df.select("u", urls.normalize_url(F.col("u")).alias("n")).collect()}
    assert got == cases


def test_join_and_names(spark):
    rows = [("https://h.example/a/b.html", r) for r in ("c.pdf", "/x y.pdf", "../up.pdf", " https://o.example/z ", "?q=1", "//n.example/p", "#f", "", ".", "..", "./x", "../../../y", "d/./e/../f?g#h", "/a/../b/", "//n.example", "?", "mailto:x@y")]
    rows += [("https://h.example", "x"), ("https://h.example?q=2", "y"), ("https://h.example/a/?q=2#z", "#w"), ("https://h.example/a/b/", "../c/..")]
    df = spark.createDataFrame([*rows, (None, "x"), ("https://h.example/", None)], "b string, r string")
    for r in df.select("b", "r", urls.url_join(F.col("b"), F.col("r")).alias("j")).collect():
        assert r.j == (None if r.b is None or r.r is None else urljoin(r.b, r.r.strip()))
    one = spark.range(1).select(urls.document_name(F.lit("https://h.example/show.asp?id=3"), F.lit(".pdf")).alias("n"), urls.content_type_extension(F.lit("Application/PDF; x=y")).alias("t"),
                                urls.content_type_extension(F.lit("text/html")).alias("o")).first()
    assert one.n == "show-" + hashlib.sha1(b"https://h.example/show.asp?id=3").hexdigest()[:8] + ".pdf" and one.t == ".pdf" and one.o == ""


def test_sites(spark):
    df = spark.createDataFrame([("https://a.b.uni.example/x.pdf", "https://www.uni.example/"), ("https://uni.other/x", "https://uni.example/"), ("ftp://uni.example/x", "https://uni.example/")], "u string, s string")
    assert [r[0] for r in df.select(urls.same_site(F.col("u"), F.col("s"))).collect()] == [True, False, False]
    assert [r[0] for r in df.select(urls.is_followable(F.col("u"), F.col("s"))).collect()] == [False, False, False]


def test_hash_as_python_does(spark):
    texts = ["A  b\n\tC", "\x1cx\u00a0 y\u2003", "", "   ", None, "ÄÖ ß"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = ["" if not t else hashlib.sha256(re.sub(r"\s+", " ", t.lower()).strip().encode()).hexdigest() for t in texts]
    assert [r[0] for r in df.select(text.text_hash(F.col("t"))).collect()] == want


def test_keyword_scores_count_overlapping_tokens(spark):
    p = profiles.PROFILES["modulhandbuch"]
    df = spark.createDataFrame([("https://x.example/modulhandbuch", None), ("https://x.example/", "Lehrveranstaltung"), ("https://x.example/", "Modulhandbücher")], "u string, a string")
    assert [r[0] for r in df.select(p.score(F.col("u"), F.col("a"))).collect()] == [125, -18, 125]


def test_numeric_features(spark):
    t = "ECTS: 5 Credits, INF-101 und INF-101, B_AWP25 Lernziele Workload 12"
    df = spark.createDataFrame([(t, 3, len(t)), (None, None, None), ("", 0, 0)], "t string, p int, l int")
    f = text.numeric_features(F.col("t"), F.col("p"), F.col("l"))
    a, b, c = df.select(*[v.alias(k) for k, v in f.items()]).collect()
    assert a.page_count == 3 and abs(a.log_text_length - math.log1p(len(t))) < 1e-12 and abs(a.ects_density - 2000 / len(t)) < 1e-9
    assert abs(a.module_term_density - 2000 / len(t)) < 1e-9 and a.module_code_count == 1 and abs(a.digit_ratio - len(re.findall(r"\d", t)) / len(t)) < 1e-12
    assert b.ects_density == 0 and c.digit_ratio == 0


def test_html():
    p = html.parse('<title> T </title><title>no</title><p>one <b>bold</b> two<div>x</div><script>"</p>"</script><p>three<p>four</p><a href="/u"> A <i>b</i></a><a href="/e"></a><img src="i.png">')
    assert p["title"] == "T" and p["text"] == "one\ntwo\nthree\nfour" and p["assets"] == ["i.png"]
    assert p["anchors"] == [{"href": "/u", "text": "A b"}, {"href": "/e", "text": ""}]
    assert html.parse(None)["title"] == "" and html.parse("<p>") ["text"] == ""


def test_sitemaps(spark):
    xml = b'<?xml version="1.0"?><urlset xmlns="http://x"><url><loc> https://a.example/1?a=1&amp;b=2 </loc></url><url><s:loc>https://a.example/2</s:loc></url></urlset>'
    assert html.sitemap(gzip.compress(xml)) == (["https://a.example/1?a=1&b=2", "https://a.example/2"], False)
    assert html.sitemap(b"<sitemapindex><sitemap><loc>x</loc>") == (["x"], True) and html.sitemap(None) == ([], False) and html.sitemap(b"\x1f\x8bbad") == ([], False)
    got = spark.range(1).select(html.robots_sitemaps(F.lit("User-agent: *\nSITEMAP: https://a.example/s.xml \nsitemap:https://b.example\n")).alias("r")).first().r
    assert got == ["https://a.example/s.xml", "https://b.example"]
