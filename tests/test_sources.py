"""Readers, writers and streams."""

import os

from pyspark.sql import functions as F

from sheafline.sources import readers, writers
from sheafline.streaming import streams


def test_seed_lists(spark, tmp_path):
    files = {
        "a.csv": "\ufeffname;Homepage\nA;https://a.example\nB;see http://b.example/x\n# note\nA;https://a.example\n",
        "b.csv": "x,https://c.example\ny,https://d.example\n", "c.csv": "link\turl\nhttps://no.example\thttps://tab.example\n",
        "d.csv": "", "e.csv": "a,b\n\"one, two\",\"https://q.example/x,y\"\nnothing,here\n",
        "s.txt": "\ufeffhttps://a\n\n# c\n b ", "h.html": '<link href="https://l.example"><a href="/rel">r</a>\n<a href=" https://a.example ">a</a><a href="https://a.example">b</a>'}
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = {}
    for r in readers.seed_urls(readers.numbered_lines(spark, str(tmp_path))).orderBy("pos").collect():
        got.setdefault(r.file.rsplit("/", 1)[-1], []).append(r.url)
    assert got == {"a.csv": ["https://a.example", "http://b.example/x"], "b.csv": ["https://c.example", "https://d.example"], "c.csv": ["https://tab.example"],
                   "e.csv": ["https://q.example/x,y"], "s.txt": ["https://a", "b"], "h.html": ["https://a.example", "https://l.example"]}
    assert readers.urls_inline("a, b\nc") == ["a", "b", "c"]


def test_events(spark):
    bodies = ['{"url": "https://a"}', '{"urls": ["https://b", ""]}', '{"Records": [{"body": "{\\"urls\\": [\\"https://c\\"]}"}, {"body": "https://d"}, {"body": "{\\"url\\": \\"https://e\\"}"}]}', "{}", "broken", None, '{"Records": [{"body": "{\\"Records\\": [{\\"body\\": \\"https://f\\"}]}"}]}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string")
    got = {r.i: r.u for r in df.select("i", readers.event_urls(F.col("b")).alias("u")).collect()}
    assert got[0] == ["https://a"] and got[1] == ["https://b"] and got[2] == ["https://c", "https://d", "https://e"] and not got[3] and not got[4] and not got[5] and got[6] == ["https://f"]


def test_json_lines_index_skips_broken_lines(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"job_id": "j", "url": "a"}\nnot json\n\n{"job_id": "j", "url": "b"}\n', encoding="utf-8")
    lines = readers.numbered_lines(spark, str(tmp_path / "m.jsonl"))
    got = readers.json_lines_indexed(lines, "job_id string, url string").orderBy("line_index").collect()
    assert [(r.line_index, r.url) for r in got] == [(0, "a"), (1, "b")]
    assert readers.json_lines(spark, str(tmp_path / "m.jsonl"), "job_id string, url string").count() == 2
    assert readers.feedback_files(spark, str(tmp_path)).first().job_id == "m"


def test_labelled_tree_and_extraction(spark, tmp_path):
    for p in ("positiv/g1/a__x.pdf", "Negative/b__h.PDF", "other/c.pdf", "positiv/g1/n.txt"):
        f = tmp_path / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"%PDF " + p.encode())
    t = readers.labelled_tree(spark, str(tmp_path))
    assert {(r.label, r.grp, r.filename) for r in t.collect()} == {(1, "g1", "a__x.pdf"), (0, "b", "b__h.PDF")}

    def extractor(content, name):
        if name.startswith("b"):
            raise OSError("bad file")
        return {"title": "T", "text": "x" * 300, "page_count": 2}

    e = {r.filename: r for r in readers.extracted(t.select("filename", "content"), extractor, cap=250).collect()}
    assert e["a__x.pdf"].extraction_status == "classified" and e["a__x.pdf"].text_length == 300 and len(e["a__x.pdf"].text) == 250 and e["b__h.PDF"].extraction_status == "extraction_failed"
    assert readers.cache_misses(t, t.limit(1)).count() == 1


def test_writers(spark, tmp_path):
    docs = spark.createDataFrame([("h", "j", "a.pdf", bytearray(b"x")), (None, None, "b.pdf", None)], "hostname string, job_id string, filename string, content binary")
    writers.write_documents(docs, str(tmp_path / "out"))
    assert (tmp_path / "out/h/j/a.pdf").read_bytes() == b"x" and (tmp_path / "out/unknown/none/b.pdf").exists()
    a = spark.createDataFrame([("j", 0, "positive")], "job_id string, line_index int, verdict string")
    b = spark.createDataFrame([("j", 0, "negative"), ("j", 1, "positive")], "job_id string, line_index int, verdict string")
    path = str(tmp_path / "fb")
    writers.rewrite_feedback(spark, a, b, path)
    assert {(r.line_index, r.verdict) for r in spark.read.json(writers.current(spark, path)).collect()} == {(0, "negative"), (1, "positive")}
    schema = "job_id string, line_index int, verdict string"
    writers.rewrite_feedback(spark, writers.read_feedback(spark, schema, path), a, path)  # read and written at once
    assert {(r.line_index, r.verdict) for r in writers.read_feedback(spark, schema, str(tmp_path / "none"), path).collect()} == {(0, "positive"), (1, "positive")}
    (tmp_path / "fb" / "v=9").mkdir()  # a version whose writer broke off
    assert writers.versions(spark, path) == [0, 1] and writers.read_feedback(spark, schema, str(tmp_path / "none")).count() == 0
    cache = spark.createDataFrame([("k", "old"), ("l", "x")], "cache_key string, text string")
    writers.rewrite_cache(spark, cache, spark.createDataFrame([("k", "new")], "cache_key string, text string"), str(tmp_path / "cache"))
    assert {tuple(r) for r in spark.read.parquet(writers.current(spark, str(tmp_path / "cache"))).collect()} == {("k", "new"), ("l", "x")}
    report = spark.createDataFrame([(2, "x")], "jobs int, note string")
    lines = writers.summary_text(report).withColumn("pos", F.lit(0))
    assert readers.summary_line(lines).first().summary == '{"jobs":2,"note":"x"}'
    assert [r[0] for r in spark.createDataFrame([("PDF",), ("zip",)], "t string").select(writers.object_type(F.col("t"))).collect()] == ["application/pdf", "application/octet-stream"]


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"urls": ["https://A.example/", "https://a.example/x"]}\n{"url": "https://a.example/x/"}\n')
    q = streams.new_seeds(streams.event_seeds(spark, str(src))).writeStream.format("memory").queryName("seeds").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert sum(n for _, n in streams.progress(q)) == 2
    assert spark.table("seeds").count() == 2
    store, more = str(tmp_path / "visited"), tmp_path / "more"
    more.mkdir()
    (more / "r.json").write_text('{"url": "https://a.example/x/", "job_id": "1", "scraped_at": "2024-01-01T00:00:00"}\n{"url": "https://a.example/x", "job_id": "2", "scraped_at": "2024-02-01T00:00:00"}\n')
    s = spark.readStream.schema("url string, job_id string, scraped_at timestamp_ntz").json(str(more))
    streams.keep_visited(s, store, str(tmp_path / "c2")).awaitTermination(120)
    assert [(r.url_norm, r.job_id) for r in writers.read_visited(spark, store).collect()] == [("https://a.example/x", "2")]
    assert writers.read_visited(spark, str(tmp_path / "none")).count() == 0 and os.path.isdir(store)
