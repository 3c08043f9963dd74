"""Near-duplicates, batches, components and splits against brute force."""

import itertools
import random

import numpy as np
import pytest
from helpers import corpus, edited, near_sets, sets, shingles, similarity
from pyspark.sql import functions as F

from sheafline.llm import arrivals, components, neardup, splits, vec
from sheafline.llm.sitelines import record_group


def test_words_and_shingles_as_loops_give_them():
    texts = ["Ein Wort_zwei, drei-4 ÄÖÜß ½x", None, "", "a b c d", "İstanbul étude 日本 語"]
    from helpers import words
    w = vec.Words(texts)
    assert [b - a for a, b in zip(w.offsets, w.offsets[1:])] == [len(words(t)) for t in texts]
    h, off, _ = vec.Words(["a b c a b c", "A  b\nC"]).shingles(3)
    assert h[0] == h[3] == h[4] and len(set(h.tolist())) == 3 and list(off) == [0, 4, 5]
    t = vec.text_hashes(vec.Words(["a b", "A, b!", "b a", ""]))
    assert t[0] == t[1] != t[2] and t[3] == 0


@pytest.mark.parametrize("k,s,seed", [(3, 0.6, 1), (5, 0.8, 2)])
def test_sets_match_brute_force(spark, k, s, seed):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in texts.items()], "rec long, body string, id string, text int")
    got = {r.id: r.set_id for r in neardup.near_duplicate_sets(df, "rec", "body", neardup.NearDup(k=k, similarity=s, symbols=240, recall=0.999999)).collect()}
    assert got == near_sets(texts, k, s)
    pairs = {tuple(r) for r in neardup.set_pairs(spark.createDataFrame(list(got.items()), "id long, set_id long")).collect()}
    assert pairs == {(a, b) for a, b in itertools.combinations(sorted(got), 2) if got[a] == got[b]}


def test_large_buckets_lose_nothing(spark):
    rng = random.Random(4)
    base = " ".join(f"w{i}" for i in range(80))
    texts = {i: edited(rng, base, rng.randrange(0, 7)) for i in range(1, 61)}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {r.id: r.set_id for r in neardup.near_duplicate_sets(df, "id", "text", neardup.NearDup(k=3, similarity=0.6, small=3, block=8, symbols=240, recall=0.999999)).collect()}
    assert got == near_sets(texts, 3, 0.6)
    hot = {r.id: r.set_id for r in neardup.near_duplicate_sets(df, "id", "text", neardup.NearDup(k=3, similarity=0.6, small=3, block=8, hot=5, symbols=240, recall=0.999999)).collect()}
    assert hot == got


def test_pairs_that_share_stock_phrases_reach_the_recall(spark):
    texts, n = {}, 400
    for i in range(n):  # similarity 0.6, 29 of 100 shingles of either are stock; 0.48 by weight
        stock = [f"s{i % 20}x{j}" for j in range(31)]
        both = [f"b{i}x{j}" for j in range(46)]
        for c in (0, 1):
            texts[2 * i + c] = " ".join(stock + both + [f"o{i}x{c}x{j}" for j in range(25)])
    assert similarity(shingles(texts[0], 3), shingles(texts[1], 3)) == 0.6
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {r.id: r.set_id for r in neardup.near_duplicate_sets(df, "id", "text", neardup.NearDup(k=3, similarity=0.6)).collect()}
    assert sum(got[2 * i] != got[2 * i + 1] for i in range(n)) <= 2


def test_signatures_do_not_move_a_row_each(spark):
    rng = random.Random(6)
    texts = {i: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for i in range(300)}
    texts |= {1000 + i: edited(rng, texts[i], 2) for i in range(20)}
    df = spark.createDataFrame(list(texts.items()), "id long, text string").localCheckpoint()
    before = shuffled_rows(spark)
    got = {r.id: r.set_id for r in neardup.near_duplicate_sets(df, "id", "text", neardup.NearDup(k=3, similarity=0.6)).collect()}
    assert got == near_sets(texts, 3, 0.6)
    assert shuffled_rows(spark) - before < 30 * len(texts)


def test_sets_of_nothing(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert neardup.near_duplicate_sets(df, "id", "text").count() == 0
    one = spark.createDataFrame([(None, "a b c d e f"), (1, None), (2, "a")], "id long, text string")
    assert {tuple(r) for r in neardup.near_duplicate_sets(one, "id", "text").collect()} == {(1, 1), (2, 2)}


def test_thresholds_are_allocated_at_least_cost():
    cost = np.array([[5.0, 50], [1.0, 2], [100.0, 900], [1.0, 40]])
    plan = neardup.allocate(cost, 0.6, 3, 0.3)
    reach = 1 - np.prod([1 - neardup.meets(0.6, 3, t) for t in plan])
    best = min((sum(cost[i, t] for i, t in enumerate(p) if t >= 0) for p in itertools.product((-1, 0, 1), repeat=4)
                if 1 - np.prod([1 - neardup.meets(0.6, 3, t) for t in p]) >= 0.305), default=None)
    assert reach >= 0.29 and sum(cost[i, t] for i, t in enumerate(plan) if t >= 0) <= best
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 60000, (40, 9)).astype(np.uint16)
    codes[:, 3] = codes[:, 7] = rng.integers(0, 3, 40)
    groups = neardup.group_values(codes, 3)
    assert sorted(sum(groups, [])) == list(range(9)) and any({3, 7} <= set(g) for g in groups)


def brute_arrivals(history, batch, k, s):
    kept = {i: shingles(t, k) for i, t in history.items()}
    rows, accepted = set(), []
    for b, i, t in sorted(batch, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        own = shingles(t, k)
        hit = [j for j, o in kept.items() if similarity(own, o) >= s - 1e-12]
        if hit:
            rows |= {(j, i) for j in hit}
        else:
            kept[i] = own
            accepted.append(i)
    return rows, accepted


@pytest.fixture(scope="module")
def arriving():
    texts = corpus(9, n=70, copies=5)
    ids = sorted(texts)
    rng = random.Random(3)
    history = {i: texts[i] for i in ids if rng.random() < 0.4}
    late = [(rng.randrange(1, 4), 1000 + i, texts[i]) for i in ids if i not in history]
    late += [(None, 3000, texts[1]), (2, 3001, None), (2, 3002, ""), (3, 3003, late[0][2])]
    return history, late


def test_arrivals_match_the_sequential_rule(spark, arriving, tmp_path):
    history, late = arriving
    want, _ = brute_arrivals(history, late, 3, 0.6)
    h = spark.createDataFrame([(i, t) for i, t in history.items()], "id long, text string")
    b = spark.createDataFrame(late, "no int, rec long, body string").withColumn("id", F.lit(5)).withColumn("text", F.lit(1))
    o = arrivals.Arrivals(k=3, similarity=0.6)
    store = arrivals.Store.create(h, str(tmp_path / "store"), o)
    got = {tuple(r) for r in arrivals.ingest(store, b, "rec", "no", "body").collect()}
    assert got == want


def test_store_goes_on_batch_by_batch(spark, arriving, tmp_path):
    history, late = arriving
    want, _ = brute_arrivals(history, late, 3, 0.6)
    h = spark.createDataFrame([(i, t) for i, t in history.items()], "id long, text string")
    b = spark.createDataFrame(late, "no int, rec long, body string")
    o = arrivals.Arrivals(k=3, similarity=0.6)
    arrivals.Store.create(h, str(tmp_path / "store"), o)
    got = set()
    for n in (None, 1, 2, 3):
        part = b.where("no is null" if n is None else f"no = {n}")
        store = arrivals.Store(spark, str(tmp_path / "store"), o)  # opened anew each time
        got |= {tuple(r) for r in arrivals.ingest(store, part, "rec", "no", "body").collect()}
    assert got == want


def test_arrivals_meet_across_the_length_of_short_records(spark, tmp_path):
    rng, o = random.Random(8), arrivals.Arrivals(k=3, similarity=0.6)
    history, late, pairs = {}, [], [(70, 60), (65, 64), (65, 40), (80, 50), (100, 62), (106, 64), (90, 90), (64, 64), (60, 66), (64, 100), (72, 110)] * 2
    for i, (kept, new) in enumerate(pairs):  # shingles: two fewer than words
        text = [f"w{i}x{rng.randrange(5000)}" for _ in range(max(kept, new) + 2)]
        history[i] = " ".join(text[:kept + 2])
        late.append((1, 1000 + i, " ".join(text[:new + 2])))
        fresh = [f"v{i}x{rng.randrange(5000)}" for _ in range(max(kept, new) + 2)]
        late += [(2, 2000 + i, " ".join(fresh[:kept + 2])), (3, 3000 + i, " ".join(fresh[:new + 2]))]
        if kept == new:
            late.append((1, 4000 + i, edited(rng, history[i], 4)))
    repeated = " ".join(f"r{j % 50}" for j in range(200))  # few distinct shingles in a long text
    history[900] = repeated
    late.append((1, 4900, " ".join(repeated.split()[:54])))
    want, _ = brute_arrivals(history, late, 3, 0.6)
    h = spark.createDataFrame(list(history.items()), "id long, text string")
    b = spark.createDataFrame(late, "no int, rec long, body string")
    store = arrivals.Store.create(h, str(tmp_path / "store"), o)
    got = {tuple(r) for r in arrivals.ingest(store, b, "rec", "no", "body").collect()}
    assert len(want) >= 2 * len(pairs) and got == want


def shuffled_rows(spark):
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    empty = gateway.jvm.java.util.ArrayList
    stages = store.stageList(empty(), False, False, gateway.new_array(gateway.jvm.double, 0), empty())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_lookups_do_not_move_a_row_for_each_meeting(spark):
    """300 records ask for fingerprints that 400 hold, all of them alike in two, and some in more."""
    rng, o = random.Random(5), arrivals.Arrivals(k=3, similarity=0.6)
    held = {i: {rng.randrange(10**6) for _ in range(4)} | {1, 2} | set(rng.sample(range(100, 400), 25)) for i in range(400)}
    asking = {1000 + i: {rng.randrange(10**6) for _ in range(6)} | {1, 2} | set(rng.sample(range(100, 400), 20)) for i in range(300)}
    for i in range(0, 60, 2):
        asking[1000 + i] = set(list(held[i])[:rng.randrange(8, 30)]) | set(rng.sample(range(100, 400), 3))
    frame = lambda x: spark.createDataFrame([(i, bytearray(np.array(sorted(f), dtype=np.uint64).tobytes())) for i, f in x.items()], "id long, fps binary")
    own, index = frame(asking), frame(held)
    index = arrivals.segments(index.union(own), 2, o).localCheckpoint()
    nf = spark.createDataFrame([(i, len(f), -(-len(f) // 4)) for i, f in asking.items()], "id long, nf int, need int")
    asked = arrivals.segments(own, 2, o).select("part", "fp", "rec")
    before = shuffled_rows(spark)
    got = {tuple(r) for r in arrivals._candidates(asked, index, nf, o).collect()}
    everyone = {**held, **asking}
    must = {(i, j) for j, f in asking.items() for i, g in everyone.items() if i != j and len(f & g) >= -(-len(f) // 4)}
    assert len(must) > 100 and must <= got
    assert all(len(everyone[i] & asking[j]) >= min(5, -(-len(asking[j]) // 4)) for i, j in got)
    meetings = sum(len(f & g) for f in asking.values() for g in held.values())
    assert shuffled_rows(spark) - before < meetings / 3


def test_store_of_its_own_reads_what_it_touches(spark, tmp_path):
    rng, o = random.Random(11), arrivals.Arrivals(k=3, similarity=0.6, part_entries=4000, bucket_chars=9000)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base = {i: text(40) for i in range(12)}
    read = {}
    for size in (100, 1000):
        path = str(tmp_path / f"s{size}")
        history = spark.createDataFrame([(i, text(40)) for i in range(10_000, 10_000 + size)], "id long, text string")
        arrivals.Store.create(history, path, o)
        batches = [[(1, 20_000 + i, t) for i, t in base.items() if i < 6],
                   [(2, 21_000, base[0]), (2, 21_001, base[1].upper()), (2, 21_002, edited(rng, base[2], 1)), (2, 21_003, base[8])],
                   [(3, 22_000, edited(rng, base[8], 1)), (3, 22_001, base[0]), (3, 22_002, base[9]), (3, 22_003, edited(rng, base[9], 1))]]
        got = set()
        for rows in batches:
            store = arrivals.Store(spark, path, o)
            part = spark.createDataFrame(rows, "no int, rec long, body string")
            got |= {tuple(r) for r in arrivals.ingest(store, part, "rec", "no", "body", name=f"b{rows[0][0]}").collect()}
        want, _ = brute_arrivals({}, [r for b in batches for r in b], 3, 0.6)
        assert got == want and len(want) == 6
        with pytest.raises(ValueError):
            arrivals.ingest(arrivals.Store(spark, path, o), part, "rec", "no", "body", name="b3")
        store = arrivals.Store(spark, path, o)
        # An append that broke off before its log file is not there for readers.
        store._write("gbroken", "texts", spark.createDataFrame([(5, "x", 0)], "id long, text string, bucket int"))
        assert store.read("texts").where("id = 5").count() == 0 and store.read("texts").count() == size + 8
        ask = spark.createDataFrame([(i,) for i in range(20_000, 20_004)], "id long").select(store.bucket("id"))
        read[size] = store.read("texts", ask).count()
        if size == 1000:
            continue
        store.compact()
        again = arrivals.Store(spark, path, o)
        assert len(again.gens) == 1 and again.read("texts").count() == size + 8
        late = spark.createDataFrame([(4, 23_000, base[3])], "no int, rec long, body string")
        assert {tuple(r) for r in arrivals.ingest(again, late, "rec", "no", "body").collect()} == {(20_003, 23_000)}
    assert read[1000] < 3 * read[100]


def test_arrivals_on_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "id long, text string")
    store = arrivals.Store.create(none, str(tmp_path / "s"), arrivals.Arrivals(k=3, similarity=0.6))
    batch = spark.createDataFrame([(1, 1, "a b c d"), (1, 2, "a b c d"), (1, None, "x y z")], "no int, id long, text string")
    assert [tuple(r) for r in arrivals.ingest(store, batch, "id", "no", "text").collect()] == [(1, 2)]
    assert arrivals.ingest(store, batch.limit(0), "id", "no", "text").count() == 0


def test_winnowing_keeps_a_mark_of_every_window():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**62, 300).astype(np.uint64)
    at = set(arrivals.winnow(h, np.array([0, 200, 210, 300]), 12, 5).tolist())
    for a, b in ((0, 200), (210, 300)):
        assert all(any(i in at for i in range(s, s + 12)) for s in range(a, b - 11))
    assert set(range(200, 210)) <= at


@pytest.mark.parametrize("which", ["mate", "star"])
def test_components(spark, which):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 125)] + [(7, 7)]
    df = spark.createDataFrame([*edges, edges[0], (edges[0][1], edges[0][0]), (None, 3), (4, None)], "a long, b long")
    run = components.mate_components if which == "mate" else components.star_components
    got = {r.id: r.root for r in run(df).collect()}
    ids = {x for e in edges for x in e}
    want = sets(edges, ids)
    assert {i: got[i] for i in got} == {i: want[i] for i in got}
    assert all(i in got for e in edges if e[0] != e[1] for i in e)
    assert run(df.limit(0)).count() == 0


def test_splits_keep_entities_together_and_balanced(spark):
    rng = random.Random(2)
    rows = []
    for g in range(300):
        share = rng.random()
        for _ in range(rng.randrange(1, 12) if g else 900):
            rows.append((len(rows), rng.choice((f"G{g}", f" g{g} ")), rng.choice((1, 0, None)) if rng.random() < 0.1 else int(rng.random() < share), f"d/positiv/g{g}/x.pdf"))
    rows.append((len(rows), None, 1, "d/negativ/flat__1.pdf"))
    rec = spark.createDataFrame(rows, "rec long, doc_group string, label int, path string").withColumn("id", F.lit(1)).withColumn("slug", F.lit("x"))
    links = spark.createDataFrame([("g1", "G2 "), ("g2", "g3"), ("g3", "g3"), (None, "g4"), ("", "g5"), ("g2", "g1")], "a string, b string")
    out = splits.split_records(rec, "rec", record_group(rec["doc_group"], rec["path"]), rec["label"], links, "a", "b").collect()
    assert len(out) == len(rows)
    by: dict = {}
    for r in out:
        by.setdefault(r.slug, set()).add(r.split)
    assert all(len(v) == 1 for v in by.values()) and by["g1"] == by["g2"] == by["g3"] and "flat" in by
    size = {s: sum(r.split == s for r in out) / len(out) for s in ("train", "validation", "test")}
    assert abs(size["train"] - 0.8) < 0.05 and abs(size["test"] - 0.1) < 0.05
    label = {r[0]: r[2] for r in rows}
    pos = {s: [label[r.id] == 1 for r in out if r.split == s and label[r.id] is not None] for s in size}
    rate = sum(map(sum, pos.values())) / sum(map(len, pos.values()))
    assert all(abs(sum(v) / len(v) - rate) < 0.12 for v in pos.values())
    roots, _ = splits.entities(rec, record_group(rec["doc_group"], rec["path"]), rec["label"], links, "a", "b")
    assert {tuple(r) for r in splits.linked_pairs(roots, links, "a", "b").collect()} == {("g1", "g2"), ("g1", "g3"), ("g2", "g3")}


def test_splits_of_nothing(spark):
    rec = spark.createDataFrame([], "rec long, doc_group string, label int, path string")
    links = spark.createDataFrame([], "a string, b string")
    assert splits.split_records(rec, "rec", record_group(rec["doc_group"], rec["path"]), rec["label"], links, "a", "b").count() == 0
