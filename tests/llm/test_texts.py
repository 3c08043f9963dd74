"""Page bodies, repeated lines, scans, packing, leaks and pieces."""

import collections
import random
import re

import numpy as np
import pytest
from helpers import words
from pyspark.sql import functions as F

from sheafline.llm import boilerplate, leak, packing, pieces, scans, sitelines
from sheafline.llm.tokens import encode

# Words that carry grammar, and others, of made-up pages in three languages.
LANGUAGES = {
    "de": "der die das und mit von für ist nicht eine auf den im zu werden".split(),
    "en": "the and of to in is not with for a on this that are by".split(),
    "fr": "le la les et des une dans pour est sur avec que du pas qui".split(),
}


def made_site(rng, lang, host):
    """Pages (text, url, furniture line numbers) of a host whose menus, notices, boxes and footers nobody has seen before."""
    coin = lambda n: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiouy") for _ in range(n))
    stop = LANGUAGES[lang]

    def sentence(n):
        ws = [rng.choice(stop) if k % 2 else coin(rng.randrange(2, 5)) for k in range(n)]
        return " ".join(ws).capitalize() + "."

    menu = [coin(rng.randrange(2, 5)).capitalize() for _ in range(9)]
    notice = [sentence(12), sentence(9)]
    buttons = [coin(3).capitalize() for _ in range(2)]
    box, more, skip = coin(4).capitalize(), coin(2), " ".join(coin(2) for _ in range(3)).capitalize()
    heads = [coin(4).capitalize() for _ in range(6)]
    feet = [coin(4).capitalize() for _ in range(4)]
    pages = []
    for _ in range(12):
        title = " ".join(coin(3) for _ in range(4)).capitalize()
        top = [*notice, *buttons, skip] if rng.random() < 0.7 else [skip]
        top += [" | ".join(menu)] if rng.random() < 0.5 else list(menu)
        body = [title]
        for _ in range(rng.randrange(2, 6)):
            body += [rng.choice(heads)] if rng.random() < 0.3 else []
            body += [" ".join(sentence(rng.randrange(7, 14)) for _ in range(rng.randrange(1, 4)))]
        low = [box, *(f"{sentence(8)[:-1]} … {more}" for _ in range(3))] if rng.random() < 0.6 else []
        low += [" · ".join(feet), f"© {coin(3).capitalize()}"]
        lines = top + body + low
        gone = [n for n, _ in enumerate(lines, 1) if n <= len(top) or n > len(top) + len(body)]
        pages.append(("\n".join(lines), f"https://{host}.example/{'-'.join(title.lower().split())}", gone))
    return pages


@pytest.mark.parametrize("lang", sorted(LANGUAGES))
def test_bodies_of_pages_whose_furniture_nobody_has_seen(spark, lang):
    rng = random.Random(lang)
    pages = [p for h in range(8) for p in made_site(rng, lang, f"{lang}{h}")]
    df = spark.createDataFrame([(i, t, u) for i, (t, u, _) in enumerate(pages)], "id long, text string, url string")
    got = {tuple(r) for r in boilerplate.furniture_lines(df, "id", "text", "url").collect()}
    want = {(i, n) for i, (_, _, g) in enumerate(pages) for n in g}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)


def test_single_pages_by_shape():
    labels = boilerplate.label_blocks
    assert labels("", None) == [None] and labels("\n \n", "x") == [None] * 3
    prose = "Die Hafenlehre ist ein Fach, das sich mit dem Bau und der Pflege der Häfen und ihrer Wege befasst."
    assert labels("\n".join(["Kaimauern | Schleusen | Molen | Docks | Kräne", prose, "– Hafenpläne", "Dauer: 2 Tage", "© 2024 Hafen"])) == [0, 1, 1, 1, 0]
    assert labels("Accueil\nServices\nContact\n" + prose) == [0, 0, 0, 1] and labels("Hafenbau und Wege\n" + prose) == [1, 1]
    know = boilerplate.Know({boilerplate.key_of(x) for x in ("Molen", "Docks")}, {boilerplate.key_of("Neues")}, {boilerplate.key_of("Ziele")})
    teasers = [f"{n:02}.03.2024 Vortrag über die Arbeit der Leute an den Häfen und das, was sie von der See wissen" for n in range(1, 13)]
    assert labels("\n".join([prose, "Ziele", prose, "Neues", *teasers, prose, prose]), None, know) == [1, 1, 1, 0] + [0] * 12 + [1, 1]
    # A run of short blocks goes with what leads into it.
    assert labels("\n".join(["Molen", "Buhnen", "Wehre", prose, "Stege", "Poller", "Docks"]), None, know) == [0, 0, 0, 1, 1, 1, 0]
    assert labels("Molen\nDocks Molen\nHafenbau und Wege\n" + prose, None, know) == [0, 0, 1, 1]


def test_page_tables(spark):
    text = "\n".join(["Kaimauern | Schleusen | Molen | Docks | Kräne", "Die Hafenlehre ist ein Fach, das sich mit dem Bau und der Pflege der Häfen befasst."])
    rows = [(1, text, None), (2, None, "u"), (None, text, "u"), (3, "", ""), (1, text, None)]
    df = spark.createDataFrame(rows, "item long, body string, addr string").withColumn("id", F.lit("x")).withColumn("url", F.lit(1)).withColumn("host", F.lit(1))
    got = sorted(tuple(r) for r in boilerplate.furniture_lines(df, "item", "body", "addr").collect())
    assert got == [(1, 1), (1, 1)]
    bodies = sorted((tuple(r) for r in boilerplate.main_bodies(df, "item", "body", "addr").collect()), key=str)
    assert bodies == sorted([(1, text.split("\n")[1])] * 2 + [(2, None), (3, "")], key=str)
    assert boilerplate.furniture_lines(df.limit(0), "item", "body", "addr").count() == 0


def test_long_pages_end():
    boilerplate.label_blocks("wort " * 200_000 + "\n" + "x | " * 50_000, "https://h.example/a")


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(1)
    rows = []
    for i in range(1, 60):
        own = [f"Eigene Zeile Nummer {'abcdefgh'[i % 8] * 4} des Textes mit vielen Buchstaben {''.join(rng.choice('xyz') for _ in range(8))}" for _ in range(3)]
        share = ["Nachdruck, auch in Auszügen, nur mit Zustimmung der Stelle 12", "NACHDRUCK auch in Auszügen nur mit Zustimmung der Stelle!"][i % 2]
        rows.append((i, "g1" if i % 3 else " G2", "p", "\n".join([*own, share, share, "kurz"])))
    rows += [(90, None, "d/positiv/g1/f.pdf", "x\n" + share), (91, "g1", "p", None), (92, None, None, share), (None, "g1", "p", share), (93, "g3", "p", share)]
    return rows


def test_repeated_lines_match_counting(spark, lines):
    df = spark.createDataFrame(lines, "rec long, doc_group string, path string, body string").withColumn("text", F.lit(0)).withColumn("id", F.lit("c"))
    grp = sitelines.record_group(df["doc_group"], df["path"])
    got = {tuple(r) for r in sitelines.repeated_lines(df, "rec", "body", grp).collect()}
    where = collections.defaultdict(set)
    for r, g, p, t in lines:
        g = (g or "").strip().lower() or ("g1" if p and p.startswith("d/") else "")
        for n, l in enumerate((t or "").split("\n"), 1):
            k = "".join(c for c in l.lower() if c.isalpha())
            if r and g and len(k) >= 30:
                where[g, k].add((r, n))
    want = {x for v in where.values() if len({r for r, _ in v}) >= 6 for x in v}
    assert got == want and want
    clean = {r.rec: r.body for r in sitelines.without_repeated_lines(df, "rec", "body", grp).select("rec", "body").collect() if r.rec}
    for r, _, _, t in lines:
        if r:
            assert clean[r] == (None if t is None else "\n".join(l for n, l in enumerate(t.split("\n"), 1) if (r, n) not in want))
    assert sitelines.without_repeated_lines(df, "rec", "body", grp).count() == len(lines)
    assert sitelines.repeated_lines(df.limit(0), "rec", "body", grp).count() == 0


def test_group_of_a_record(spark):
    rows = [("  A ", "x"), (None, "d/m/Positive/uni-x/f__1.pdf"), ("", "d/m/negativ/tu-y__9.pdf"), (None, None), (None, "solo.pdf")]
    df = spark.createDataFrame(rows, "g string, p string")
    assert [r[0] for r in df.select(sitelines.record_group(F.col("g"), F.col("p"))).collect()] == ["a", "uni-x", "tu-y", None, "solo"]


NOUNS = [a + b for a in ("hafen", "brücken", "markt", "wald", "daten", "musik", "sensor", "energie") for b in ("lehre", "pläne", "muster", "verfahren", "analysen", "systeme", "werkzeuge")]


def prose(rng, n=14):
    return "\n".join(
        f"Die Studierenden {rng.choice(('bewerten', 'messen', 'ordnen'))} {rng.choice(NOUNS).capitalize()} und vergleichen dazu {rng.choice(NOUNS).capitalize()} im Bereich der {rng.choice(NOUNS).capitalize()}. "
        f"Vermittelt werden {rng.choice(NOUNS).capitalize()}, {rng.choice(NOUNS).capitalize()} sowie Grundlagen der {rng.choice(NOUNS).capitalize()}." for _ in range(n))


# Misreadings of the pages set below.
MISREAD = (("m", "rn"), ("e", "c"), ("u", "n"), ("h", "b"), ("l", "1"), ("n", "ri"), ("i", "!"), ("a", "o"))


def set_page(rng, text):
    """A scanned page by a rule of its own: [(line, defects)]; words are cut after a vowel, compounds at their hyphen."""
    width, head, page = rng.randrange(50, 75), f"Lehrbuch {rng.choice(NOUNS).capitalize()} {rng.choice(NOUNS).capitalize()}", rng.randrange(2, 90)
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + 1 + len(w) > width:
            room = width - len(line) - 2
            cuts = [k for k in range(3, len(w) - 2) if k <= room and (w[k - 1] in "aeiou" or w[k - 1] == "-") and w.strip(".,").replace("-", "").isalpha()]
            if cuts:
                k = cuts[-1]
                lines.append([f"{line} {w[:k]}" + ("" if w[k - 1] == "-" else "-"), {"hyphen"}])
                line = w[k:]
            else:
                lines.append([line, set()])
                line = w
        else:
            line = f"{line} {w}".strip()
    lines.append([line, set()])
    for l in lines:
        ws = l[0].split()
        k = rng.randrange(1, max(2, len(ws) - 1))
        pair = rng.choice(MISREAD)
        if rng.random() < 0.2 and 0 < k < len(ws) - 1 and len(ws[k]) >= 7 and ws[k].strip(".,").isalpha() and pair[0] in ws[k][1:-2]:
            at = ws[k].index(pair[0], 1)
            ws[k] = ws[k][:at] + pair[1] + ws[k][at + 1:]
            l[0] = " ".join(ws)
            l[1].add("char")
    out = []
    for n, l in enumerate(lines):
        if n and n % 9 == 0:
            out += [[f"- {page} -", {"furniture"}], [head, {"furniture"}]]
            page += 1
        out.append(l)
    return out


def hung(rng):
    return f" Für die Vor- und Nachbereitung von {rng.choice(NOUNS).capitalize()} und der {rng.choice(NOUNS).capitalize()}- und {rng.choice(NOUNS).capitalize()} sowie für E-Learning-Angebote gibt es {rng.choice(NOUNS).capitalize()}. "


@pytest.fixture(scope="module")
def scanned(spark):
    """Born-digital records, and pages of other texts, set here, whose defects are known."""
    rng = random.Random(8)
    text = lambda n: "".join(p + hung(rng) for p in prose(rng, n).split("\n"))
    rows = [(i, "\n".join(p + hung(rng) for p in prose(rng).split("\n")), False) for i in range(1, 160)]
    truth = set()
    for i in range(200, 230):
        page = set_page(rng, text(10))
        truth |= {(i, n, d) for n, (_, ds) in enumerate(page, 1) for d in ds}
        rows.append((i, "\n".join(l for l, _ in page), None if i % 2 else True))
    rows += [(300, None, True), (301, "", None), (302, "  \n ", True), (None, "x", True), (303, "Kurz.", None)]
    return rows, truth


def test_models_look_at_several_features(spark, scanned):
    rows, _ = scanned
    texts = [t for _, t, o in rows if o is False][:60]
    seen = collections.Counter(w for t in texts for w in set(words(t)))
    known = sorted(w for w, n in seen.items() if n > 1)
    models = scans.train(texts, known, np.array([seen[w] for w in known], float), scans.Scans(), ["lehrbuch"])
    for name in ("furniture", "joins", "replace", "misread"):
        used = {f for feat, _, _ in models[name].splits for f in feat.tolist() if f >= 0}
        assert len(used) >= 2, name
    ends = [("das Ver-", "fahren der", 1), ("die E-", "Learning-Angebote", 1), ("zur Vor-", "und Nachbereitung", 0), ("die Hafenlehre-", "und Marktmuster", 0), ("der Brücken\u00ad", "pläne wegen", 1), ("die Energie-", "systeme und", 1)]
    x = np.array([scans.join_features(a, b, models["df"]) for a, b, _ in ends], dtype=float)
    assert [int(v >= 0.5) for v in models["joins"].predict(x)] == [y for *_, y in ends]


def test_scan_defects_are_found(spark, scanned):
    rows, truth = scanned
    df = spark.createDataFrame(rows, "rec long, body string, ocr boolean").withColumn("id", F.lit("x")).withColumn("text", F.lit(2))
    got = {tuple(r) for r in scans.scan_defects(df, "rec", "body", "ocr").collect()}
    for kind, least in (("hyphen", 0.95), ("furniture", 0.95), ("char", 0.9)):
        g, t = {x for x in got if x[2] == kind}, {x for x in truth if x[2] == kind}
        assert len(g & t) / len(t) >= least, kind
        assert len(g & t) / len(g) >= least, kind
    assert all(x[0] >= 200 and x[0] < 300 for x in got)


def test_scans_are_mended(spark, scanned):
    rows, _ = scanned
    df = spark.createDataFrame(rows, "rec long, body string, ocr boolean")
    out = {r.id: r.text for r in scans.repaired(df, "rec", "body", "ocr").collect()}
    src = {r[0]: r[1] for r in rows}
    assert out[1] == src[1] and out[300] is None and out[301] == ""
    known = set(words(" ".join(r[1] for r in rows[:159])))
    before = np.mean([np.mean([w in known for w in words(src[i])]) for i in range(200, 230)])
    after = np.mean([np.mean([w in known for w in words(out[i])]) for i in range(200, 230)])
    assert after > 0.97 > before


def test_scans_without_digital_records(spark):
    df = spark.createDataFrame([(1, "Ein Text der zu-\nsammen gehört und m!t Fehler\n- 3 -", True)], "id long, text string, o boolean")
    got = {tuple(r) for r in scans.scan_defects(df, "id", "text", "o").collect()}
    assert all(r[0] == 1 for r in got)
    assert scans.scan_defects(df.limit(0), "id", "text", "o").count() == 0


def test_parts_of_words_are_known_however_rare(spark, scanned):
    rows, _ = scanned
    rows = [*rows, *((i, "Der Text nennt quarzit und auch zinnober.", False) for i in (900, 901)), (902, "Hier steht quarzit'zinnober im Text,\nder auch quarzit'xyxyx nennt.", True)]
    df = spark.createDataFrame(rows, "rec long, body string, ocr boolean")
    found = {}
    for most in (40, 50_000):
        o = scans.Scans(known_words=most)
        records = scans.as_records(df, "rec", "body", "ocr", o)
        found[most] = {r.word for r in scans._findings(records, o)[0].where("id = 902 and defect = 'word'").collect()}
    assert "quarzit'xyxyx" in found[40] and "quarzit'zinnober" not in found[40] and found[40] == found[50_000]


def test_ranking_on_held_out_words():
    rng = np.random.default_rng(3)
    known = sorted(set(NOUNS))
    models = scans.train([prose(random.Random(i)) for i in range(5)], known, np.full(len(known), 9.0), scans.Scans(seed=11))
    good = total = 0
    for w in known:
        read = scans.misread(w, rng).lower()
        near = [v for v in known if v != read and scans._middle(read, v) <= 3]
        if read == w or not near:
            continue
        p = models["replace"].predict(scans.pair_features([read] * len(near), near, np.full(len(near), 9.0), np.full(len(near), float(len(near)))))
        total += 1
        good += near[int(p.argmax())] == w
    assert good / total > 0.85


def test_packing_places_every_item_once(spark):
    rng = random.Random(6)
    texts = {i: " ".join(rng.choice(NOUNS) for _ in range(rng.randrange(1, 60))) for i in range(1, 200)}
    texts[500] = " ".join(rng.choice(NOUNS) for _ in range(900)) + " 日本語" * 40
    df = spark.createDataFrame([*texts.items(), (600, None), (601, ""), (None, "x")], "doc long, body string").withColumn("id", F.lit(0)).withColumn("text", F.lit(0))
    o = packing.Packing(capacity=256)
    rows = packing.pack(df, "doc", "body", o).collect()
    room = collections.Counter()
    chars = collections.defaultdict(list)
    for r in rows:
        room[r.container] += r.n_tokens
        chars[r.id].append((r.start_char, r.end_char))
        assert len(encode(texts[r.id][r.start_char:r.end_char])) <= 256
    assert max(room.values()) <= 256 and set(chars) == set(texts)
    for i, c in chars.items():
        c.sort()
        assert c[0][0] == 0 and c[-1][1] == len(texts[i]) and all(a[1] == b[0] for a, b in zip(c, c[1:]))
        assert len(c) == 1 or len(encode(texts[i])) > 256
    assert sum(room.values()) / (256 * len(room)) > 0.95
    assert {tuple(r) for r in packing.pack(df, "doc", "body", o).collect()} == {tuple(r) for r in rows}
    assert packing.pack(df.limit(0), "doc", "body", o).count() == 0


def test_neighbours_share_words(spark):
    rng = random.Random(7)
    topics = [[f"{t}{i}" for i in range(30)] for t in ("hafen", "wald", "musik", "daten")]
    texts = [(i, i % 4, " ".join(rng.choice(topics[i % 4]) for _ in range(40))) for i in range(240)]
    df = spark.createDataFrame([(a, c) for a, _, c in texts], "id long, text string")
    box = collections.defaultdict(list)
    for r in packing.pack(df, "id", "text", packing.Packing(capacity=1024)).collect():
        box[r.container].append(r.id % 4)
    assert np.mean([max(collections.Counter(v).values()) / len(v) for v in box.values()]) > 0.7


def test_leaks_match_scanning(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(50)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(6, 40)))) for i in range(30)]
    docs = []
    for d in range(80):
        w = [rng.choice(vocab) for _ in range(50)]
        src = rng.choice(items)[1].split()
        if d % 2 and len(src) > 12:
            n = rng.randrange(9, 15)
            s = rng.randrange(0, max(1, len(src) - n))
            w[10:10] = src[s:s + n]
        docs.append((d, " ".join(w).upper() if d % 3 else ", ".join(w)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, items[1][1] * 2)]
    items += [(50, None), (51, ""), (52, items[3][1]), (None, "x")]
    d = spark.createDataFrame(docs, "doc long, body string").withColumn("id", F.lit(1))
    i = spark.createDataFrame(items, "item long, body string").withColumn("id", F.lit(1))
    grams = lambda t: {tuple(words(t)[k:k + 12]) for k in range(len(words(t)) - 11)}
    g = {a: grams(t) for a, t in items if a is not None}
    want = {(a, b) for a, t in docs if a is not None for b in g if grams(t) & g[b]}
    assert {tuple(r) for r in leak.leaks(d, "doc", "body", i, "item", "body").collect()} == want and want
    small = leak.Leak(block_windows=20)
    assert {tuple(r) for r in leak.leaks(d, "doc", "body", i, "item", "body", small).collect()} == want
    assert leak.leaks(d.limit(0), "doc", "body", i, "item", "body").count() == 0 and leak.leaks(d, "doc", "body", i.limit(0), "item", "body").count() == 0


def brute_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def with_edits(rng, w, n):
    w = list(w)
    for _ in range(n):
        k, kind = rng.randrange(len(w)), rng.randrange(3)
        w[k:k + (kind != 1)] = [] if kind == 2 else [f"n{rng.randrange(10**6)}"]
    return w


@pytest.mark.parametrize("edits", [1, 2, 3, 4])
def test_edited_windows_reach_the_recall(spark, edits):
    rng = random.Random(edits)
    items, docs, n = [], [], 0
    while n < 500:  # documents of one window each, truly ``edits`` edits from the item's
        w = [f"q{n}x{k}" for k in range(12)]
        v = (with_edits(rng, w, edits) + [f"r{n}x{k}" for k in range(12)])[:12]
        if brute_distance(w, v) == edits:
            items.append((n, " ".join(w)))
            docs.append((n, " ".join(v)))
            n += 1
    o = leak.Leak(max_edits=edits)
    table = lambda rows: spark.createDataFrame(rows, "id long, text string")
    got = {tuple(r) for r in leak.leaks(table(docs), "id", "text", table(items), "id", "text", o).collect()}
    assert got <= {(i, i) for i in range(n)} and len(got) >= 0.99 * n
    if edits < 3:
        assert leak.leaks(table(docs), "id", "text", table(items), "id", "text", leak.Leak(max_edits=edits - 1)).count() == 0


def test_windows_grow_with_the_item(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate((12, 23, 24, 40, 47, 48, 70, 100, 120) * 6)]
    docs = []
    for i, t in items:
        w, size = t.split(), 12 * 2 ** int(np.log2(len(t.split()) / 12))
        for part, off in ((w[:size], 0), (w[-size:], 1000), (w[:size - size // 12 - 1], 2000)):  # the last is short by more than may be edited
            v = with_edits(rng, part, size // 24) if off < 2000 else part
            docs.append((i + off, " ".join([f"a{k}" for k in range(15)] + v + [f"b{k}" for k in range(15)])))
    o = leak.Leak(max_edits=1, item_sized=True)
    table = lambda rows: spark.createDataFrame(rows, "id long, text string")
    got = {tuple(r) for r in leak.leaks(table(docs), "id", "text", table(items), "id", "text", o).collect()}
    want = set()
    for d, t in docs:
        w = t.split()
        i = d % 1000
        x = items[i][1].split()
        size = 12 * 2 ** int(np.log2(len(x) / 12))
        if any(brute_distance(x[p:p + size], w[q:q + size]) <= size // 12 for p in range(len(x) - size + 1) for q in range(max(0, 15 - 4), min(len(w) - size, 15 + size // 12 + 4) + 1)):
            want.add((d, i))
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) >= 100


def test_distances_of_many_rows():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 4, (300, 9)).astype(np.uint64)
    b = np.where(rng.random((300, 9)) < 0.7, a, rng.integers(0, 4, (300, 9)).astype(np.uint64))
    b[:100] = np.roll(b[:100], 1, 1)
    for most in range(4):
        assert leak.distance_within(a, b, most).tolist() == [brute_distance(x.tolist(), y.tolist()) <= most for x, y in zip(a, b)]


def check_pieces(text, rows, limit, overlap):
    rows = sorted(rows, key=lambda r: r.piece_no)
    assert [r.piece_no for r in rows] == list(range(1, len(rows) + 1))
    assert rows[0].start_char == 0 and rows[-1].end_char == len(text)
    for r in rows:
        assert r.piece == text[r.start_char:r.end_char] and len(encode(r.piece)) <= limit and r.n_tokens <= limit
    for a, b in zip(rows, rows[1:]):
        assert b.start_char <= a.end_char < b.end_char and overlap - 3 <= b.overlap_tokens <= overlap or overlap == 0 or a.n_tokens < overlap
    return rows


def test_pieces_cover_overlap_and_break(spark):
    rng = random.Random(9)
    short = lambda: " ".join(rng.choice(NOUNS) for _ in range(rng.randrange(4, 10))) + "."
    texts = {1: "\n\n".join(short() for _ in range(60)), 2: "\n".join(short() for _ in range(60)), 3: " ".join(short() for _ in range(60)), 4: "日本語" * 300, 5: "x" * 3000, 6: " " * 3000, 7: "a\r\n" * 700,
             8: "é😀" * 400, 9: "kurz", 10: None, 11: ""}
    df = spark.createDataFrame([*texts.items(), (None, "y " * 900)], "doc long, body string").withColumn("id", F.lit(0)).withColumn("text", F.lit(0))
    by = collections.defaultdict(list)
    for r in pieces.split_pieces(df, "doc", "body", 128, 16).collect():
        by[r.id].append(r)
    assert set(by) == {i for i, t in texts.items() if t and len(encode(t)) > 128}
    for i, rows in by.items():
        check_pieces(texts[i], rows, 128, 16)
    assert all(texts[1][:r.end_char].endswith("\n\n") for r in by[1] if r.end_char < len(texts[1]))
    assert all(texts[2][r.end_char - 1] == "\n" for r in by[2] if r.end_char < len(texts[2]))
    assert all(re.search(r"[.!?]$", texts[3][:r.end_char].rstrip()) for r in by[3] if r.end_char < len(texts[3]))
    assert {r.id for r in pieces.split_pieces(df, "doc", "body", 128, 16, keep_small=True).collect()} == {i for i, t in texts.items() if t}
    assert pieces.split_pieces(df.limit(0), "doc", "body", 128, 16).count() == 0
    with pytest.raises(ValueError):
        pieces.split_pieces(df, "doc", "body", 20, 16)
    none = collections.defaultdict(list)
    for r in pieces.split_pieces(df.where("doc <= 3"), "doc", "body", 128, 0).collect():
        none[r.id].append(r)
    assert all("".join(r.piece for r in sorted(v, key=lambda r: r.piece_no)) == texts[i] for i, v in none.items())


def test_very_long_text_is_cut_whole(spark):
    text = "Ein Satz mit Wörtern. " * 40_000
    rows = pieces.split_pieces(spark.createDataFrame([(1, text)], "id long, text string"), "id", "text", 512, 0).collect()
    assert "".join(r.piece for r in sorted(rows, key=lambda r: r.piece_no)) == text


def test_queries_run(spark, data):
    from sheafline.llm import queries

    for name in ("p1_found", "p5_found", "p8_found", "p7_pack", "p9_pieces"):
        assert queries.QUERIES[name](spark, data).count() >= 0
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert queries.p4_found(spark, data).columns == ["accepted_id", "rec_id"]


def test_neighbours_meet_however_many_shards(spark):
    rng = random.Random(6)
    topics = [[f"t{k}w{i}" for i in range(40)] for k in range(60)]
    stock = [f"s{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(topics[i % 60] if rng.random() < 0.5 else stock) for _ in range(rng.randrange(20, 90)))) for i in range(1500)]
    o = packing.Packing(capacity=600, shard_items=50)
    got = packing.pack(spark.createDataFrame(rows, "id long, text string"), "id", "text", o).collect()
    assert sorted(r.id for r in got) == list(range(1500)) and len({r.container >> 32 for r in got}) >= 20
    boxes = collections.defaultdict(list)
    for r in got:
        boxes[r.container].append((r.id % 60, r.n_tokens))
    assert all(sum(n for _, n in b) <= 600 for b in boxes.values())
    same = sum(sum(k == b[0][0] for k, _ in b) - 1 for b in boxes.values()) / sum(len(b) - 1 for b in boxes.values() if b)
    assert same > 0.3  # by chance it would be 1 / 60
    assert sum(n for b in boxes.values() for _, n in b) / (600 * len(boxes)) > 0.85
