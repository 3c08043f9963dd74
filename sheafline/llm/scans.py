"""Problem 6: texts of scanned pages repaired into continuous paragraphs.

Line-pair classifiers decide which lines are page furniture and which line ends go on in the next
line.  Words that no born-digital record has are looked up by character q-grams: an inverted join
on their head and tail grams, whose length grows with the word's, brings the known words that differ
in one place; a gradient-boosted ranking chooses among them, and another model says from the best
score and the look of the word whether it was misread at all.  The models are trained on pages made
from a bounded sample of born-digital texts, wrapped, hyphenated, misread and given headers; counts
of words, and the words that head running titles, are taken over all records.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import vec
from .cluster import durable, map_batches
from .gbm import Boosted

# What a scanner takes letters for, as printed -> read.
CONFUSIONS = {
    "m": ("rn", "nn"), "rn": ("m",), "n": ("ri", "u"), "u": ("n", "ii"), "e": ("c",), "c": ("e",), "h": ("b",), "b": ("h",), "t": ("f",),
    "f": ("t",), "i": ("l", "!", "1"), "l": ("1", "i", "!", "I"), "w": ("vv",), "o": ("0",), "ö": ("6", "o"), "ä": ("a",), "ü": ("ii", "u"),
    "g": ("q", "9"), "q": ("g",), "s": ("5",), "d": ("cl",), "cl": ("d",), "a": ("o",), "ß": ("B", "b"), "z": ("2",), "fi": ("ﬁ",), "fl": ("ﬂ",),
    "H": ("B",), "T": ("F",), "S": ("5",), "M": ("RN",), "E": ("C", "F"), "I": ("l", "1", "!"), "O": ("0",), "B": ("8", "R"), "G": ("6", "C"),
    "N": ("RI",), "U": ("N",), "Z": ("2",), "L": ("1", "I"), "Ü": ("U",), "Ä": ("A",), "Ö": ("O",),
}
#: Hyphens at line ends.
HYPHENS = "-‐­¬‑"
SMALL_WORDS = frozenset("der die das den dem des ein eine und oder zu zur zum im in an auf aus mit von vor für über sind ist wird werden ihre als nach bei the a an of and or to for in on with from is are be".split())

WORD = re.compile(r"[^\W_]+")
TOKEN = re.compile(r"\S+")
INNER_SIGN = re.compile(r"(?<=[^\W_])[!|](?=[^\W_])")
NUMBER_LINE = re.compile(r"^\W*(?:(?:seite|page|blatt|s\.?|p\.?)\s*)?[\dlIOoSB]{1,4}(?:\s*(?:/|von|of)\s*[\dlIOoSB]{1,4})?\W*$", re.I)
ROMAN = re.compile(r"^\W*[ivxlcdm]{1,7}\W*$", re.I)
CODE = re.compile(r"^[A-ZÄÖÜ]{2,5}\d+$")


@dataclass(frozen=True)
class Scans:
    sample_records: int = 400       # born-digital records the models are trained on, at most
    sample_chars: int = 20_000      # ... each of this length at most: the labelled rows fit the driver
    sample_words: int = 3_000       # known words the ranking is trained on, among 12,000 at most
    head_share: float = 0.02        # a word that heads this share of the lines cut into the text heads titles
    known_words: int = 50_000       # most frequent words known to every task; all others are joined
    min_records: int = 2            # a word of fewer records is no evidence of spelling
    line_chars: int = 100           # a line of a scanned page is rarely longer
    long_lines: float = 0.05        # ... than in this share of its lines
    furniture: float = 0.5
    joins: float = 0.5
    replace: float = 0.5
    misread: float = 0.5
    seed: int = 3


def is_scanned(ocr_used: Column, text: Column, o: Scans = Scans()) -> Column:
    """True for scanned records: known to be, or unknown and set, but for few lines, in short lines that run on."""
    widths = F.filter(F.transform(F.split(text, "\n"), lambda l: F.length(F.rtrim(l))), lambda n: n > 0)
    long = F.size(F.filter(widths, lambda n: n > o.line_chars))
    runs_on = F.regexp_count(text, F.lit(r"[\p{L},\x{AD}\x{AC}\x{2010}-][ \t]*\n\s*\p{Ll}"))
    return F.coalesce(ocr_used, (long <= o.long_lines * F.size(widths)) & (runs_on >= 2))


# ---- lines ---------------------------------------------------------------------------------

#: Digits read for letters at the head of a word.
DIGITS = str.maketrans({"5": "S", "0": "O", "1": "I", "8": "B", "6": "G", "2": "Z", "9": "g", "!": "I"})


def _pairs(a: str) -> frozenset:
    return frozenset(a[i:i + 2] for i in range(len(a) - 1))


def _share(x: frozenset, y: frozenset) -> float:
    return len(x & y) / max(1, len(x | y))


def _title_like(word: str, heads: tuple[frozenset, ...], seen: dict[str, float]) -> float:
    """Share of character pairs the word has in common with the nearest word that heads running titles."""
    if word not in seen:
        x = _pairs(word)
        seen[word] = max((_share(x, t) for t in heads), default=0.0)
    return seen[word]


def line_features(lines: list[str], heads: tuple[frozenset, ...], seen: dict[str, float]) -> np.ndarray:
    """One row a non-blank line: what it looks like itself and between its neighbours."""
    n = len(lines)
    strip = [l.strip() for l in lines]
    low = [s.lower() for s in strip]
    short = [re.sub(r"[\W\d]+", "", s) for s in low]
    width = max(map(len, strip), default=1)
    out = np.zeros((n, 20))
    tokens = [WORD.findall(INNER_SIGN.sub("i", s)) for s in strip]
    named = [[w.translate(DIGITS) if w[:1].isdigit() else w for w in ws if sum(map(str.isalpha, w)) >= 2] for ws in tokens]
    caps = [sum(w[:1].isupper() for w in ws) / len(ws) if ws else 0.0 for ws in named]
    pairs = {i: _pairs(short[i]) for i in range(n) if caps[i] > 0.6 and 2 <= len(named[i]) <= 8 and len(short[i]) >= 8 and not strip[i].endswith(".")}
    for i, s in enumerate(strip):
        words, letters = tokens[i], named[i]
        before = strip[i - 1] if i else ""
        after = strip[i + 1] if i + 1 < n else ""
        small = sum(w.lower() in SMALL_WORDS for w in words)
        upper = sum(map(str.isupper, s))
        alpha = sum(map(str.isalpha, s))
        lead = letters[0].lower() if letters else ""
        like_title = _title_like(lead, heads, seen) if lead else 0.0
        if len(letters) >= 4 and caps[i] > 0.6:
            like_title = max(like_title, _title_like(letters[-3].lower(), heads, seen))
        capital = caps[i]
        twin = max((_share(pairs[i], q) for j, q in pairs.items() if j != i), default=0.0) if i in pairs else 0.0
        cut_before = bool(before) and before[-1:] not in ".!?:" and len(before) > 0.55 * width
        out[i] = (
            len(s), len(words), small, capital, upper / max(1, alpha), s[-1:] in ".!?:", bool(NUMBER_LINE.match(s)), bool(ROMAN.match(s)),
            like_title, twin, cut_before, after[:1].islower(), cut_before and after[:1].islower() and not s[:1].islower(),
            s[:1].isdigit(), s[-1:].isdigit(), "\f" in lines[i], s[:1].islower(), alpha / max(1, len(s)), "|" in s or "   " in s, ":" in s,
        )
    return out


JOIN_FEATURES = 11


def join_features(line: str, after: str, df: dict[str, float]) -> tuple | None:
    """Of a line pair whose first line ends in a hyphen: how common the parts and the whole are, and how they look; None for any other."""
    s = line.rstrip()
    if len(s) < 2 or s[-1] not in HYPHENS or not s[-2].isalnum():
        return None
    nxt = WORD.search(after)
    head = WORD.findall(s[:-1])
    a, b = head[-1] if head else "", nxt.group() if nxt else ""
    lead = after.strip()[:1]
    often = lambda w: math.log1p(df.get(w.lower(), 0.0))
    return (s[-1] == "-", often(a + b), often(a), often(b), lead.islower(), lead.isupper(), a[-1:].isdigit(), lead.isdigit() or not b, len(a), len(b), a.isupper() and b.isupper())


def read_lines(text: str) -> tuple[list[int], list[str]]:
    """Numbers (from 1) and texts of the non-blank lines."""
    raw = text.split("\n")
    at = [i for i, l in enumerate(raw) if l.strip()]
    return [i + 1 for i in at], [raw[i] for i in at]


def read_pages(texts: list[str], models: dict, o: Scans) -> Iterator[tuple[list[int], list[str], np.ndarray, list[int | None]]]:
    """Of each text (line numbers, lines, furniture flags, for each line the index of the line its last word goes on in)."""
    read = [read_lines(t) for t in texts]
    seen: dict[str, float] = {}
    x = [line_features(lines, models["heads"], seen) for _, lines in read if lines]
    furn = models["furniture"].predict(np.concatenate(x)) >= o.furniture if x else np.zeros(0, bool)
    pages, ends, feats, at = [], [], [], 0
    for n, (nos, lines) in enumerate(read):
        own = furn[at:at + len(lines)]
        at += len(lines)
        pages.append((nos, lines, own, [None] * len(lines)))
        running = np.flatnonzero(~own).tolist()
        for a, b in zip(running, running[1:]):
            f = join_features(lines[a], lines[b], models["df"])
            if f is not None:
                ends.append((n, a, b))
                feats.append(f)
    if feats:
        for (n, a, b), v in zip(ends, models["joins"].predict(np.array(feats, dtype=float))):
            if v >= o.joins:
                pages[n][3][a] = b
    yield from pages


def _blocks(texts: list[str], most: int = 500_000) -> Iterator[tuple[int, int]]:
    return vec.chunks(np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts)), most)


EDGE = ".,;:()[]{}\"'»«„“”’–—|*•·?…"


def words_of(lines: list[str], furn: np.ndarray, goes: list[int | None]) -> Iterator[tuple[str, int, int, int]]:
    """(word as read, index of its line, index of the line it ends in, letters in the first line)."""
    carry: tuple[str, int] | None = None
    for i, line in enumerate(lines):
        if furn[i]:
            continue
        toks = TOKEN.findall(line.replace("\f", " "))
        for k, t in enumerate(toks):
            last = k == len(toks) - 1
            if k == 0 and carry:
                head, at = carry
                carry = None
                body = t.strip(EDGE).rstrip(HYPHENS) if not (last and goes[i] is not None) else t.strip(EDGE)
                parts = re.split(f"[{HYPHENS}]", body)
                yield head + parts[0], at, i, len(head)
                parts = parts[1:]
                if last and goes[i] is not None and parts:
                    carry = (parts[-2] if len(parts) > 1 and not parts[-1] else parts[-1], i)
                    parts = parts[:-2] if not parts[-1] else parts[:-1]
                for p in parts:
                    if p:
                        yield p, i, i, len(p)
                continue
            if last and goes[i] is not None:
                body = t.lstrip(EDGE)[:-1]
                parts = re.split(f"[{HYPHENS}/]", body)
                carry = (parts[-1].strip(EDGE), i)
                parts = parts[:-1]
            else:
                parts = re.split(f"[{HYPHENS}/]", t.strip(EDGE))
            for p in parts:
                p = p.strip(EDGE)
                if p:
                    yield p, i, i, len(p)


def odd(word: str) -> bool:
    """A word with a sign or digit where only a letter can stand."""
    if CODE.match(word) or not any(c.isalpha() for c in word):
        return False
    if re.search(r"[^\W\d_][!|€$][^\W\d_]|^[!|][^\W\d_]{2}|[^\W\d_]{2}\d[^\W\d_]|[^\W\d_]\d[^\W\d_]{2}|^\d[^\W\d_]{3}", word):
        return not re.match(r"^\d+(?:st|nd|rd|th|er|te[rsnm]?|fach|jährig\w*|kb|mb|h|cp|lp)$", word, re.I)
    return False


# ---- training on made-up pages -----------------------------------------------------------------

def misread(word: str, rng: np.random.Generator) -> str:
    spots = [(i, k) for k in CONFUSIONS for i in range(len(word) - len(k) + 1) if word.startswith(k, i)]
    if not spots:
        return word
    i, k = spots[rng.integers(len(spots))]
    read = CONFUSIONS[k]
    return word[:i] + read[rng.integers(len(read))] + word[i + len(k):]


def made_page(text: str, nouns: list[str], rng: np.random.Generator, heads: list[str]) -> tuple[list[str], list[bool], list[bool]]:
    """A scanned page set from a text: (lines, furniture flags, whether a word was divided at the line's end).

    Words are divided anywhere, or at a hyphen of their own; a line may also end, undivided, in a
    hyphen that the text has there.
    """
    width = int(rng.integers(48, 92))
    sign = HYPHENS[rng.integers(4)]
    made: list[tuple[str, bool]] = []
    for p in text.split("\n"):
        line = ""
        for w in p.split():
            while line and len(line) + 1 + len(w) > width:
                room = width - len(line) - 2
                own = w.rfind("-", 1, max(1, room + 1))
                if own > 0 and own < len(w) - 1 and rng.random() < 0.6:
                    made.append((f"{line} {w[:own + 1]}", True))
                    line, w = "", w[own + 1:]
                elif room >= 2 and len(w) > 5 and room < len(w) - 2 and w.isalpha() and rng.random() < 0.6:
                    made.append((f"{line} {w[:room]}{sign}", True))
                    line, w = "", w[room:]
                else:
                    made.append((line, False))
                    line = ""
            line = f"{line} {w}".strip() if line else w
            if w[-1] in HYPHENS and rng.random() < 0.5:
                made.append((line, False))
                line = ""
        if line:
            made.append((line, False))
    lines = [(l, d) for l, d in made if l.strip()]
    head = (heads or nouns)[rng.integers(len(heads or nouns))].capitalize()
    title = " ".join([head, nouns[rng.integers(len(nouns))], nouns[rng.integers(len(nouns))]])
    style, number = rng.integers(6), rng.integers(9)
    every = int(rng.integers(12, 40))
    page = int(rng.integers(1, 130))
    out, flags, divided = [], [], []

    def say(s: str) -> str:
        if rng.random() < 0.6:
            ws = s.split(" ")
            i = int(rng.integers(len(ws)))
            ws[i] = misread(ws[i], rng)
            s = " ".join(ws)
        return s

    def num() -> str:
        roman = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"][page % 10]
        return [f"{page}", f"   {page}", f"- {page} -", f"[{page}]", f"S. {page}", f"Blatt {page}", f"Seite {page} von 140", f"{page}/140", roman][number]

    def title_line() -> str:
        t = title.upper() if style == 1 else title
        t = [t, t, f"{page} | {t}", f"{t}    {page}", f"{t} – Ausgabe {page % 9 + 1}", t][style]
        for _ in range(rng.integers(4)):
            t = say(t)
        return t

    top = rng.random() < 0.7
    with_number = rng.random() < 0.8
    def put(l: str, furniture: bool, cut: bool = False) -> None:
        out.append(l)
        flags.append(furniture)
        divided.append(cut)

    for i, (l, cut) in enumerate(lines):
        if i and i % every == 0:
            if with_number:
                put(say(num()) if rng.random() < 0.1 else num(), True)
            page += 1
            if top:
                put(("\f" if rng.random() < 0.3 else "") + title_line(), True)
        put(say(l) if rng.random() < 0.3 else l, False, cut)
    if with_number:
        put(num(), True)
    elif top:
        put(title_line(), True)
    return out, flags, divided


def pair_features(read: list[str], known: list[str], df: np.ndarray, rivals: np.ndarray) -> np.ndarray:
    """Of a word as read (lower case) and a known word: how far apart, and whether scanners err like that."""
    low = {(p.lower(), r.lower()) for p, rs in CONFUSIONS.items() for r in rs}
    out = np.zeros((len(read), 10))
    for i, (a, b) in enumerate(zip(read, known)):
        m = min(len(a), len(b))
        s = 0
        while s < m and a[s] == b[s]:
            s += 1
        e = 0
        while e < m - s and a[-1 - e] == b[-1 - e]:
            e += 1
        x, y = a[s:len(a) - e], b[s:len(b) - e]
        usual = (y, x) in low
        if not usual and len(y) == len(x):  # several places, each one usual
            usual = all(p == q or (q, p) in low for p, q in zip(x, y))
        if not usual:
            for w in (1, 2):  # a usual place with equal neighbours folded in
                usual = usual or any((y[i0:len(y) - j0], x[i0:len(x) - j0]) in low and y[:i0] == x[:i0] for i0 in range(w) for j0 in range(w))
        out[i] = (len(x), len(y), max(len(x), len(y)), usual, len(b), s, e, abs(len(a) - len(b)), x == "" or y == "", any(c.isdigit() or c == "!" for c in a))
    return np.column_stack([out, np.log1p(df), rivals])


def word_features(words: list[str], score: np.ndarray, rivals: np.ndarray) -> np.ndarray:
    """Of an unknown word (lower case): the best candidate's score, how many there were, and the look of the word."""
    out = np.zeros((len(words), 7))
    for i, w in enumerate(words):
        sign = len(re.findall(r"(?<=[^\W\d_])[!|€$]|^[!|]", w))
        digits = sum(map(str.isdigit, w))
        out[i] = (sign, digits, w[:1].isdigit(), w[-1:].isdigit(), len(w), bool(re.match(r"^[^\W\d_]+\d+$", w)), bool(re.match(r"^\d+[^\W\d_]{1,3}$", w)))
    return np.column_stack([score, np.log1p(rivals), out])


def train(texts: list[str], words: list[str], df: np.ndarray, o: Scans, heads: list[str] = ()) -> dict:
    """The models, from born-digital texts, known words (lower case, with their record counts) and the heads of running titles."""
    rng = np.random.default_rng(o.seed)
    nouns = sorted({w for t in texts for w in re.findall(r"\b[A-ZÄÖÜ][a-zäöüß]{5,}\b", t)}) or ["Muster"]
    count = dict(zip(words, df.tolist()))
    shapes = tuple(_pairs(h) for h in heads)
    xs, ys, xj, yj = [], [], [], []
    for t in texts:
        if len(t) < 200:
            continue
        lines, flags, divided = made_page(t, nouns, rng, list(heads))
        xs.append(line_features(lines, shapes, {}))
        ys.append(np.array(flags, dtype=float))
        run = [(l, d) for l, f, d in zip(lines, flags, divided) if not f]
        for (a, cut), (b, _) in zip(run, run[1:]):
            f = join_features(a, b, count)
            if f is not None:
                xj.append(f)
                yj.append(float(cut))
    models = {"heads": shapes, "df": count,
              "furniture": Boosted(trees=60).fit(np.concatenate(xs), np.concatenate(ys)) if xs else Boosted(trees=0).fit(np.zeros((2, 20)), np.zeros(2)),
              "joins": Boosted(trees=60).fit(np.array(xj or [(0,) * JOIN_FEATURES] * 2, dtype=float), np.array(yj or [1.0] * 2))}
    # Ranking: misread known words against all known words near them; some words are taken out of the
    # known ones and read as they are, which must be left alone, or misread, which has no right choice.
    some = list(range(0, len(words), max(1, len(words) // 12_000)))
    pick = [i for i in some if len(words[i]) >= 3 and words[i].isalpha()]
    rng.shuffle(pick)
    pick = pick[:o.sample_words]
    spare = min(o.sample_words // 3, len(pick) // 3)
    out = {words[i] for i in pick[:spare]}
    index: dict[tuple, list[int]] = {}
    for i in some:
        if words[i] not in out:
            for key in grams_known(words[i]):
                index.setdefault(key, []).append(i)
    asked: list[tuple[str, str | None, bool]] = []  # (as read, the right choice, whether misread)
    for n, i in enumerate(pick):
        read = misread(words[i], rng).lower()
        if n < spare:
            asked.append((words[i], None, False))
        if read != words[i]:
            asked.append((read, None if n < spare else words[i], True))
    for t in texts:  # codes and numbers with letters, as they are
        asked += [(w, None, False) for w in {m.lower() for m in re.findall(r"\w+", t) if odd(m)} if w not in count][:20]
    left, right, freq, many, label, owner = [], [], [], [], [], []
    for a, (read, true, _) in enumerate(asked):
        near = sorted({j for key in grams_read(read) for j in index.get(key, ()) if words[j] != read and abs(len(words[j]) - len(read)) <= 2 and _middle(read, words[j]) <= 3})
        for j in near:
            for held, v in ((left, read), (right, words[j]), (freq, df[j]), (many, len(near)), (label, float(words[j] == true)), (owner, a)):
                held.append(v)
    score, rivals = np.zeros(len(asked)), np.zeros(len(asked))
    models["replace"] = Boosted(trees=0).fit(np.zeros((2, 12)), np.zeros(2))
    if sum(label) >= 5:
        x = pair_features(left, right, np.array(freq, float), np.array(many, float))
        models["replace"] = Boosted(trees=60).fit(x, np.array(label))
        np.maximum.at(score, np.array(owner), models["replace"].predict(x))
        rivals = np.bincount(np.array(owner), minlength=len(asked)).astype(float)
    wrong = np.array([m for *_, m in asked], dtype=float)
    models["misread"] = Boosted(trees=40).fit(word_features([r for r, *_ in asked], score, rivals), wrong) if 0 < wrong.sum() < len(wrong) else \
        Boosted(trees=0).fit(np.zeros((2, 9)), np.zeros(2))
    return models


def _middle(a: str, b: str) -> int:
    m = min(len(a), len(b))
    s = 0
    while s < m and a[s] == b[s]:
        s += 1
    e = 0
    while e < m - s and a[-1 - e] == b[-1 - e]:
        e += 1
    return max(len(a), len(b)) - s - e


def _grams(w: str, n: int) -> list[tuple]:
    """Head and tail grams of w that a word read with n letters keeps one of, if it differs in one place of up to two letters.

    Of the n - 2 letters left (n - 1 for three), one side keeps more than half, or both just half.
    """
    rest = n - 2 if n > 3 else n - 1
    if rest < 2 and n < 3:
        return []
    long = rest // 2 + 1
    out = [(n, "H", w[:long]), (n, "T", w[-long:])] if len(w) >= long else []
    if rest % 2 == 0 and len(w) >= rest:
        out.append((n, "B", w[:rest // 2] + w[len(w) - rest // 2:]))
    return out


def grams_read(w: str) -> list[tuple]:
    return _grams(w, len(w))


def grams_known(w: str) -> list[tuple]:
    return [g for n in range(len(w) - 2, len(w) + 3) for g in _grams(w, n)]


# ---- the operator --------------------------------------------------------------------------------

def spelling(digital: DataFrame) -> DataFrame:
    """(word, n): lower-case words of all born-digital texts with the number of records that have them."""

    def count(cols):
        seen: dict[str, int] = {}
        for t in cols["text"].to_pylist():
            for w in set(WORD.findall(t.lower())):
                seen[w] = seen.get(w, 0) + 1
        words = [w for w in seen if any(c.isalpha() for c in w)]
        yield {"word": words, "n": [seen[w] for w in words]}

    return map_batches(digital.select("text").where("length(text) > 0"), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hash_of(gram: tuple) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(map(str, gram))) - 2**63


def title_heads(scanned: DataFrame, o: Scans) -> list[str]:
    """Words that head lines cut into the running text of scanned pages, over all of them.

    Such a line, mostly of capitalised words, stands where the line before breaks off and the next
    goes on in lower case.  No more than 1 / head_share words can reach the share.
    """

    def cut_in(cols):
        words: list[str] = []
        for t in cols["text"].to_pylist():
            lines = [l.strip() for l in t.split("\n")]
            lines = [l for l in lines if l and not NUMBER_LINE.match(l)]
            for before, line, after in zip(lines, lines[1:], lines[2:]):
                if before[-1] in ".!?:" or not after[0].islower() or line[-1] in ".,;" + HYPHENS or before[-1] in HYPHENS:
                    continue
                ws = [w for w in WORD.findall(line) if len(w) >= 3 and not w.isdigit()]
                if 2 <= len(ws) <= 6 and all(w[0].isupper() for w in ws):
                    words.append(ws[0].lower())
        yield {"word": words}

    cut = durable(map_batches(scanned.select("text"), cut_in, "word string").groupBy("word").agg(F.count("*").alias("n")))
    total = cut.agg(F.sum("n")).first()[0] or 0
    return [r["word"] for r in cut.where(F.col("n") >= F.greatest(F.lit(2.0), F.lit(o.head_share * total))).orderBy(F.desc("n"), "word").collect()]


def _prepare(records: DataFrame, o: Scans):
    """The known words (all of them as a table, the most frequent by themselves) and the models."""
    digital = records.where("scanned = false and length(text) > 0")
    known = durable(spelling(digital).where(F.col("n") >= o.min_records))
    top = known.orderBy(F.desc("n"), "word").limit(o.known_words).collect()
    words = [r["word"] for r in top]
    df = np.array([r["n"] for r in top], dtype=float)
    texts = [r["text"] for r in digital.where(F.length("text") <= o.sample_chars).orderBy(F.xxhash64("id", F.lit(o.seed))).limit(o.sample_records).select("text").collect()]
    heads = title_heads(records.where("scanned and length(text) > 0"), o)
    return known, words, train(texts, words, df, o, heads)


def _without_known_parts(found: DataFrame, known: DataFrame) -> DataFrame:
    """Rows but those whose word falls, in one of its ``ways``, into parts that are all known, the rarer ones too."""
    parts = found.where("ways is not null").select("ways").distinct().select("ways", F.posexplode("ways").alias("way", "part"))
    parts = parts.select("ways", "way", F.explode("part").alias("word")).join(known.select("word", F.lit(1).alias("is")), "word", "left")
    gone = parts.groupBy("ways", "way").agg(F.bool_and(F.col("is").isNotNull()).alias("all")).where("all").select("ways").distinct()
    return found.join(gone, "ways", "left_anti").select(found.columns)


def _findings(records: DataFrame, o: Scans) -> tuple[DataFrame, DataFrame, dict]:
    """(id, no, defect, word, fix, at) rows and nothing else; words unknown with their verdicts; models."""
    known, words, models = _prepare(records, o)
    spark = records.sparkSession
    held = spark.sparkContext.broadcast((frozenset(words), models))  # o.known_words at most
    whole = len(words) < o.known_words  # no rarer words are left to join

    def read(cols):
        have, models = held.value
        out = {k: [] for k in ("id", "no", "defect", "word", "no2", "cut", "ways")}

        def add(*row):
            for k, v in zip(out, row):
                out[k].append(v)

        ids, texts = cols["id"].to_pylist(), cols["text"].to_pylist()
        pages = ((i, *p) for s, e in _blocks(texts) for i, p in zip(ids[s:e], read_pages(texts[s:e], models, o)))
        for i, nos, lines, furn, goes in pages:
            for n, line in enumerate(lines):
                if furn[n]:
                    add(i, nos[n], "furniture", None, None, None, None)
                elif goes[n] is not None:
                    add(i, nos[n], "hyphen", None, None, None, None)
            seen = set()
            for w, a, b, cut in words_of(lines, furn, goes):
                f = w.lower()
                if f in have or len(f) < 2:
                    continue
                ways = []
                if odd(w):
                    pass
                elif any(c.isdigit() for c in f) or not any(c.isalpha() for c in f):
                    continue
                else:
                    ways = [WORD.findall(f)] + ([[f[:cut], f[cut:]]] if a != b else [])
                    if any(all(p in have for p in x) for x in ways):
                        continue
                    ways = [] if whole else [x for x in ways if len(x) > 1]
                if (f, a, str(ways)) in seen:
                    continue
                seen.add((f, a, str(ways)))
                add(i, nos[a], "word", f, nos[b], cut, ways or None)
        yield out

    scanned = records.where("scanned and length(text) > 0").select("id", "text")
    found = map_batches(scanned, read, "id long, no int, defect string, word string, no2 int, cut int, ways array<array<string>>")
    found = durable(found if whole else _without_known_parts(durable(found), known)).drop("ways")
    unknown = durable(found.where("defect = 'word'").select("word").distinct().join(known.select("word"), "word", "left_anti"))

    def keyed(grams: Callable[[str], list[tuple]], carry: list[str]):
        def run(cols):
            words = cols["word"].to_pylist()
            got = [[hash_of(g) for g in grams(w)] for w in words]
            n = np.array([len(g) for g in got], dtype=np.int64)
            at = pa.array(np.repeat(np.arange(len(words)), n))
            yield {c: cols[c].take(at) for c in carry} | {"gram": np.array([h for g in got for h in g], dtype=np.int64)}

        return run

    ask = map_batches(unknown, keyed(grams_read, ["word"]), "word string, gram long")
    have = map_batches(known, keyed(grams_known, ["word", "n"]), "word string, n long, gram long").select(F.col("word").alias("known"), F.col("n").alias("df"), "gram")
    pairs = ask.join(have, "gram").where((F.abs(F.length("word") - F.length("known")) <= 2) & (F.levenshtein("word", "known", 3) >= 0)).select("word", "known", "df").distinct()
    pairs = pairs.withColumn("rivals", F.count("*").over(W.partitionBy("word")))

    def rank(cols):
        _, models = held.value
        w, k = cols["word"].to_pylist(), cols["known"].to_pylist()
        x = pair_features(w, k, cols["df"].to_numpy().astype(float), cols["rivals"].to_numpy().astype(float))
        yield {"word": w, "known": k, "score": models["replace"].predict(x)}

    scored = map_batches(pairs, rank, "word string, known string, score double")
    best = scored.groupBy("word").agg(F.max(F.struct("score", "known")).alias("b"), F.count("*").alias("rivals"))
    told = unknown.join(best, "word", "left").select("word", F.col("b.known").alias("fix"), F.coalesce("b.score", F.lit(0.0)).alias("score"), F.coalesce("rivals", F.lit(0)).alias("rivals"))

    def judge(cols):
        _, models = held.value
        w = cols["word"].to_pylist()
        x = word_features(w, cols["score"].to_numpy(), cols["rivals"].to_numpy().astype(float))
        yield {"word": w, "fix": cols["fix"], "score": cols["score"], "misread": models["misread"].predict(x)}

    verdict = map_batches(told, judge, "word string, fix string, score double, misread double").where(F.col("misread") >= o.misread)
    verdict = durable(verdict.select("word", F.when(F.col("score") >= o.replace, F.col("fix")).alias("fix")))
    return found.join(known.select("word"), "word", "left_anti"), verdict, models


def _char_rows(found: DataFrame, verdict: DataFrame) -> DataFrame:
    """(id, no, word, fix): misread words with the line that holds the misread place."""
    odd_place = F.regexp_instr("word", F.lit(r"[!|€$0-9]")) - 1
    token = found.where("defect = 'word'").join(verdict, "word")
    same = F.size(F.filter(F.sequence(F.lit(1), F.length("word")), lambda i: F.substr("word", F.lit(1), i) == F.substr("fix", F.lit(1), i)))
    place = F.when(F.col("fix").isNull(), odd_place).otherwise(same)
    return token.select("id", F.when(place >= F.col("cut"), F.col("no2")).otherwise(F.col("no")).alias("no"), "word", "fix")


def as_records(df: DataFrame, id_col: str, text_col: str, ocr_col: str, o: Scans) -> DataFrame:
    return df.select(df[id_col].cast("long").alias("id"), df[text_col].alias("text"), is_scanned(df[ocr_col], df[text_col], o).alias("scanned")).where("id is not null")


def scan_defects(df: DataFrame, id_col: str, text_col: str, ocr_col: str, options: Scans = Scans()) -> DataFrame:
    """(id, line_no, defect) of scanned records: 'hyphen', 'furniture', or 'char' (a misread word).

    A line may have both 'hyphen' and 'char'; furniture has nothing else.  Records whose flag is
    null count as scanned if they are set like it.  Null ids, null or empty texts give no row; with
    no born-digital record at all no word is known and no model trained, and nothing is found.
    """
    o = options
    found, verdict, _ = _findings(as_records(df, id_col, text_col, ocr_col, o), o)
    rows = found.where("defect <> 'word'").select("id", "no", "defect").union(_char_rows(found, verdict).select("id", "no", F.lit("char")))
    return rows.distinct().select("id", F.col("no").alias("line_no"), "defect")


def repaired(df: DataFrame, id_col: str, text_col: str, ocr_col: str, options: Scans = Scans()) -> DataFrame:
    """(id, text): every record's text; of scanned ones without furniture, divided words joined,
    misread words replaced, lines run together into paragraphs.  Others, and null texts, as they were."""
    o = options
    recs = as_records(df, id_col, text_col, ocr_col, o)
    found, verdict, models = _findings(recs, o)
    fixes = found.where("defect = 'word'").join(verdict.where("fix is not null"), "word").groupBy("id").agg(
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct("word", "fix")))).alias("fixes"))
    held = df.sparkSession.sparkContext.broadcast(models)

    def mend(cols):
        out = []
        for t, s, f in zip(cols["text"].to_pylist(), cols["scanned"].to_pylist(), cols["fixes"].to_pylist()):
            out.append(mended(t, dict(f or {}), held.value, o) if s and t else t)
        yield {"id": cols["id"], "text": out}

    return map_batches(recs.join(fixes, "id", "left").select("id", "text", "scanned", "fixes"), mend, "id long, text string")


def mended(text: str, fixes: dict[str, str], models: dict, o: Scans) -> str:
    nos, lines, furn, goes = next(read_pages([text], models, o))
    out: list[str] = []
    width = max((len(l.strip()) for l in lines), default=1)

    def fix(m: re.Match) -> str:
        w = m.group()
        r = fixes.get(w.lower())
        if r is None:
            return w
        return r.upper() if w.isupper() and len(w) > 1 else r.capitalize() if w[:1].isupper() or w[:1].isdigit() else r

    last = None
    for i, l in enumerate(lines):
        if furn[i]:
            continue
        s = l.strip().strip("\f")
        if last is None:
            out.append(s)
        elif goes[last] == i:
            keep = out[-1].rstrip()
            own = s[:1].isupper() or s[:1].isdigit()
            out[-1] = (keep if own else keep[:-1]) + s
        else:
            prev = lines[last].strip()
            gap = nos[i] - nos[last] > 1 and not furn[last + 1:i].any()
            ended = prev[-1:] in ".!?:" and (gap or len(prev) < 0.75 * width)
            if ended or gap and not s[:1].islower() or not s[:1].islower() and len(prev) < 0.6 * width and prev[-1:] not in ",;":
                out.append(s)
            else:
                out[-1] += " " + s
        last = i
    return "\n\n".join(re.sub(r"[^\W_]+(?:[!|][^\W_]+)*", fix, p) for p in out)
