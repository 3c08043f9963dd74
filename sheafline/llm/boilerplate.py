"""Problem 1: the main body of a page, without the site's furniture.

Pages come as text, without their links, so link density is drawn from the pages themselves.  A
first sweep counts in how many pages of a host, and of all hosts, each part of a block stands: the
parts of a row, a short line, the clauses of a sentence.  A recurring short part that stands in
runs of its like is a link label; one that stands before teasers heads a box; one that stands
alone among prose is a heading of the body; a recurring clause belongs to a notice.

Pass one decides blocks (lines) on their own by link density (the share of a block in labels and
recurring clauses), stop-word density and length.  Pass two gives ambiguous short blocks the label
of their nearest decided neighbours, a run of them going as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from . import vec
from .cluster import durable, map_batches, own_names, sent_if_small

BODY, FURNITURE, OPEN = 1, 0, -1


@dataclass(frozen=True)
class Pages:
    share: float = 0.005        # a part in this share of all pages (five at least) recurs everywhere
    own: float = 0.2            # one in this share of its host's pages (three at least) recurs on the host
    run: float = 0.45           # share of its pages on which a label stands in a run
    tease: float = 0.3          # share of its pages on which a box heading stands before a teaser
    dense: float = 0.6          # share of a sentence in recurring clauses that makes it a notice
    stops: float = 0.15         # stop words a word of running text
    long: int = 140             # characters from which a block is no ambiguous one
    box: int = 5                # blocks below a box heading that may all be teasers without a mark
    send: int = 200_000         # hosts with labels of their own sent to all tasks at most; more are joined

# Words that carry grammar, in five languages.
STOP_WORDS = frozenset("""
der die das den dem des ein eine einen einem einer und oder aber als auch wie in im an am auf aus bei mit nach von vom zu zum zur
für über unter zwischen durch ohne um ist sind war wird werden wurde kann können soll muss haben hat nicht nur sich es er sie wir
ihr ihre dass wenn weil
the a an and or but of to in on at by for from with as is are was were be been has have had will can not it its this that these
they their than which who what when how into after before about also more
le la les des du et ou un une dans pour par sur avec est sont que qui ne pas plus ce cette aux il elle nous vous
el los las una y que del con por para se su al lo como más es son
il lo gli di che non con per una sono della dei nel alla
""".split())
MARK = re.compile(r"^[+›»>▸►→]\s+")
ITEM = re.compile(r"^(?:[–•*-]|\d+[.)])\s")
TEASER = re.compile(r"(?:(?:…|\.\.\.)(?:\s\S+){0,2}|\[\w+\]|\(\d+ ?[kmg]b\))\s*$|^(?:[›»]\s|\d\d?\.\d\d?\.\d{4}\b|\d{4}-\d\d-\d\d\b)", re.I)
FIELD = re.compile(r"^[^\W\d][\w .\-/]{1,24}: \S")
NUMBERED = re.compile(r"^(?:§\s*\d|\d+(?:\.\d+)*\.?\s)\S*\s*\S")
CREDITS = re.compile(r"\d+ (?:LP|ECTS|CP|credits?)\b")
SENTENCES = re.compile(r"[^\W\d_)][.!?]\s+[^\W\d_][^.!?]*\s\S+[.!?]$")
SHORT, PROSE, ROW = 0, 1, 2

#: Signs between the parts of a row, of a path, and between clauses.
_ROW, _PATH, _CLAUSE, _DASH, _STOP = "|·•>»›/→", ">»›/→", ".!?;:,…()[]", "–-", ".!?:"


def _signs(signs: str) -> np.ndarray:
    table = np.zeros(0x10000, dtype=bool)
    table[[ord(c) for c in signs]] = True
    return table


_TABLES = {n: _signs(t) for n, t in (("row", _ROW), ("path", _PATH), ("clause", _CLAUSE), ("dash", _DASH), ("stop", _STOP), ("end", ".!?"), ("close", "….])"), ("lead", "›»"), ("digit", "0123456789"), ("space", "".join(chr(c) for c in range(0x3001) if chr(c).isspace())))}


def _hash(*words: str) -> np.ndarray:
    return np.sort(vec.Words(list(words), letters=True).hashes)


class Blocks:
    """The non-blank lines of a batch of pages and their parts, as flat arrays.

    A line is a row of parts, short (a few words, no sentence), or prose.  Parts are what stands
    between the signs of a row, a short line as a whole, or a clause of three words at least.
    """

    def __init__(self, texts: list[str]):
        self.raw = [t.split("\n") for t in texts]
        every = [l for r in self.raw for l in r]
        w = vec.Words(every, keep_text=True, letters=True)
        c = np.minimum(w.chars, 0xFFFF)
        n = len(c)
        space = _TABLES["space"][c]
        before, after = np.concatenate([[True], space[:-1]]), np.concatenate([space[1:], [True]])
        lone = before & after
        running = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int32)])
        sign = _TABLES["row"][c] & lone
        row, path = running(sign | space & (before | (c == 9))), running(_TABLES["path"][c] & lone)
        clause = running(_TABLES["clause"][c] | _TABLES["dash"][c] & lone)
        digits, colons = running(_TABLES["digit"][c]), running(c == 58)
        owner = running((c == 169) | (c == 41) & (np.concatenate([[0], c[:-1]]) == 99) & (np.concatenate([[0, 0], c[:-2]]) == 40) & after)
        dots = running((c == 0x2026) | (c == 46) & (np.concatenate([[0], c[:-1]]) == 46))
        solid = np.flatnonzero(~space)
        lo, hi = np.searchsorted(solid, w.base[:-1]), np.searchsorted(solid, w.base[1:] - 1)
        keep = np.flatnonzero(hi > lo)  # lines with something in them
        self.first, self.last = solid[lo[keep]], solid[hi[keep] - 1]
        count = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.page_of = np.repeat(np.arange(len(texts)), count)[keep]
        self.no = (np.arange(len(every)) - np.repeat(np.cumsum(count) - count, count))[keep]
        self.bounds = np.searchsorted(self.page_of, np.arange(len(texts) + 1))
        self.lines = [every[i].strip() for i in keep.tolist()]
        self.length = self.last - self.first + 1
        self.words, self.wfirst = np.diff(w.offsets)[keep], w.offsets[:-1][keep]
        self.hashes = w.hashes
        self.head, self.tail = c[self.first], c[self.last]
        ends = _TABLES["stop"][self.tail] | (_TABLES["stop"][c[np.maximum(self.last - 1, self.first)]] & ~vec._word_table()[w.chars[self.last]])
        # Breaks before words: between the parts of a row, or between clauses.
        line = np.repeat(np.arange(len(keep)), self.words)
        at = np.arange(len(line)) - np.repeat(np.cumsum(self.words) - self.words, self.words) + np.repeat(self.wfirst, self.words)
        begin, end = w.starts[at], w.ends[at]
        new = np.diff(line, prepend=-1) > 0
        gap = lambda cum: (cum[begin] - cum[np.concatenate([[0], end[:-1]])] > 0) & ~new
        rows = gap(row)
        has = self.words > 0
        self.kind = np.where(self.words <= 6, SHORT, PROSE)
        self.kind[ends & (self.words > 3)] = PROSE
        self.kind[line[rows]] = ROW
        starts = np.flatnonzero(new | np.where(self.kind[line] == ROW, rows, (self.kind[line] == PROSE) & gap(clause)))
        size = np.diff(np.append(starts, len(line)))
        self.p_line, self.p_words = line[starts], size
        stop = starts + size - 1
        self.p_letters = np.add.reduceat(end - begin, starts) if len(starts) else np.zeros(0, int)
        self.p_span = end[stop] - begin[starts]
        upto = np.where(np.append(self.p_line[1:], -1) == self.p_line, np.append(begin[starts][1:], 0), self.last[self.p_line] + 1)
        self.p_digits = digits[upto] - digits[begin[starts]] > 0
        self.p_key = vec.sequence_keys(w.hashes, at[starts], size)
        kept = (self.kind[self.p_line] != PROSE) | (size >= 3)
        for name in ("p_line", "p_words", "p_letters", "p_span", "p_digits", "p_key"):
            setattr(self, name, getattr(self, name)[kept])
        self.key = np.zeros(len(keep), dtype=np.uint64)  # of whole lines, but rows
        self.key[has] = vec.sequence_keys(w.hashes, self.wfirst[has], self.words[has])
        self.key[self.kind == ROW] = 0
        self.letters = self._sum(line, end - begin)
        self.stops = self._sum(line, vec.among(w.hashes[at], _STOPS))
        over = lambda cum: cum[self.last + 1] - cum[self.first] > 0
        self.colon, self.path = over(colons), over(path)
        self.owner = over(owner)
        self.owner[line[w.hashes[at] == _COPYRIGHT]] = True
        near = dots[self.last + 1] - dots[np.maximum(self.first, self.last - 40)] > 0
        self.tease = np.zeros(len(keep), dtype=bool)
        sign = lambda by, code: c[np.minimum(self.first + by, n - 1)] == code
        dated = _TABLES["digit"][self.head] & (sign(1, 46) | sign(2, 46) | sign(4, 45))
        for i in np.flatnonzero(near | _TABLES["close"][self.tail] | dated | _TABLES["lead"][self.head]).tolist():
            self.tease[i] = TEASER.search(self.lines[i]) is not None

    def _sum(self, line: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.bincount(line, x, len(self.kind)).astype(np.int64)

    def near(self, x: np.ndarray, by: int) -> np.ndarray:
        """``x`` of the line ``by`` lines on, False beyond the page."""
        n = len(x)
        to = np.arange(n) + by
        ok = (to >= 0) & (to < n)
        to = np.clip(to, 0, max(n - 1, 0))
        return x[to] & ok & (self.page_of[to] == self.page_of)

    def observed(self) -> tuple[np.ndarray, ...]:
        """(page, key, seen, words) of every part and every whole sentence; seen: 1 in a run, 2 before a teaser."""
        row, short = self.kind == ROW, self.kind == SHORT
        beside = self.near(row, -1) | self.near(row, 1)
        crowd = sum(self.near(short, d).astype(int) for d in (-2, -1, 1, 2)) >= 2
        seen = (row | short & (beside | crowd)) + 2 * self.near(self.tease, 1)
        whole = np.flatnonzero((self.kind == PROSE) & (self.words > 0))
        line = np.concatenate([self.p_line, whole])
        words = np.concatenate([self.p_words, self.words[whole]])
        return self.page_of[line], np.concatenate([self.p_key, self.key[whole]]), seen[line], np.minimum(words, 100)


_STOPS, _COPYRIGHT = _hash(*STOP_WORDS), _hash("copyright")[0]


def key_of(part: str) -> int:
    """The key of a part by itself."""
    w = vec.Words([part], letters=True)
    return int(vec.sequence_keys(w.hashes, np.array([0]), np.array([len(w.hashes)]))[0])


class Know:
    """What all pages say of a part, by key; what those of one host say, by key mixed with the host."""

    def __init__(self, labels=(), boxes=(), heads=(), phrases=(), host_labels=(), host_phrases=()):
        table = lambda x: np.unique(np.array(list(x), dtype=np.uint64))
        self.labels, self.boxes, self.heads, self.phrases = table(labels), table(boxes), table(heads), table(phrases)
        self.host_labels, self.host_phrases = table(host_labels), table(host_phrases)

    def with_hosts(self, labels: np.ndarray, phrases: np.ndarray) -> Know:
        out = Know()
        out.__dict__.update(self.__dict__, host_labels=np.unique(labels), host_phrases=np.unique(phrases))
        return out

    def label(self, key: np.ndarray, host: np.ndarray) -> np.ndarray:
        return vec.among(key, self.labels) | vec.among(vec.mix(key ^ host), self.host_labels)

    def phrase(self, key: np.ndarray, host: np.ndarray) -> np.ndarray:
        return vec.among(key, self.phrases) | vec.among(vec.mix(key ^ host), self.host_phrases)


NOTHING = Know()


def _slug(s: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", s.lower()).strip("-")


def title_of(lines: list[str], paths: list[bool], url: str | None) -> int:
    """The line whose words make the URL's last part, the page's heading; -1 if there is none."""
    last = _slug((url or "").split("?")[0].split("#")[0].rstrip("/").rsplit("/", 1)[-1])
    last = re.sub(r"-?[0-9a-f]{5,12}$", "", last)
    if len(last) < 8:
        return -1
    lead = last[:7]
    for i, (s, path) in enumerate(zip(lines, paths)):
        if len(s) >= 8 and not path and _slug(s[:14])[:7] == lead:
            g = _slug(s)
            if g and (g.startswith(last) or last.startswith(g)):
                return i
    return -1


def _joined(b: Blocks, know: Know, host: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Those of the ``open_`` lines whose words are nothing but labels set one after another."""
    out = np.zeros(len(b.kind), dtype=bool)
    rest = np.flatnonzero(open_ & (b.words >= 2) & (b.words <= 40))
    may = np.zeros(len(rest), dtype=bool)
    for m in range(1, 8):
        at = np.flatnonzero(b.words[rest] >= m)
        may[at[know.label(vec.sequence_keys(b.hashes, b.wfirst[rest[at]], np.full(len(at), m)), host[rest[at]])]] = True
    rest = rest[may]
    n = b.words[rest]
    bound = np.concatenate([[0], np.cumsum(n)])
    word = np.arange(bound[-1]) - np.repeat(bound[:-1], n)
    longest = np.zeros(bound[-1], dtype=np.int64)  # words of the longest label that begins at each word
    for m in range(1, 8):
        at = np.flatnonzero(word + m <= np.repeat(n, n))
        keys = vec.sequence_keys(b.hashes, (word + np.repeat(b.wfirst[rest], n))[at], np.full(len(at), m))
        longest[at[know.label(keys, np.repeat(host[rest], n)[at])]] = m
    step = longest.tolist()
    for k, i in enumerate(rest.tolist()):
        j, end = int(bound[k]), int(bound[k + 1])
        while j < end and step[j]:
            j += step[j]
        out[i] = j == end
    return out


def first_pass(b: Blocks, know: Know, host: np.ndarray, o: Pages) -> np.ndarray:
    """Label of each block by itself: body, furniture, or open (short and undecided)."""
    n = len(b.kind)
    label = np.full(n, OPEN)
    row, short, prose = b.kind == ROW, b.kind == SHORT, b.kind == PROSE
    p_label = know.label(b.p_key, host[b.p_line])
    labels, parts = b._sum(b.p_line, p_label), b._sum(b.p_line, np.ones(len(p_label)))
    speak = b._sum(b.p_line, b.p_digits | (b.p_words > 4))
    widest = np.zeros(n, dtype=np.int64)
    np.maximum.at(widest, b.p_line, b.p_span)
    recurring = b._sum(b.p_line, b.p_letters * know.phrase(b.p_key, host[b.p_line]))
    furniture = b.owner & (b.length < 200)
    furniture |= row & ((b.path & (labels > 0)) | ((labels * 2 >= parts) & ~(speak * 2 > parts)) | ((parts >= 5) & (speak == 0) & (widest <= 32)))
    furniture |= short & (labels > 0)
    furniture |= ~row & know.phrase(b.key, host) | prose & (recurring > o.dense * b.letters)
    furniture |= _joined(b, know, host, ~furniture)
    body = (b.length >= 60) & (b.stops >= o.stops * b.words) & (b.words > 0) | (b.words >= 5) & _TABLES["end"][b.tail] & (b.stops > 0) | (b.length >= o.long)
    for i in np.flatnonzero(~body & b.colon & (b.length <= 60)).tolist():
        body[i] = FIELD.match(b.lines[i]) is not None
    for i in np.flatnonzero(~body & (b.words >= 3) & (_TABLES["digit"][b.head] | (b.head == 167))).tolist():
        body[i] = NUMBERED.match(b.lines[i]) is not None
    label[body] = BODY
    label[short & vec.among(b.key, know.heads)] = BODY
    label[furniture] = FURNITURE
    return label


def label_batch(texts: list[str], page_urls: list, know: Know, host: np.ndarray, o: Pages) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each page (line numbers from 0 of its non-blank lines, their labels: 1 main body, 0 furniture)."""
    b = Blocks(texts)
    hosts = host[b.page_of]
    label = first_pass(b, know, hosts, o)
    in_box, is_label, is_head = (vec.among(b.key, know.boxes) & (b.kind == SHORT)), (b.kind == SHORT) & know.label(b.key, hosts), vec.among(b.key, know.heads)
    for p, url in enumerate(page_urls):
        s, e = b.bounds[p], b.bounds[p + 1]
        lines = b.lines[s:e]
        title = title_of(lines, b.path[s:e].tolist(), url)
        own = label[s:e].tolist()
        if title >= 0:
            own = [BODY if l == lines[title] else x for l, x in zip(lines, own)]
        page = Page(lines, lines[title] if title >= 0 else "", b.kind[s:e].tolist(), b.tease[s:e].tolist(), in_box[s:e].tolist(), is_label[s:e].tolist(), is_head[s:e].tolist())
        if any(page.boxes):
            _boxes(page, own, o)
        yield b.no[s:e], np.array(second_pass(page, own), dtype=np.int8)


@dataclass
class Page:
    """Of each non-blank line of a page."""

    lines: list[str]
    title: str
    kind: list[int]
    tease: list[bool]
    boxes: list[bool]
    labels: list[bool]
    heads: list[bool]


def label_blocks(text: str, url: str | None = None, know: Know = NOTHING, o: Pages = Pages()) -> list:
    """A label for each line of a page: 1 main body, 0 furniture, None for a blank line."""
    out: list = [None] * (text.count("\n") + 1)
    for no, label in label_batch([text], [url], know, np.zeros(1, dtype=np.uint64), o):
        for i, x in zip(no.tolist(), label.tolist()):
            out[i] = x
    return out


def _boxes(page: Page, label: list[int], o: Pages) -> None:
    """Mark box headings and the teasers below them as furniture."""
    lines, tease, n = page.lines, page.tease, len(label)

    def column(j: int) -> bool:
        return 0 <= j < n and label[j] == FURNITURE and page.labels[j] and not page.boxes[j]

    def heads(i: int) -> bool:
        return page.boxes[i] and not MARK.match(lines[i]) and (not page.labels[i] or not (column(i - 1) or column(i + 1)))

    def speaks(j: int) -> bool:
        """What no teaser looks like: a list item, a word or two, a field, credits, two sentences."""
        s = lines[j]
        if s == page.title or page.heads[j] or ITEM.match(s) and not tease[j]:
            return True
        if tease[j]:
            return False
        return len(s.split()) <= 2 or bool(CREDITS.search(s) or SENTENCES.search(s) or FIELD.match(s) and len(s) < 40)

    box = [heads(i) for i in range(n)]
    for i in range(n):
        if not box[i]:
            continue
        label[i] = FURNITURE
        end = i + 1
        while end < n and not box[end] and not (label[end] == FURNITURE and not tease[end]) and not speaks(end):
            end += 1
        marked = [j for j in range(i + 1, end) if tease[j]]
        closed = end == n or box[end] or label[end] == FURNITURE
        if closed and end - i - 1 <= o.box:  # nothing else up to the next furniture
            reach = end
        else:  # the body goes on below: the box reaches to the last teaser of its first stretch, two blocks at least
            reach = i + 3
            for j in marked:
                if j <= reach + 3:
                    reach = max(reach, j + 1)
        for j in range(i + 1, min(reach, end)):
            label[j] = FURNITURE


def second_pass(page: Page, label: list[int]) -> list[int]:
    """Ambiguous blocks by their nearest decided neighbours."""
    lines, kind, n = page.lines, page.kind, len(label)
    out = list(label)
    for i in range(1, n - 1):  # one sentence between a notice and its buttons goes with them
        if label[i] == BODY and label[i - 1] == FURNITURE == label[i + 1] and kind[i] == PROSE == kind[i - 1] and len(lines[i]) < 100 \
                and lines[i] != page.title and not page.tease[i - 1] and not page.boxes[i + 1] and not any(c in ".!?;:,…()[]" for c in lines[i][:-1]):
            out[i] = FURNITURE
    if OPEN not in label:
        return out
    before, after, last = [None] * n, [None] * n, None
    for i in range(n):
        before[i], last = last, i if label[i] != OPEN else last
    last = None
    for i in range(n - 1, -1, -1):
        after[i], last = last, i if label[i] != OPEN else last
    for i in range(n):
        if label[i] != OPEN:
            continue
        p, q, s = before[i], after[i], lines[i]
        if ITEM.match(s):
            out[i] = BODY
        elif MARK.match(s):
            out[i] = FURNITURE
        elif p is None and q is None:
            out[i] = FURNITURE if kind[i] == SHORT else BODY
        elif p is None:  # the edge of a page is furniture: so is a column of short blocks before all else
            out[i] = FURNITURE if q >= 3 and all(kind[j] == SHORT for j in range(q)) else label[q]
        elif q is None:
            out[i] = label[p]
        elif label[p] == label[q]:
            out[i] = label[p]
        else:  # a run goes with what leads into it; one block alone before the body is its heading
            alone = q - p == 2 and label[q] == BODY
            out[i] = BODY if alone and not ((kind[p] == ROW or page.labels[p]) and len(s.split()) <= 2) else label[p]
    return out


# ---- over tables -------------------------------------------------------------------------------------

def _pages(df: DataFrame, id_col: str, text_col: str, url_col: str) -> DataFrame:
    d = own_names(df, id=id_col, text=text_col, url=url_col).where("id is not null").withColumn("id", F.col("id").cast("long"))
    return d.withColumn("host", F.xxhash64(F.coalesce(urls.hostname(F.col("url")), F.lit(""))))


def learned(pages: DataFrame, o: Pages) -> tuple[Know, DataFrame]:
    """What all pages say, and (host, labels, phrases) of the hosts that say more.

    A page fetched again, under any spelling of its URL, counts once.  The parts that recur
    everywhere are bounded by the mean number of parts a page divided by ``share``, those of a host
    likewise by ``own``, however many pages there are.
    """

    def sweep(cols) -> Iterator[dict]:
        host, page, texts = cols["host"].to_numpy(), cols["page"].to_numpy(), cols["text"].to_pylist()
        for s, e in vec.chunks(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))):
            at, key, seen, words = Blocks(texts[s:e]).observed()
            yield {"host": host[s:e][at], "page": page[s:e][at], "key": vec.signed(key), "seen": seen.astype(np.int8), "words": words.astype(np.int8)}

    page = F.coalesce(F.xxhash64(urls.normalize_url(F.col("url"))), F.xxhash64("id"))
    rows = map_batches(pages.where("length(text) > 0").select("host", page.alias("page"), "text"), sweep, "host long, page long, key long, seen tinyint, words tinyint")
    once = rows.groupBy("host", "key", "page").agg(F.bit_or("seen").alias("seen"), F.max("words").alias("words"))
    by_host = durable(once.groupBy("host", "key").agg(
        F.count("*").alias("n"), F.sum(F.col("seen").bitwiseAND(1)).alias("run"), F.sum(F.shiftright("seen", 1)).alias("tease"), F.max("words").alias("words")))
    sizes = durable(pages.where("length(text) > 0").select("host", page.alias("page")).distinct().groupBy("host").agg(F.count("*").alias("pages")))
    total = sizes.agg(F.sum("pages")).first()[0] or 0
    everywhere = by_host.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", "run", "tease")], F.max("words").alias("words")).where(
        F.col("n") >= max(5.0, o.share * total)).collect()
    labels, boxes, heads, phrases = [], [], [], []
    for r in everywhere:
        run, tease = r["run"] / r["n"], r["tease"] / r["n"]
        if r["words"] <= 6 and tease >= o.tease:
            boxes.append(r["key"])
        if r["words"] <= 6 and run >= o.run and tease < 0.8:
            labels.append(r["key"])
        elif r["words"] <= 6 and tease < o.tease:
            heads.append(r["key"])
        if r["words"] >= 3 and run < o.run:
            phrases.append(r["key"])
    often = by_host.where("n >= 3").join(sizes, "host").where(F.col("n") >= o.own * F.col("pages"))
    run = F.col("run") >= o.run * F.col("n")
    own = often.groupBy("host").agg(
        F.collect_list(F.when((F.col("words") <= 6) & run & (F.col("tease") < 0.8 * F.col("n")), F.col("key"))).alias("labels"),
        F.collect_list(F.when((F.col("words") >= 3) & ~run, F.col("key"))).alias("phrases"))
    return Know(*(np.array(x, dtype=np.int64).view(np.uint64) for x in (labels, boxes, heads, phrases))), durable(own)


def _labelled(df: DataFrame, id_col: str, text_col: str, url_col: str, o: Pages) -> tuple[DataFrame, object]:
    pages = _pages(df, id_col, text_col, url_col)
    know, own = learned(pages, o)
    joined = pages.join(sent_if_small(own, o.send), "host", "left").select("id", "text", "url", "host", "labels", "phrases")
    held = df.sparkSession.sparkContext.broadcast(know)  # bounded by mean parts / share

    def labels(cols) -> Iterator[tuple]:
        """(position in the batch, line numbers, labels) of each page with a text."""
        texts, page_urls = cols["text"].to_pylist(), cols["url"].to_pylist()
        host = cols["host"].to_numpy().view(np.uint64)
        full = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
        _, one = np.unique(host, return_index=True)

        def of_hosts(name):
            got = [(host[i], v) for i in one.tolist() for v in (cols[name][i].as_py() or ())]
            return vec.mix(np.array([k for _, k in got], dtype=np.int64).view(np.uint64) ^ np.array([h for h, _ in got], dtype=np.uint64))

        know = held.value.with_hosts(of_hosts("labels"), of_hosts("phrases"))
        for s, e in vec.chunks(np.array([len(texts[i]) for i in full], dtype=np.int64)):
            some = full[s:e]
            for i, (no, got) in zip(some.tolist(), label_batch([texts[i] for i in some], [page_urls[i] for i in some], know, host[some], o)):
                yield i, no, got

    return joined, labels


def furniture_lines(df: DataFrame, id_col: str, text_col: str, url_col: str, options: Pages = Pages()) -> DataFrame:
    """(id, line_no) of the non-blank lines outside the main body, lines counted from 1.

    Null ids, and null or empty texts, give no row; pages with a null url count as of one unnamed
    host and have no hint to their heading.  Repeated rows give repeated results.
    """
    joined, labels = _labelled(df, id_col, text_col, url_col, options)

    def run(cols) -> Iterator[dict]:
        ids, out, nos = cols["id"].to_numpy(), [], []
        for i, no, got in labels(cols):
            at = no[got == FURNITURE] + 1
            out.append(np.full(len(at), ids[i], dtype=np.int64))
            nos.append(at)
        yield {"id": np.concatenate(out), "line_no": np.concatenate(nos).astype(np.int32)}

    return map_batches(joined.where("length(text) > 0"), run, "id long, line_no int")


def main_bodies(df: DataFrame, id_col: str, text_col: str, url_col: str, options: Pages = Pages()) -> DataFrame:
    """(id, body): the main body of each page; '' if it has none, null for a null text."""
    joined, labels = _labelled(df, id_col, text_col, url_col, options)

    def run(cols) -> Iterator[dict]:
        texts = cols["text"].to_pylist()
        body = [None if t is None else "" for t in texts]
        for i, no, got in labels(cols):
            lines = texts[i].split("\n")
            body[i] = "\n".join(lines[k] for k in no[got == BODY].tolist())
        yield {"id": cols["id"], "body": body}

    return map_batches(joined, run, "id long, body string")
