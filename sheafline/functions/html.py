"""HTML through the standard library's parser, in Arrow batches."""

from __future__ import annotations

import gzip
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose start closes an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ASSETS = {"img": ("src",), "source": ("src",), "video": ("src", "poster"), "audio": ("src",), "embed": ("src",), "iframe": ("src",), "object": ("data",), "link": ("href",)}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.title: str | None = None
        self.paragraphs: list[str] = []
        self.anchors: list[list] = []
        self.links: list[str] = []
        self.assets: list[str] = []
        self.open: list[list] = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS and "p" in self.stack:
            del self.stack[self.stack.index("p"):]
        a = dict(attrs)
        if tag == "a" and a.get("href") is not None:
            self.anchors.append([a["href"], ""])
            self.open.append(self.anchors[-1])
        elif tag == "link" and a.get("href") is not None:
            self.links.append(a["href"])
        for k in ASSETS.get(tag, ()):
            if a.get(k):
                self.assets.append(a[k])
        if tag not in VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            self.open.pop()
        if tag in self.stack:
            del self.stack[len(self.stack) - 1 - self.stack[::-1].index(tag):]

    def handle_data(self, data):
        top = self.stack[-1] if self.stack else ""
        if top in ("script", "style"):
            return
        if top == "title" and self.title is None:
            self.title = data.strip()
        if top == "p" and data.strip():
            self.paragraphs.append(data.strip())
        for a in self.open:
            a[1] += data


def parse(html: str | None) -> dict:
    page = _Page()
    try:
        page.feed(html or "")
        page.close()
    except (ValueError, AssertionError):
        pass
    return {
        "title": page.title or "", "text": "\n".join(page.paragraphs),
        "anchors": [{"href": h, "text": " ".join(t.split())} for h, t in page.anchors],
        "links": page.links, "assets": page.assets,
    }


STRINGS = T.ArrayType(T.StringType())
PAGE = T.StructType().add("title", "string").add("text", "string").add(
    "anchors", T.ArrayType(T.StructType().add("href", "string").add("text", "string"))).add("links", STRINGS).add("assets", STRINGS)


@F.pandas_udf(PAGE)
def _parsed(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(h) for h in html], columns=["title", "text", "anchors", "links", "assets"])


def parsed(html: Column) -> Column:
    """struct(title, text of paragraphs, anchors, links, assets); empty for null."""
    return _parsed(html)


def sitemap(body: bytes | None) -> tuple[list[str], bool]:
    """(locations, whether it is an index of sitemaps); gzip by its magic; anything unreadable is empty."""
    raw = body or b""
    if raw[:2] == b"\x1f\x8b":
        try:
            raw = gzip.decompress(raw)
        except (OSError, EOFError):
            return [], False
    text = raw.decode("utf-8", "replace")
    index = "<sitemapindex" in text[:5000].lower()
    locs = re.findall(r"<(?:[\w.-]+:)?loc\b[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:[\w.-]+:)?loc\s*>", text, re.S)
    return [x.replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">") for x in locs if x], index


@F.pandas_udf(T.StructType().add("locs", STRINGS).add("is_index", "boolean"))
def _sitemaps(body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([sitemap(b) for b in body], columns=["locs", "is_index"])


def sitemap_locations(body: Column) -> Column:
    """struct(locs, is_index) of a sitemap's bytes."""
    return _sitemaps(body)


def robots_sitemaps(text: Column) -> Column:
    """All sitemap addresses of a robots.txt."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?im)^\s*sitemap:[ \t]*(\S.*?)[ \t\r]*$"), F.lit(1))


def ready(spark: SparkSession) -> None:
    from ..session import ship

    ship(spark)
