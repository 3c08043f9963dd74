"""URL expressions: RFC 3986 pieces by regular expression, so that odd URLs never fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: RFC 3986, appendix B: scheme, authority, path, query, fragment.
PIECES = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
#: Fixed value: a URL inside other text.
EMBEDDED = r"""https?://[^\s,;"'<>]+"""

# Endings that are never pages.
NON_PAGE_EXTENSIONS = (
    ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".odt", ".rtf",
    ".css", ".js", ".json", ".xml", ".rss", ".zip", ".gz", ".tar", ".rar",
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".bmp", ".ico", ".tiff",
    ".mp3", ".mp4", ".avi", ".mov", ".mkv", ".webm", ".wav", ".flac", ".ogg",
    ".woff", ".woff2", ".ttf", ".eot",
)

# Content types of documents.
CONTENT_TYPES = {
    "application/pdf": ".pdf",
    "application/msword": ".doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/vnd.ms-powerpoint": ".ppt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/vnd.oasis.opendocument.text": ".odt",
    "application/rtf": ".rtf",
    "text/rtf": ".rtf",
    "application/x-pdf": ".pdf",
}


def piece(url: Column, n: int) -> Column:
    return F.regexp_extract(url, PIECES, n)


def scheme(url: Column) -> Column:
    return F.lower(piece(url, 1))


def netloc(url: Column) -> Column:
    return piece(url, 2)


def path(url: Column) -> Column:
    """The path without ``;params`` of its last segment."""
    return F.regexp_replace(piece(url, 3), r";[^/]*$", "")


def hostname(url: Column) -> Column:
    """Lower-case host without user info and port; '' if there is none."""
    host = F.regexp_replace(netloc(url), r"^.*@", "")
    return F.lower(F.regexp_replace(host, r":\d*$", ""))


def hostname_or_unknown(url: Column) -> Column:
    return F.coalesce(F.nullif(hostname(url), F.lit("")), F.lit("unknown"))


def base_domain(host: Column) -> Column:
    """The last two labels in lower case; a single label stays."""
    labels = F.split(F.lower(host), r"\.")
    return F.when(F.size(labels) < 2, F.lower(host)).otherwise(F.array_join(F.slice(labels, -2, 2), "."))


def normalize_url(url: Column) -> Column:
    """Trimmed, scheme and authority in lower case, no trailing slashes (path '/' stays), no fragment."""
    u = F.trim(url)
    s, a, p, q = F.lower(piece(u, 1)), F.lower(piece(u, 2)), piece(u, 3), piece(u, 4)
    p = F.when(F.length(p) > 1, F.regexp_replace(p, "/+$", "")).otherwise(p)
    return F.concat(
        F.when(s != "", F.concat(s, F.lit(":"))).otherwise(""), F.when(a != "", F.concat(F.lit("//"), a)).otherwise(""),
        p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def is_url(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?i)^\s*https?://"), F.lit(False))


def embedded_url(text: Column) -> Column:
    """The first URL inside a text, or null."""
    return F.nullif(F.regexp_extract(text, f"({EMBEDDED})", 1), F.lit(""))


def extension(url: Column) -> Column:
    """Lower-case ending of the last path segment with its dot; '' if none."""
    return F.lower(F.regexp_extract(path(url), r"(\.[^./]*)$", 1))


def is_target(url: Column, extensions: tuple[str, ...]) -> Column:
    if not extensions:
        return F.lit(False)
    low = F.lower(path(url))
    out = F.lit(False)
    for e in extensions:
        out = out | low.endswith(e)
    return out


def content_type_extension(content_type: Column) -> Column:
    """Document ending for a Content-Type header; '' for any other."""
    pairs = [F.lit(x) for kv in CONTENT_TYPES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))), F.lit(""))


def same_site(url: Column, seed: Column) -> Column:
    return scheme(url).isin("http", "https") & (base_domain(hostname(url)) == base_domain(hostname(seed)))


def is_followable(url: Column, seed: Column) -> Column:
    return same_site(url, seed) & ~extension(url).isin(*NON_PAGE_EXTENSIONS)


def document_name(url: Column, content_extension: Column) -> Column:
    """File name of a document: the last segment, or stem, eight hash digits and the served type's ending."""
    last = F.element_at(F.split(path(url), "/"), -1)
    stem = F.coalesce(F.nullif(F.regexp_replace(last, r"\.[^.]*$", ""), F.lit("")), F.lit("document"))
    return F.when(content_extension == "", last).otherwise(F.concat(stem, F.lit("-"), F.substring(F.sha1(url), 1, 8), content_extension))


HTTP = ("http", "https")


def invalid_reason(url: Column) -> Column:
    """Why a URL can't be fetched, or null: only http and https with a host can."""
    u = F.trim(url)
    return F.when(F.coalesce(u, F.lit("")) == "", "empty").when(~scheme(u).isin(*HTTP), "scheme").when(hostname(u) == "", "host")


def _without_dots(path: Column) -> Column:
    """A path without its '.' and '..' segments (RFC 3986, 5.2.4)."""
    parts = F.split(path, "/")
    step = lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.lit(1), F.size(acc) - 1))).when(p == ".", acc).otherwise(F.concat(acc, F.array(p)))
    kept = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.lit(0), F.size(parts) - 1)), F.array(F.lit("")), step)
    last = F.element_at(parts, -1)
    return F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def url_join(base: Column, ref: Column) -> Column:
    """``ref`` seen from an http(s) ``base``, by the rules of RFC 3986 as expressions, empty queries and fragments dropped; null if either is."""
    r = F.trim(ref)
    query = lambda u: F.when(piece(u, 4) != "", F.concat(F.lit("?"), piece(u, 4))).otherwise("")
    mark = F.when(piece(r, 5) != "", F.concat(F.lit("#"), piece(r, 5))).otherwise("")
    own = lambda u: F.regexp_replace(u, "#.*$", "")
    root = F.concat(piece(base, 1), F.lit("://"), netloc(base))
    folder = F.coalesce(F.nullif(F.regexp_replace(piece(base, 3), "[^/]*$", ""), F.lit("")), F.lit("/"))
    p, q = piece(r, 3), query(own(r))
    return F.when(r.isNull() | base.isNull(), F.lit(None)).when(r == "", base).when(piece(r, 1) != "", r).when(
        r.startswith("//"), F.concat(piece(base, 1), F.lit(":"), r)).when(
        p == "", F.concat(root, piece(base, 3), F.when(q != "", q).otherwise(query(own(base))), mark)).otherwise(
        F.concat(root, _without_dots(F.when(p.startswith("/"), p).otherwise(F.concat(folder, p))), q, mark))
