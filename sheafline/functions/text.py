"""Text expressions: folding, keyword scores, hashes and numeric document features."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods see it.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TEXT_CAP = 400_000
MIN_TEXT = 200

# Terms of module descriptions; patterns of module codes and of credit terms.
MODULE_TERMS = (
    "modulnummer", "modulbezeichnung", "modulkennung", "modultitel",
    "lernergebnisse", "qualifikationsziele", "lernziele", "kompetenzen",
    "teilnahmevoraussetzung", "prüfungsleistung", "prüfungsform",
    "verwendbarkeit", "arbeitsaufwand", "workload", "lehrform", "lehrveranstaltung",
    "modulverantwortliche", "häufigkeit des angebots", "dauer des moduls",
)
MODULE_CODE = r"(?U)\b[A-ZÄÖÜ]{2,}[-_ ]?\d{2,}\b"
CREDIT_TERM = r"(?U)\b(?:ects|leistungspunkte|credits?)\b"


def fold(text: Column) -> Column:
    """Umlauts and sharp s spelled out, then lower case; '' for null."""
    out = F.coalesce(text, F.lit(""))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Ä", "ae"), ("Ö", "oe"), ("Ü", "ue")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.lower(out)


def keyword_score(url: Column, anchor: Column, *maps: dict[str, int]) -> Column:
    """Sum of the weights of all tokens found in the folded URL and anchor.

    The text is folded once and bound to a variable the optimizer does not unfold into every token.
    """
    raw = F.concat(F.coalesce(url, F.lit("")), F.lit(" ␟ "), F.coalesce(anchor, F.lit("")))
    weights = json.dumps([{"t": t, "w": w} for m in maps for t, w in m.items()])
    terms = F.from_json(F.lit(weights), "array<struct<t:string,w:int>>")  # folded to a constant
    score = lambda hay: F.aggregate(terms, F.lit(0), lambda a, x: a + F.when(hay.contains(x["t"]), x["w"]).otherwise(0))
    return F.get(F.transform(F.transform(F.array(raw), fold), score), F.lit(0))


def truncated(text: Column, cap: int = TEXT_CAP) -> Column:
    return F.substring(text, 1, cap) if cap else text


#: The same characters one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def collapsed(text: Column) -> Column:
    """White space runs to one blank, none outside: one pass over characters, then one over doubled blanks only."""
    return F.trim(F.regexp_replace(F.translate(text, SPACES, " " * len(SPACES)), " {2,}", " "))


def text_hash(text: Column) -> Column:
    """sha256 of the text in lower case with white space collapsed; '' for a null or empty text."""
    norm = collapsed(F.lower(text))
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.sha2(norm, 256))


def stripped_length(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", ""))


def numeric_features(text: Column, page_count: Column, text_length: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    low = F.lower(t)
    n = F.greatest(F.length(t), F.lit(1))
    hits = reduce(lambda a, b: a + b, [
        ((F.length(low) - F.length(F.replace(low, F.lit(k), F.lit("")))) / len(k)).cast("bigint") for k in MODULE_TERMS])
    codes = F.least(F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(f"({MODULE_CODE})"), F.lit(1)))), F.lit(500))
    return {
        "page_count": F.coalesce(page_count, F.lit(0)).cast("double"),
        "log_text_length": F.log1p(F.coalesce(text_length, F.length(t)).cast("double")),
        "ects_density": F.regexp_count(low, F.lit(CREDIT_TERM)) * 1000.0 / n,
        "module_term_density": hits * 1000.0 / n,
        "module_code_count": codes.cast("double"),
        "digit_ratio": F.regexp_count(t, F.lit(r"\p{Nd}")) / n,
    }
