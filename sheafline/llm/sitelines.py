"""Problem 5: lines repeated across the records of one source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import durable, own_names

#: The folder names that carry a label; the folder below one is the source.
LABEL_FOLDERS = ("positiv", "positive", "negativ", "negative")


def record_group(doc_group: Column, path: Column) -> Column:
    """A record's group: its own, trimmed and in lower case; else the folder below the label folder,
    or in a flat path the file name before ``__``.  Null only if path is null too or has no name."""
    own = F.nullif(F.lower(F.trim(doc_group)), F.lit(""))
    parts = F.split(path, "/")
    at = F.array_position(F.transform(parts, lambda p: F.lower(F.trim(p)).isin(*LABEL_FOLDERS)), True)
    n = F.size(parts)
    folder = F.when((at > 0) & (at + 1 < n), F.get(parts, at.cast("int"))).when((at == 0) & (n > 1), F.get(parts, n - 2))
    stem = F.regexp_replace(F.get(parts, n - 1), r"\.[^.]*$", "")
    flat = F.split(stem, "__")[0]
    return F.coalesce(own, F.nullif(F.lower(F.trim(F.coalesce(folder, flat))), F.lit("")))


def line_key(line: Column) -> Column:
    """The letters of a line in order, in lower case."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}]+", "")


def _keyed(df: DataFrame, id_col: str, text_col: str, group: Column, min_letters: int) -> DataFrame:
    """(id, grp, lines: array of (no, h)) with the lines long enough to count; written once, read twice."""
    d = df.select(df[id_col].alias("id"), group.alias("grp"), df[text_col].alias("text")).where("id is not null and grp is not null and text <> ''")
    keys = F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).cast("int").alias("no"), line_key(x).alias("k")))
    long = F.filter(keys, lambda x: F.length(x["k"]) >= min_letters)
    hashed = F.transform(long, lambda x: F.struct(x["no"].alias("no"), F.xxhash64(x["k"]).alias("h")))
    return durable(d.select("id", "grp", hashed.alias("lines")).where(F.size("lines") > 0))


def repeated_lines(df: DataFrame, id_col: str, text_col: str, group: Column, min_letters: int = 30,
                   min_records: int = 6, min_share: float = 0.0) -> DataFrame:
    """(id, line_no) of lines found in at least ``min_records`` records, and ``min_share`` of the records, of their group.

    Lines are what lies between line feeds, numbered from 1; two are the same if their letters
    are.  A line counts once a record.  Records with null id, text or group have no repeated
    lines; an empty table gives none.  Counting is a partial sum keyed by group and line, so a
    group with a third of all rows spreads over all tasks.
    """
    keyed = _keyed(df, id_col, text_col, group, min_letters)
    seen = keyed.select("grp", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    freq = seen.groupBy("grp", "h").agg(F.count("*").alias("n")).where(F.col("n") >= min_records)
    if min_share > 0:
        size = df.select(group.alias("grp")).groupBy("grp").agg(F.count("*").alias("all"))
        freq = freq.join(size, "grp").where(F.col("n") >= F.col("all") * min_share)
    rows = keyed.select("id", "grp", F.explode("lines").alias("l")).select("id", "grp", F.col("l.no").alias("line_no"), F.col("l.h").alias("h"))
    return rows.join(freq.select("grp", "h"), ["grp", "h"], "left_semi").select("id", "line_no")


def without_repeated_lines(df: DataFrame, id_col: str, text_col: str, group: Column, **options) -> DataFrame:
    """Every row of ``df`` as it was, its text rebuilt without the repeated lines.  Null texts stay null."""
    # The lines that stay are taken from the sequence of all, so a text of many lines costs no more than its length.
    drop = repeated_lines(df, id_col, text_col, group, **options).groupBy("id").agg(F.collect_set("line_no").alias("_drop"))
    joined = df.join(drop.withColumnRenamed("id", "_drop_id"), df[id_col] == F.col("_drop_id"), "left")
    lines = F.split(df[text_col], "\n")
    stay = F.array_except(F.sequence(F.lit(1), F.size(lines)), "_drop")
    kept = F.get(F.transform(F.array(lines), lambda l: F.array_join(F.transform(stay, lambda i: F.get(l, i - 1)), "\n")), F.lit(0))
    return joined.select(*[F.when(F.col("_drop").isNull(), df[c]).otherwise(kept).alias(c) if c == text_col else df[c] for c in df.columns])
