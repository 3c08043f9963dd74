"""Word and character n-gram TF-IDF, scaling and assembly, as table operations and Spark ML vectors."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ship


@F.pandas_udf(T.StringType())
def _without_accents(s: pd.Series) -> pd.Series:
    def one(t):
        if t is None or t.isascii():
            return t
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return s.map(one)


def without_accents(text: Column) -> Column:
    return _without_accents(text)


def words(text: Column, accents: bool = False) -> Column:
    """Lower-case words of two letters or more."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(low if accents else without_accents(low), F.lit(r"(?U)(\b\w\w+\b)"), F.lit(1))


def word_terms(text: Column, accents: bool = False) -> Column:
    """Lower-case words of two letters or more, and pairs of neighbours."""
    own = words(text, accents)
    pairs = F.when(F.size(own) > 1, F.zip_with(F.slice(own, F.lit(1), F.size(own) - 1), F.slice(own, F.lit(2), F.size(own) - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    return F.concat(own, pairs)


def char_ngrams(text: str, low: int = 3, high: int = 5) -> list[str]:
    """Character n-grams within words padded by a space on each side; a shorter word counts once."""
    out = []
    for word in text.lower().split():
        w = f" {word} "
        for n in range(low, high + 1):
            out.append(w[:n])
            for i in range(1, len(w) - n + 1):
                out.append(w[i:i + n])
            if len(w) <= n:
                break
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def _char_terms(s: pd.Series) -> pd.Series:
    return s.map(lambda t: char_ngrams(t or ""))


def char_terms(text: Column) -> Column:
    return _char_terms(text)


@F.pandas_udf(T.ArrayType(T.StructType().add("term", "string").add("n", "long")))
def _char_counts(s: pd.Series) -> pd.Series:
    from collections import Counter

    return s.map(lambda t: [{"term": k, "n": v} for k, v in Counter(char_ngrams(t or "")).items()])


def term_counts(df: DataFrame, id_col: str, text_col: str, chars: bool = False, accents: bool = False) -> DataFrame:
    """(id, term, n): term counts of each document; characters are counted before they leave Python."""
    ship(df.sparkSession)
    if chars:
        return df.select(F.col(id_col).alias("id"), F.explode(_char_counts(F.col(text_col))).alias("t")).select("id", "t.term", "t.n")
    return df.select(F.col(id_col).alias("id"), F.explode(word_terms(F.col(text_col), accents)).alias("term")).groupBy("id", "term").agg(F.count("*").alias("n"))


def document_frequencies(counts: DataFrame, min_df: int = 2, most: int | None = 60_000) -> DataFrame:
    """(term, df, total): the most frequent terms of the corpus with at least ``min_df`` documents."""
    d = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("total")).where(F.col("df") >= min_df)
    return d.orderBy(F.desc("total"), "term").limit(most) if most else d


def tfidf(counts: DataFrame, vocabulary: DataFrame, n_docs: int, sublinear: bool = True) -> DataFrame:
    """(id, term, weight): tf (1 + ln) times smoothed idf (ln((1+n)/(1+df)) + 1), of unit length a document."""
    idf = F.log((1.0 + F.lit(n_docs)) / (1.0 + F.col("df"))) + 1.0
    tf = 1.0 + F.log(F.col("n").cast("double")) if sublinear else F.col("n").cast("double")
    w = counts.join(vocabulary.select("term", "df"), "term").select("id", "term", (tf * idf).alias("w"))
    norm = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("weight"))


class Tfidf:
    """Fitted TF-IDF of a column of term arrays as one sparse vector column."""

    def __init__(self, model: CountVectorizerModel, idf: list[float], sublinear: bool):
        self.model, self.idf, self.sublinear = model, idf, sublinear

    @classmethod
    def fit(cls, df: DataFrame, terms: str, min_df: int = 2, most: int | None = 60_000, sublinear: bool = True) -> Tfidf:
        model = CountVectorizer(inputCol=terms, outputCol="_tf", vocabSize=most or 2**31 - 1, minDF=float(min_df)).fit(df)
        size = max(1, len(model.vocabulary))
        n = df.count()
        from pyspark.ml.functions import vector_to_array  # noqa: F401
        from pyspark.ml.feature import IDF

        own = IDF(inputCol="_tf", outputCol="_idf").fit(model.transform(df))
        freq = own.docFreq
        import math

        idf = [math.log((1 + n) / (1 + int(d))) + 1 for d in freq][:size]
        return cls(model, idf, sublinear)

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        import numpy as np

        idf = df.sparkSession.sparkContext.broadcast(np.array(self.idf))
        sub = self.sublinear

        @F.udf(VectorUDT())
        def weigh(v):
            if v is None or not len(v.indices):
                return Vectors.sparse(v.size if v is not None else 1, [], [])
            x = (1 + np.log(v.values) if sub else v.values) * idf.value[v.indices]
            return Vectors.sparse(v.size, v.indices, x / np.sqrt((x * x).sum()))

        return self.model.transform(df).withColumn(out, weigh("_tf")).drop("_tf")


def scaled(df: DataFrame, columns: list[str], by: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.col(c) / F.lit(by[c]) for c in columns})


def scales(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Population standard deviation of each column, 1 where it is 0."""
    row = df.agg(*[F.stddev_pop(c).alias(c) for c in columns]).first()
    return {c: (row[c] or 1.0) for c in columns}


# ---- terms as hashes of 64 bits: of words and pairs, or of a word's character n-grams --------------------------

_known: dict[tuple, np.ndarray] = {}


def _hash(term: str) -> int:
    return int.from_bytes(blake2b(term.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _hashes(word: str, chars: bool) -> np.ndarray:
    """The hash of a word, or those of its n-grams; kept, as words recur."""
    own = _known.get((word, chars))
    if own is None:
        if len(_known) > 100_000:
            _known.clear()
        own = _known[word, chars] = np.array([_hash(x) for x in (char_ngrams(word) if chars else (word,))], dtype=np.int64)
    return own


def hashed_terms(value, chars: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and counts of the terms of a text (``char_terms``) or of a list of words (``word_terms``)."""
    if not chars:
        h = np.concatenate([_hashes(w, False) for w in value]) if value else np.zeros(0, np.int64)
        a, b = h[:-1].view(np.uint64), h[1:].view(np.uint64)
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return np.unique(np.concatenate([h, (x ^ (x >> np.uint64(30))).view(np.int64)]), return_counts=True)
    count = Counter((value or "").lower().split())
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = [_hashes(w, True) for w in count]
    term, at = np.unique(np.concatenate(own), return_inverse=True)
    return term, np.bincount(at, weights=np.repeat(list(count.values()), [len(x) for x in own])).astype(np.int64)


def term_statistics(df: DataFrame, kinds: dict[str, bool], part: str, parts: int) -> DataFrame:
    """(block, term, df_i, total_i): documents and occurrences of every term of each column, by part i of 0 to ``parts`` - 1.

    ``kinds`` tells for each column whether it is a text of character n-grams or a list of words.
    Counts are summed over many documents before they leave Python.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.array(b.column(part).to_pylist())
            for block, (name, chars) in enumerate(kinds.items()):
                for p in range(parts):
                    held, size = [], 0
                    rows = np.flatnonzero(at == p)
                    for n, row in enumerate(rows, 1):
                        held.append(hashed_terms(b.column(name)[int(row)].as_py(), chars))
                        size += len(held[-1][0])
                        if size > 1_000_000 or n == len(rows):
                            term, where = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
                            total = np.bincount(where, weights=np.concatenate([x[1] for x in held]), minlength=len(term)).astype(np.int64)
                            same = lambda v, k=len(term): np.full(k, v, dtype=np.int32)
                            yield pa.record_batch([pa.array(same(block)), pa.array(term), pa.array(same(p)), pa.array(np.bincount(where, minlength=len(term)).astype(np.int64)), pa.array(total)],
                                                  names=["block", "term", "part", "n", "total"])
                            held, size = [], 0

    found = df.select(part, *kinds).mapInArrow(run, "block int, term bigint, part int, n bigint, total bigint")
    of = lambda c, i: F.sum(F.when(F.col("part") == i, F.col(c)).otherwise(0))
    return found.groupBy("block", "term").agg(*[of("n", i).alias(f"df_{i}") for i in range(parts)], *[of("total", i).alias(f"total_{i}") for i in range(parts)])


def coded(value: Column, chars: bool, vocabulary) -> Column:
    """(i, n): places in the vocabulary (broadcast, sorted hashes) of the terms it holds, and their counts."""
    kind = T.StructType().add("i", T.ArrayType(T.IntegerType())).add("n", T.ArrayType(T.IntegerType()))

    @F.arrow_udf(kind)
    def code(v: pa.Array) -> pa.Array:
        known = vocabulary.value
        place, count, ends = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [0]
        for x in v:
            term, n = hashed_terms(x.as_py(), chars)
            at = np.minimum(np.searchsorted(known, term), max(0, len(known) - 1))
            hit = known[at] == term if len(known) else np.zeros(len(term), bool)
            place.append(at[hit].astype(np.int32))
            count.append(n[hit].astype(np.int32))
            ends.append(ends[-1] + int(hit.sum()))
        ends = pa.array(ends, pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, np.concatenate(place)), pa.ListArray.from_arrays(ends, np.concatenate(count))], names=["i", "n"])

    return code(value)


def weighed(blocks: list[str], numbers: Column, weights, sublinear: list[bool]) -> Column:
    """One sparse vector of the blocks (``coded``), each of unit length, and the numbers.

    ``weights`` (broadcast) holds of each block the inverse document frequency of every place of its
    vocabulary, 0 for a term that was not chosen.
    """
    @F.arrow_udf(VectorUDT())
    def vector(numbers: pa.Array, *codes: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(numbers), 500):
            own = numbers.slice(start, 500)
            rows, at = len(own), 0
            row, place, value = [], [], []
            for c, idf, sub in zip(codes, weights.value, sublinear):
                i, n = (x.slice(start, 500) for x in c.flatten())
                of = np.repeat(np.arange(rows), pc.list_value_length(i).to_numpy())
                i, n = i.flatten().to_numpy(), n.flatten().to_numpy().astype(float)
                w = idf[i]
                kept = w > 0
                of, i, x = of[kept], i[kept], (1 + np.log(n[kept]) if sub else n[kept]) * w[kept]
                norm = np.sqrt(np.bincount(of, weights=x * x, minlength=rows))
                row.append(of)
                place.append(at + i)
                value.append(x / norm[of])
                at += len(idf)
            last = own.flatten().to_numpy().reshape(rows, -1)
            size = at + last.shape[1]
            row.append(np.repeat(np.arange(rows), last.shape[1]))
            place.append(np.tile(np.arange(at, size), rows))
            value.append(last.ravel())
            row = np.concatenate(row)
            order = np.argsort(row, kind="stable")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x)[order].astype(kind))) for x, kind in ((place, np.int32), (value, np.float64))]
            out.append(pa.StructArray.from_arrays([pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, size, np.int32)), *lists], names=["type", "size", "indices", "values"]))
        return pa.concat_arrays(out) if out else pa.array([], to_arrow_type(VectorUDT.sqlType()))

    return vector(numbers, *blocks)
