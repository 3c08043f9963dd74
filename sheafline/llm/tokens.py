"""Tokenizers from public vocabulary files, one instance a Python worker."""

from __future__ import annotations

import base64
import os

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: Where the vocabulary is; every operator takes it as a parameter.
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-tokenisation pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_held: dict[str, tuple] = {}
_sent: set[tuple] = set()


def tokenizer(path: str = DEFAULT_VOCABULARY):
    """(encode, bytes of each token id): byte-level BPE from a rank file."""
    if path not in _held:
        import tiktoken

        here = path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))
        with open(here, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        enc = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int32)
        for token, rank in ranks.items():
            size[rank] = len(token)
        _held[path] = (enc, size)
    return _held[path]


def send_vocabulary(spark: SparkSession, path: str) -> None:
    """Give every executor the driver's vocabulary file, once an application."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _sent and os.path.exists(path):
        spark.sparkContext.addFile(path)
        _sent.add(key)


def encode(text: str, path: str = DEFAULT_VOCABULARY) -> np.ndarray:
    return np.array(tokenizer(path)[0].encode_ordinary(text), dtype=np.int32)


def byte_length(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def char_ends(text: str, ids: np.ndarray, path: str = DEFAULT_VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """For each token the number of whole characters up to its end, and whether it ends inside a character."""
    ends = np.cumsum(tokenizer(path)[1][ids], dtype=np.int64)
    if text.isascii():
        return ends, np.zeros(len(ends), dtype=bool)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    width = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
    cum = np.cumsum(width)
    whole = np.searchsorted(cum, ends, "right")
    inside = np.concatenate([[0], cum])[whole] != ends
    return whole, inside
