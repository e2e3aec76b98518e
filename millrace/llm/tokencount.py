"""Token counts by a two-tier lookup of pre-tokens, without any shuffle.

A byte-level BPE encodes each pre-token by itself, so the tokens of a text are the sum over its
pre-tokens. The first tier is a compact hash table of frequent pre-tokens and their lengths,
made once and broadcast; what it misses is encoded by the worker and kept in a bounded cache.
The first tier decides the time only, never a count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tokenizers
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BoundedCache, file_bytes, prepare

MODEL = public_tokenizers.path("byte_bpe_50k.json")
#: Rows of a partition that the frequent pre-tokens are taken from, and entries that it gives
#: at most; with 10 bytes for each slot, and two slots or more for an entry, 5 MB at most.
SAMPLE_ROWS, FREQUENT = 2000, 1 << 16
#: Entries of a worker's cache.
CACHE = 400_000

_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: The same split for ASCII texts, where the library's own classes are these.
_ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Separators that Python's ``\s`` has in ASCII mode or not, other than the pattern's own.
_ODD_SPACES = re.compile("[\x1c-\x1f\x85]")


class TokenLengths:
    """Lengths of pre-tokens and texts as the library for the file gives them."""

    def __init__(self, data: bytes):
        self.library = tokenizers.Tokenizer.from_str(data.decode())
        self.library.no_truncation()
        self.library.no_padding()
        added = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def encoded(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens of a text that holds no added token."""
        if text.isascii() and not _ODD_SPACES.search(text):
            return _ASCII_PATTERN.findall(text)
        return _PATTERN.findall(text)

    def parts(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how often it holds an added token, which counts as one."""
        if self.added is None or self.added.search(text) is None:
            return self.pretokens(text), 0
        pieces = self.added.split(text)
        return [p for piece in pieces for p in self.pretokens(piece)], len(pieces) - 1


class FrequentTable:
    """Open addressing on the XXH3 of a pre-token: an array of keys and one of lengths."""

    def __init__(self, lengths: dict[str, int]):
        size = 1 << max(4, (2 * max(1, len(lengths)) - 1).bit_length())
        self.keys, self.lengths = np.zeros(size, np.uint64), np.zeros(size, np.uint16)
        for text, length in lengths.items():
            if length < 1 << 16:
                at, key = self._slot(text)
                self.keys[at], self.lengths[at] = key, length

    def _slot(self, text: str) -> tuple[int, int]:
        key = xxhash.xxh3_64_intdigest(text) or 1
        at, last = key & (len(self.keys) - 1), len(self.keys) - 1
        while (there := int(self.keys[at])) and there != key:
            at = (at + 1) & last
        return at, key

    def get(self, text: str) -> int:
        """The length, or 0 for a pre-token that is not there."""
        return int(self.lengths[self._slot(text)[0]])


def frequent_table(df: DataFrame, text_col: str, data: Broadcast, sample_rows: int, limit: int) -> FrequentTable:
    """Lengths of the most frequent pre-tokens in the first rows of two partitions.

    Only those partitions are read; no more than twice ``limit`` entries reach the driver.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts, left = TokenLengths(data.value), Counter(), sample_rows
        for batch in batches:
            for value in batch.column(0).slice(0, left):
                counts.update(model.parts(value.as_py() or "")[0])
            left -= min(left, batch.num_rows)
            if not left:
                break
        best = [t for t, n in counts.most_common(limit) if n > 1]
        row = [pa.array([best], pa.list_(pa.string())), pa.array([[model.encoded(t) for t in best]], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(row, ["texts", "lengths"])

    found = df.select(F.col(text_col).alias("text")).mapInArrow(counted, "texts array<string>, lengths array<int>").take(2)
    return FrequentTable(dict(pair for r in found for pair in zip(r.texts, r.lengths, strict=True)))


_WORKER: dict[int, tuple[TokenLengths, BoundedCache]] = {}


def _worker(data: Broadcast, frequent: Broadcast) -> tuple[TokenLengths, BoundedCache]:
    key = hash(data.value)
    if key not in _WORKER:
        model = TokenLengths(data.value)
        _WORKER[key] = model, BoundedCache(None, CACHE)
    model, cache = _WORKER[key]
    table, encoded = frequent.value, model.encoded
    cache.compute = lambda text: table.get(text) or encoded(text)
    return model, cache


def token_count_column(df: DataFrame, text_col: str, model_path: str = MODEL, sample_rows: int = SAMPLE_ROWS, frequent: int = FREQUENT) -> Column:
    """Number of tokens of a text column. Null and empty texts have none."""
    prepare(df.sparkSession)
    data = file_bytes(df.sparkSession, model_path)
    first = df.sparkSession.sparkContext.broadcast(frequent_table(df, text_col, data, sample_rows, frequent))

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, cache = _worker(data, first)
        lookup = cache.__getitem__
        for texts in batches:
            found = []
            for value in texts:
                pretokens, added = model.parts(value.as_py() or "")
                found.append(sum(map(lookup, pretokens)) + added)
            yield pa.array(found, pa.int64())

    return count(F.col(text_col))


def token_counts(df: DataFrame, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row.

    A null text counts as empty: no bytes, no tokens. Equal ids and equal rows each keep their
    row, an empty table gives an empty result, and other columns, whatever their names, are
    left out.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tokens = token_count_column(rows, "text", model_path)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return rows.select("doc_id", size, tokens.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
