"""Removal of long passages that an earlier document holds, by difference-cover anchors.

A difference cover ``D`` of a period ``v`` has, for any two positions, an offset below ``v`` that
takes both into ``D`` modulo ``v``. So two equal passages of ``window`` words share an anchor of
``window - v + 1`` words at aligned cover positions, and only the few positions of the cover
have to be hashed and shuffled. Anchors that occur in two different texts are extended: every
window around them is hashed, each hash keeps the smallest document it starts in, and the
windows of all later documents are covered.

Equal whole texts are told apart from their first document by a digest alone. Texts travel
compressed, and nothing is gathered beyond one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, compress
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import prepare, released, staged

WINDOW = 50
#: Periods whose covers are perfect difference sets: every offset occurs exactly once.
_PERIODS = (31, 21, 13, 7, 3)
#: Odd bases of the two rolling hashes, modulo 2 ** 64.
_BASES = (0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93)


@cache
def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """Period and cover for a window: the longest period of at most two thirds of it."""
    for period in _PERIODS:
        if period <= max(1, 2 * window // 3):
            size = next(n for n in range(2, period) if n * (n - 1) + 1 == period)
            for rest in combinations(range(1, period), size - 1):
                found = (0, *rest)
                if len({(a - b) % period for a in found for b in found}) == period:
                    return period, found
    return 1, (0,)


@cache
def _powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(length, b, np.uint64))]) for b in (base, inverse))


def rolling(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each run of ``length`` words, from the words' own hashes."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, 1 << max(10, len(hashes).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down[: len(hashes)])])
    return (sums[length:] - sums[:-length]) * up[: len(sums) - length]


def word_list(text: str | None) -> list[bytes]:
    # bytes.split() cuts at exactly the six ASCII separators
    return text.encode().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def covered(length: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``length`` words lie in a window that begins at one of ``starts``."""
    steps = np.zeros(length + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + window, length), -1)
    return np.cumsum(steps[:-1]) > 0


def _key(words: list[bytes]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).astype(np.int64))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            yield doc_id.as_py(), word_list(text.as_py())


class _Rows:
    """Columns of many small arrays, given out in batches of a bounded size."""

    def __init__(self, names: list[str], limit: int = 1 << 16):
        self.names, self.limit, self.size, self.parts = names, limit, 0, []

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size >= self.limit:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            arrays = [pa.array(np.concatenate(c)) for c in zip(*self.parts, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, self.names)
        self.size, self.parts = 0, []


def _same(value: int, like: np.ndarray) -> np.ndarray:
    return np.full(len(like), value, np.int64)


def _packed_column(window: int) -> Column:
    """``key, words, packed`` of a text: a digest of its words, their number, the text compressed."""

    @F.arrow_udf("struct<key: bigint, words: bigint, packed: binary>")
    @released
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        packer = zstandard.ZstdCompressor(level=1)
        for texts in batches:
            keys, counts, packed = [], [], []
            for value in texts:
                text = value.as_py()
                words = word_list(text)
                keys.append(_key(words))
                counts.append(len(words))
                packed.append(None if text is None else packer.compress(text.encode()))
            yield pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())], ["key", "words", "packed"])

    return pack


def _unpack(packed: bytes | None) -> str | None:
    return None if packed is None else zstandard.decompress(packed).decode()


def repeats(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, whole, starts`` of documents with words to remove.

    ``key`` is the digest of the text, ``starts`` the positions of covered windows; ``whole`` texts
    equal that of a smaller id, and are at least as long as a window.
    """
    prepare(df.sparkSession)
    period, residues = cover(window)
    size = window - period + 1
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, out = np.zeros(period, bool), _Rows(["hash", "key", "at"])
        chosen[list(residues)] = True
        for _, words in _texts(batches):
            if len(words) >= window:
                hashes = rolling(word_hashes(words), size, _BASES[0])
                at = np.nonzero(chosen[np.arange(len(hashes)) % period])[0]
                yield from out.add(hashes[at].view(np.int64), _same(_key(words), at), at.astype(np.int32))
        yield from out.rest()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [word_list(t.as_py()) for t in batch.column(1)]
            long_ = pa.array([len(t) >= window for t in texts])
            found = pa.RecordBatch.from_arrays([batch.column(0), pa.array([_key(t) for t in texts], pa.int64())], ["doc_id", "key"])
            yield found.filter(long_)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(["h1", "h2", "doc_id", "key", "at"])
        for batch in batches:
            for doc_id, key, packed, anchor in zip(*batch.columns, strict=True):
                words = word_list(_unpack(packed.as_py()))
                last = len(words) - window
                ends = np.asarray(anchor.values)
                near = covered(len(words), np.maximum(ends - period + 1, 0), 1)
                for back in range(period - 1):
                    near[np.maximum(ends - back, 0)] = True
                at = np.nonzero(near[: last + 1])[0]
                hashes = word_hashes(words)
                first, second = (rolling(hashes, window, b)[at] for b in _BASES)
                yield from out.add(first.view(np.int64), (second >> np.uint64(32)).astype(np.uint32).view(np.int32), _same(doc_id.as_py(), at), _same(key.as_py(), at), at.astype(np.int32))
        yield from out.rest()

    # equal texts: only the one of the smallest id is looked into
    texts = staged(rows.mapInArrow(released(named), "doc_id long, key long"), "texts")
    first = texts.groupBy("key").agg(F.min("doc_id").alias("first"))
    texts = texts.distinct().join(first, "key")
    # anchors in two texts, and where they are
    found = rows.mapInArrow(released(anchors), "hash long, key long, at int")
    shared = found.groupBy("hash").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    shared = staged(shared.where("low <> high").select("hash"), "anchors")
    spots = found.join(shared, "hash", "left_semi").groupBy("key").agg(F.collect_set("at").alias("at"))
    spots = spots.join(texts.where("doc_id = first"), "key").select("doc_id", "key", "at")
    # extended to whole windows
    packed = rows.select("doc_id", _packed_column(window)("text").alias("p")).select("doc_id", "p.key", "p.packed")
    seeds = packed.join(spots, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select("doc_id", "key", "packed", "at")
    extended = staged(seeds.mapInArrow(released(windows), "h1 long, h2 int, doc_id long, key long, at int"), "windows")
    earliest = extended.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    late = extended.join(earliest.drop("high"), ["h1", "h2"]).where("doc_id > low")
    late = late.groupBy("doc_id", "key").agg(F.collect_set("at").alias("starts")).withColumn("whole", F.lit(False))
    copies = texts.where("doc_id > first").select("doc_id", "key", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts"))
    return late.select("doc_id", "key", "whole", "starts").unionByName(copies)


def _kept(text: str | None, whole: bool | None, starts: np.ndarray | None, window: int) -> tuple[list[bytes], list[bytes]]:
    words = word_list(text)
    if whole:
        return words, []
    if starts is None:
        return words, words
    return words, list(compress(words, ~covered(len(words), starts, window)))


def _joined(df: DataFrame, other: list[Column], window: int, id_col: str, text_col: str) -> DataFrame:
    """The other columns of each row in one struct, its compressed text, and what to remove."""
    found = staged(repeats(df, window, id_col, text_col), "repeats")
    rest = F.struct(F.lit(0).alias("_"), *other).alias("row")
    rows = df.select(rest, F.col(id_col).cast("long").alias("doc_id"), _packed_column(window)(F.col(text_col)).alias("p"))
    return rows.select("row", "doc_id", "p.key", "p.packed").join(found, ["doc_id", "key"], "left")


def removal_digests(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of each row.

    A null text has no words. Rows of one id are one document: they take nothing from each other,
    and equal rows each keep their row. Rows with a null id lose nothing and take nothing. An empty
    table gives an empty result; other columns, whatever their names, are left out.
    """
    prepare(df.sparkSession)
    joined = _joined(df, [F.col(id_col).alias("doc_id")], window, id_col, text_col)

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept_sha256: string>")
    @released
    def digests(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for packed, whole, starts in batches:
            counts, removed, shas = [], [], []
            for p, w, s in zip(packed, whole, starts, strict=True):
                words, kept = _kept(_unpack(p.as_py()), w.as_py(), np.asarray(s.values) if s.is_valid else None, window)
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["n_words", "n_removed", "kept_sha256"])

    found = joined.select("row.doc_id", digests("packed", "whole", "starts").alias("d"))
    return found.select("doc_id", "d.n_words", "d.n_removed", "d.kept_sha256")


def without_repeats(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df``; texts that lose words are the kept ones joined by one space.

    Other texts stay as they are, null ones too. Ids, equal rows and empty tables are handled as
    by ``removal_digests``. A text may become empty; its row stays.
    """
    prepare(df.sparkSession)
    others = [c for c in df.columns if c != text_col]
    joined = _joined(df, [F.col(c) for c in others], window, id_col, text_col)

    @F.arrow_udf("string")
    @released
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for packed, whole, starts in batches:
            out = []
            for p, w, s in zip(packed, whole, starts, strict=True):
                text = _unpack(p.as_py())
                if s.is_valid:
                    text = b" ".join(_kept(text, w.as_py(), np.asarray(s.values), window)[1]).decode()
                out.append(text)
            yield pa.array(out, pa.string())

    found = joined.select("row", cut("packed", "whole", "starts").alias("text"))
    return found.select(*[F.col("text").alias(text_col) if c == text_col else F.col(f"row.{c}") for c in df.columns])
