"""SimHash near-duplicates, found by deletion variants of few segments.

Two fingerprints that differ in at most ``k`` bits differ in at most one bit of some segment,
if there are ``k // 2 + 1`` segments. So each fingerprint is listed under each of its segments
as it is, and under each segment with one bit wiped out; rows that meet in such a bucket are
verified on all 64 bits.

Pairs are never listed. In each bucket, members are linked to three of its members (pivots)
where they are close enough; the classes that result cover groups of near copies. Only buckets
that still hold several classes are compared on, and there only members outside the bucket's
largest class, against all others of another class, in blocks of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import prepare, released, staged
from millrace.llm.graph import components

#: Words in a shingle, largest distance in bits, members of a bucket that one task compares with as many.
WORDS, MAX_BITS, BLOCK = 4, 4, 4096
#: Shingles of a long text whose bits are counted at once.
AT_ONCE = 1 << 14
#: Bucket keys that one task lists.
KEYS = 500_000
#: Fixed seed of the hash, and bits that turn the order of fingerprints over.
SEED, OTHER = 42, 0x5DEECE66D5DEECE6


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The majority of the shingles' hashes, bit by bit; zero without words. Signed, as a long."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and the six separators asked for
    each = text.encode("utf-8", "replace").lower().split() if text else []
    if not each:
        return 0
    if len(each) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(each), SEED)]
    else:
        joined = b" ".join(each)
        ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=False)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = np.array(hashes[at : at + AT_ONCE], ">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprint_column(df: DataFrame, text: str | Column, words: int = WORDS) -> Column:
    """The fingerprint of a text column of ``df``, as a long."""
    prepare(df.sparkSession)

    @F.arrow_udf("bigint")
    @released
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())

    return each(text)


def _long(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def variants(max_bits: int) -> list[tuple[int, int, int]]:
    """``(slot, mask, wildcard)``: what of a fingerprint stays in each of its bucket keys."""
    segments, found, at = max_bits // 2 + 1, [], 0
    for s in range(segments):
        width = 64 // segments + (s < 64 % segments)
        mask = ((1 << width) - 1) << at
        found.append((64 + s, _long(mask), 0))
        found += [(i, _long(mask & ~(1 << i)), _long(1 << i)) for i in range(at, at + width)]
        at += width
    return found


def _listed(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``slot, value, fp`` for each bucket that a fingerprint belongs to."""
    fp = F.col("fp")
    keys = [F.struct(F.lit(s).cast("int").alias("slot"), fp.bitwiseAND(F.lit(m)).alias("value")) for s, m, _ in variants(max_bits)]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.slot", "key.value", "fp")


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _blocks(count: str, block: int) -> Column:
    return F.ceil(F.col(count) / block).cast("int")


def _dealt(nodes: DataFrame, max_bits: int) -> DataFrame:
    """The nodes in as many tasks as their bucket keys need, since a small table is read by very few."""
    keys = nodes.count() * len(variants(max_bits))
    return nodes.repartition(max(1, -(-keys // KEYS)), "fp")


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``fp, root`` of all distinct fingerprints that are linked to another one.

    ``nodes`` holds each fingerprint once. No link is lost: what the pivots do not join is
    compared in full.
    """
    key = ["slot", "value"]
    listed = _listed(_dealt(nodes, max_bits), max_bits)
    # the third pivot is the first in another order of the same numbers
    other = F.lit(_long(OTHER))
    third = F.min(F.col("fp").bitwiseXOR(other)).bitwiseXOR(other)
    buckets = listed.groupBy(*key).agg(F.count("*").alias("n"), F.min("fp").alias("p1"), F.max("fp").alias("p2"), third.alias("p3"))
    buckets = staged(buckets.where("n > 2").unionByName(buckets.where((F.col("n") == 2) & _near("p1", "p2", max_bits))), "buckets")
    members = staged(listed.join(buckets.where("n > 2"), key), "members")
    # a. members against pivots; of two members, either is one
    close = buckets.where("n = 2").select(F.col("p1").alias("a"), F.col("p2").alias("b"))
    for pivot in ("p1", "p2", "p3"):
        close = close.union(members.where(_near("fp", pivot, max_bits)).select("fp", pivot))
    classes = components(close)
    # b. what is left: buckets of several classes
    named = members.select(*key, "fp").join(classes.withColumnRenamed("node", "fp"), "fp", "left")
    named = staged(named.select(*key, "fp", F.coalesce("root", "fp").alias("class")), "named")
    sizes = named.groupBy(*key, "class").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy(*key).agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"))
    mixed = mixed.where(F.col("n") > F.col("main.n"))
    mixed = mixed.select(*key, F.col("main.class").alias("main"), _blocks("n", block).alias("all_blocks"), F.ceil((F.col("n") - F.col("main.n")) / block).cast("int").alias("own_blocks"))
    rest = named.join(mixed, key)
    own, other = F.pmod(F.xxhash64("fp"), F.col("own_blocks")), F.pmod(F.xxhash64("fp"), F.col("all_blocks"))
    left = rest.where(F.col("class") != F.col("main")).select(*key, F.col("fp").alias("x"), F.col("class").alias("a"), own.alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("j"))
    right = rest.select(*key, F.col("fp").alias("y"), F.col("class").alias("b"), F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1)).alias("i"), other.alias("j"))
    more = left.join(right, [*key, "i", "j"]).where((F.col("a") != F.col("b")) & _near("x", "y", max_bits)).select("a", "b")
    more = staged(more.distinct(), "links")
    whole = components(classes.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    return whole.select(F.col("node").alias("fp"), "root")


def near_duplicates(df: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id reachable over
    links of ``max_bits`` or fewer differing bits. Null, empty and blank texts have the
    fingerprint zero and are linked like any other. Equal rows each keep their row. Rows with a
    null id belong to a component but never name it; it is null where no row of it has an id. An
    empty table gives an empty result; other columns, whatever their names, are left out.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), fingerprint_column(df, F.col(text_col), words).alias("fp"))
    rows = staged(rows, "fingerprints")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    linked = links(nodes.select("fp"), max_bits, block)
    rooted = nodes.join(linked, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(named, "root").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", hexed, "component_id")


def without_copies(df: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` but for those whose component has a smaller id; rows without id stay."""
    found = near_duplicates(df, words, max_bits, id_col, text_col)
    copies = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    return df.join(copies, id_col, "left_anti")
