"""Shards of bounded size by extendible hashing, in DataFrame functions alone.

A row's place is a prefix of its hash bits. A shard that holds more bytes than allowed is split
by one bit more, and only that one, until each shard fits. Sizes are first summed in cells of
a fixed depth, several for each shard to come, so that the splits work on the cells: the
directory, which grows with the number of shards and not with that of rows. Cells that are
still too large are cut finer from their rows.

The bits are the key's, then, for rows of one key, those of a number that each row gets, the
lowest first: a key with any share of all rows is dealt over as many shards as it needs, and as
no two rows have the same number, all their bits tell any two apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged

#: Bytes in a shard, at most.
SHARD_BYTES = 8 << 20
#: Bits of the key's hash, and of the number of a row; bits by which cells are finer than shards.
KEY_BITS, ROW_BITS, FINER = 60, 60, 6

_ALL = KEY_BITS + ROW_BITS


def _bits(text: Column) -> Column:
    """The first 60 bits of an MD5, as a long."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _own_bits(number: Column) -> Column:
    """The 60 bits of a row's number in reverse, as a long: numbers count up, so their lowest bits deal evenly."""
    return F.conv(F.reverse(F.lpad(F.bin(number), ROW_BITS, "0")), 2, 10).cast("long")


def _prefix(depth: int, h1: str | Column = "h1", h2: str | Column = "h2", of: int = _ALL) -> list[Column]:
    """The first ``depth`` bits of ``of`` bits that are there, in two longs."""
    first, there = min(depth, KEY_BITS), min(of, KEY_BITS)
    second, more = max(0, depth - KEY_BITS), max(0, of - KEY_BITS)
    p2 = F.shiftright(h2, more - second) if second else F.lit(0).cast("long")
    return [F.shiftright(h1, there - first).alias("p1"), p2.alias("p2")]


def _split(cells: DataFrame, fine: int, begin: int, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Depth and size of the shard of each cell, and cells that not even all their bits make small enough."""
    closed, open_ = None, cells
    for depth in range(begin, fine + 1):
        named = open_.select("*", *[c.alias(f"b{i}") for i, c in enumerate(_prefix(depth, "c1", "c2", fine))])
        buckets = named.groupBy("b0", "b1").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") <= 1)
        named = staged(named.join(buckets.withColumn("fits", fits), ["b0", "b1"]), "cells")
        done = named.where("fits").select("c1", "c2", F.lit(depth).alias("depth"), "shard_bytes", "shard_rows")
        closed = done if closed is None else closed.unionAll(done)
        open_ = named.where("not fits").select("c1", "c2", "bytes", "n")
        if open_.isEmpty():
            return closed, None
    return closed, open_


def assigned(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``depth, shard_bytes, shard_rows``; ``rows`` has ``h1, h2, n_bytes`` and is durable."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    fine = min(_ALL, int(total // limit).bit_length() + FINER)
    begin, parts = 0, []
    while True:
        placed = rows.select("*", *[c.alias(n) for n, c in zip(("c1", "c2"), _prefix(fine), strict=True)])
        cells = placed.groupBy("c1", "c2").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        closed, open_ = _split(staged(cells, "cells"), fine, begin, limit)
        parts.append(placed.join(closed, ["c1", "c2"]).drop("c1", "c2"))
        if open_ is None or fine == _ALL:
            break
        # each of these cells holds one shard at least, whatever its rows: one bit more and on
        rows = staged(placed.join(open_.select("c1", "c2"), ["c1", "c2"], "left_semi").drop("c1", "c2"), "rows")
        begin, fine = fine + 1, min(_ALL, fine + 2 * FINER)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _name(depth: Column) -> Column:
    """The prefix in binary digits; empty where all is one shard."""
    digits = F.concat(F.lpad(F.bin("h1"), KEY_BITS, "0"), F.lpad(F.bin("h2"), ROW_BITS, "0"))
    return F.substring(digits, F.lit(1), depth)


def shards(df: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, shard, depth, shard_bytes, shard_rows`` of each row.

    ``shard`` is the prefix in binary digits, ``depth`` its length. No shard has more than ``limit``
    bytes of text, but for one that is a single row. A null text has no bytes; null ids are one
    key, as are equal ids: their rows stay together while they fit. Equal rows each keep their
    row, an empty table gives an empty result, and other columns, whatever their names, are
    left out.
    """
    if limit < 1:
        raise ValueError("a shard needs room for a byte")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), size.alias("n_bytes"), _bits(key).alias("h1"), F.monotonically_increasing_id().alias("row"))
    # written once: a row keeps its number, which has fewer than 60 bits up to 134 million tasks
    rows = staged(rows.withColumn("h2", _own_bits(F.col("row"))).drop("row"), "rows")
    found = assigned(rows, limit)
    return found.select("doc_id", "n_bytes", _name(F.col("depth")).alias("shard"), "depth", "shard_bytes", "shard_rows")


#: The same rule in closed form, for unique ids: the least depth at which a prefix fits.
SQL = f"""
WITH d AS (
    SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
    FROM documents
), l AS (
    SELECT d.*, CAST(k AS INTEGER) AS depth, h >> (60 - k) AS p FROM d, generate_series(0, 40) AS t(k)
), s AS (
    SELECT depth, p, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows FROM l GROUP BY depth, p
), f AS (
    SELECT l.*, shard_bytes, shard_rows, row_number() OVER (PARTITION BY l.doc_id ORDER BY l.depth) AS place
    FROM l JOIN s USING (depth, p) WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1
)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(p), depth, '0') END AS shard,
       depth, shard_bytes, shard_rows
FROM f WHERE place = 1
"""
