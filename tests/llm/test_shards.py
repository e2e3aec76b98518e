import hashlib
from collections import Counter

import duckdb
import pytest
from odd import TEXTS, empty, frame
from pyspark.sql import functions as F

from millrace.llm import shards


def brute(texts, limit):
    rows = [(i, len((t or "").encode()), int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)) for i, t in texts]
    out = []
    for i, size, h in rows:
        for depth in range(61):
            same = [r[1] for r in rows if r[2] >> (60 - depth) == h >> (60 - depth)]
            if sum(same) <= limit or len(same) == 1:
                out.append((i, size, f"{h:060b}"[:depth], depth, sum(same), len(same)))
                break
    return out


@pytest.mark.parametrize("limit", [1, 40, 500, 10_000, 10**9])
def test_against_the_rule(spark, limit):
    texts = [(i, "x" * (i * 7 % 90)) for i in range(200)] + [(1000, "y" * 600), (1001, None), (1002, "é")]
    got = [tuple(r) for r in shards.shards(frame(spark, texts), limit).collect()]
    assert sorted(got) == sorted(brute(texts, limit))


def test_hot_keys_are_dealt_out(spark):
    texts = [(7, "x" * 10)] * 2000 + [(i, "y" * 9) for i in range(500)] + [(9999, "z" * 5000)]
    found = shards.shards(frame(spark, texts), 1000).collect()
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.n_bytes
    assert len(found) == len(texts)
    assert sorted(sizes.values())[-1] == 5000 and sorted(sizes.values())[-2] <= 1000
    assert all(sizes[r.shard] == r.shard_bytes and len(r.shard) == r.depth for r in found)
    # no shard's prefix begins another's
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


def test_odd_rows(spark):
    found = shards.shards(frame(spark), 1000).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in found if r.doc_id is not None) == sorted((i, len((t or "").encode())) for i, t in TEXTS if i is not None)
    assert len(found) == len(TEXTS)
    assert shards.shards(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        shards.shards(frame(spark), 0)


def test_sql(spark):
    texts = [(i, f"text {i} " * (i % 50)) for i in range(300)]
    documents = frame(spark, texts).select("doc_id", "text").toPandas()  # noqa: F841
    db = duckdb.connect()
    db.register("documents", documents)
    wanted = db.execute(shards.SQL.replace(f"<= {shards.SHARD_BYTES}", "<= 2000")).fetchall()
    assert sorted(tuple(r) for r in shards.shards(frame(spark, texts), 2000).collect()) == sorted(wanted)


def test_no_python(spark):
    from conftest import plan

    text = plan(shards.shards(frame(spark), 1000))
    assert "Python" not in text and "Arrow" not in text


def test_rows_of_one_key_are_told_apart_by_their_number(spark):
    """Numbers that count up, in several tasks: bits in reverse, and never two the same."""
    numbers = [0, 1, 2, 3, 5, 1 << 33, (1 << 33) + 1, (1 << 59) + 7]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    got = [r[0] for r in df.select(shards._own_bits(F.col("n"))).collect()]
    assert got == [int(f"{n:060b}"[::-1], 2) for n in numbers]
    rows = [(1, "x" * 10)] * 300
    found = shards.shards(frame(spark, rows), limit=10).collect()
    assert len(found) == 300 and all(r.shard_rows == 1 for r in found)
