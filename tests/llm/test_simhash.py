import random
import re

import pytest
import xxhash
from odd import TEXTS, empty, frame

from pyspark.sql import functions as F

from millrace.llm import graph, simhash
from millrace.llm.graph import components


def brute_fingerprint(text, words=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    each = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(each[i : i + words]) for i in range(max(1, len(each) - words + 1))] if each else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def check(spark, texts, max_bits=4, block=simhash.BLOCK):
    got = sorted((tuple(r) for r in simhash.near_duplicates(frame(spark, texts), max_bits=max_bits, block=block).collect()), key=str)
    prints = [brute_fingerprint(t) for _, t in texts]
    roots = brute_components(prints, max_bits)
    least = {}
    for root, (i, _) in zip(roots, texts):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    wanted = [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(texts, prints, roots)]
    assert got == sorted(wanted, key=str)


def test_odd_rows(spark):
    check(spark, TEXTS)
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.without_copies(empty(spark)).collect() == []


def test_only_rows_without_id(spark):
    check(spark, [(None, "a b c"), (None, None)])


@pytest.mark.parametrize("max_bits, block", [(4, 4096), (4, 2), (3, 4096), (1, 3)])
def test_near_copies(spark, max_bits, block):
    chosen = random.Random(max_bits)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(chosen.randrange(12)):
            words[chosen.randrange(len(words))] = f"z{chosen.randrange(1000)}"
        texts.append((i, " ".join(words)))
    texts += [(100 + i, " ".join(chosen.choices(base, k=chosen.randrange(30)))) for i in range(60)]
    check(spark, texts, max_bits, block)


def test_links_between_any_fingerprints(spark):
    """Chains, stars and strangers of chosen distances, in blocks of two."""
    chosen = random.Random(5)
    prints = {chosen.getrandbits(64) for _ in range(20)} | {0, (1 << 64) - 1}
    for p in list(prints):
        for _ in range(8):
            for _ in range(chosen.randrange(1, 6)):
                p ^= 1 << chosen.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.fp: r.root for r in simhash.links(nodes, 4, 2).collect()}
    roots = brute_components(prints, 4)
    groups = {}
    for s, r in zip(signed, roots):
        groups.setdefault(r, []).append(s)
    for group in groups.values():
        assert {got.get(s, s) for s in group} == {min(group)}


def test_variants_meet_within_the_distance():
    chosen = random.Random(1)
    for max_bits in (1, 2, 3, 4, 5):
        keys = simhash.variants(max_bits)
        for _ in range(200):
            a = chosen.getrandbits(64)
            b = a
            for bit in chosen.sample(range(64), max_bits):
                b ^= 1 << bit
            assert any(a & m % (1 << 64) == b & m % (1 << 64) for _, m, _ in keys)


def test_one_of_each_group_stays(spark):
    texts = [(5, "a b c d e"), (2, "A B C D E"), (9, "a b c d e"), (1, "quite another text here"), (None, "a b c d e")]
    kept = simhash.without_copies(frame(spark, texts))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, None]
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] or set(kept.columns) == set(frame(spark).columns)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (95, 100), (200, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_a_hot_node_is_spread(spark, threshold):
    """Most edges at one node: no task holds much more than its share, with and without broadcast joins."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        edges = spark.range(1, 70_001, 1, 16).selectExpr("0 AS a", "id AS b").union(spark.range(100_000, 130_000, 2, 16).selectExpr("id AS a", "id + 1 AS b"))
        both = edges.union(edges.selectExpr("b", "a"))
        lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"), F.count("*").alias("n"))
        joined = graph._with_lowest(both, lowest, 5000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 170_000 and max(sizes) <= 3 * 170_000 / 32
        roots = graph.components(edges, 5000)
        assert roots.count() == 85_000 and roots.where("root = 0").count() == 70_000
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
