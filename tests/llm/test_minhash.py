import random
import re
from pathlib import Path

import numpy as np
import pytest
from odd import TEXTS, empty, frame

from millrace.llm import minhash
from millrace.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute_set(text, words=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    each = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(each[i : i + words]) for i in range(max(1, len(each) - words + 1))} if each else set()


def brute(texts, percent=85):
    sets = [brute_set(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if None not in (texts[i][0], texts[j][0]) and a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    found = []
    for k, (i, _) in enumerate(texts):
        component = None if i is None else least[find(k)]
        found.append((i, len(sets[k]), component, None if i is None else i == component))
    return sorted(found, key=str)


def got(spark, texts, **more):
    return sorted((tuple(r) for r in minhash.near_duplicates(frame(spark, texts), **more).collect()), key=str)


def test_odd_rows(spark):
    assert got(spark, TEXTS) == brute(TEXTS)
    few = [(1, "a b"), (2, "A  B"), (3, "a"), (4, "a b c d e"), (5, "a b c d e f"), (6, None), (7, "  "), (8, "a b c d e"), (None, "a b")]
    assert got(spark, few) == brute(few)
    assert minhash.near_duplicates(empty(spark)).collect() == []
    assert got(spark, [(None, "a b"), (None, None)]) == brute([(None, "a b"), (None, None)])


def edited(chosen, words, edits):
    words = list(words)
    for _ in range(edits):
        words[chosen.randrange(len(words))] = f"z{chosen.randrange(10_000)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])
def test_groups_and_chains(spark, block):
    """Copies of one text, chains of edits, shuffled words, short texts, near the threshold."""
    chosen = random.Random(block)
    base = [f"w{i}" for i in range(200)]
    texts = [(i, edited(chosen, base, chosen.randrange(9))) for i in range(120)]
    last = [f"c{i}" for i in range(150)]
    for i in range(40):
        texts.append((200 + i, " ".join(last)))
        last = edited(chosen, last, 2).split()
    texts += [(300 + i, " ".join(chosen.choices(base, k=chosen.randrange(12)))) for i in range(60)]
    texts += [(400 + i, texts[i][1]) for i in range(0, 60, 3)] + [(500 + i, texts[i][1].upper()) for i in range(20)]
    chosen.shuffle(texts)
    assert got(spark, texts, block=block) == brute(texts)


def test_the_threshold_is_exact():
    a = np.arange(100, dtype=np.uint64)
    assert minhash.similar(a[:85], a, 85) and not minhash.similar(a[:84], a, 85)
    assert not minhash.similar(a[:0], a[:0], 85)


def reference(items, size):
    """Offers of one element after another, each with its whole permutation."""
    best = [(1 << 64) - 1] * size
    for item in items:
        places = list(range(size))
        for step in range(size):
            bits = int(minhash._mixed(np.array([(item + (step + 1) * minhash._STEP) % (1 << 64)], np.uint64))[0])
            at = step + ((bits & 0xFFFFFFFF) * (size - step) >> 32)
            places[step], places[at] = places[at], places[step]
            best[places[step]] = min(best[places[step]], bits >> 32 | step << 32)
    return best


def test_early_stopping_changes_nothing(monkeypatch):
    chosen = random.Random(2)
    sets = [np.array(sorted(chosen.sample(range(1 << 62), n)), np.uint64) for n in (1, 2, 7, 30, 150, 400)]
    want = [reference(s.tolist(), 30) for s in sets]
    assert minhash.signatures(sets, 30).tolist() == want
    monkeypatch.setattr(minhash, "AT_ONCE", 50)
    assert minhash.signatures(sets, 30).tolist() == want


def test_signatures_estimate_similarity_with_less_variance():
    chosen, errors = random.Random(4), []
    for _ in range(300):
        items = np.array(chosen.sample(range(1 << 62), 60), np.uint64)
        a, b = minhash.signatures([items[:40], items[20:]], 64)
        errors.append((a == b).mean() - 1 / 3)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 0.9 * (1 / 3 * 2 / 3 / 64)


def test_bands_find_similar_sets():
    """Sets at the threshold: every pair shares a band."""
    chosen, found = random.Random(5), 0
    for _ in range(300):
        items = np.array(chosen.sample(range(1 << 62), 215), np.uint64)
        keys = minhash.band_keys(minhash.signatures([items[:200], items[15:]], minhash.BANDS * minhash.PLACES), minhash.BANDS)
        found += (keys[0] == keys[1]).any()
    assert found == 300


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_prefix_filter_loses_no_pair(spark, seed):
    """All pairs at or above the threshold among sets of many sizes, each a class of its own."""
    chosen, sets = random.Random(seed), []
    for size in (4, 5, 20, 41, 90):
        base = chosen.sample(range(1 << 40), size)
        for _ in range(25):
            changed = set(base) - set(chosen.sample(base, chosen.randrange(1 + size // 6)))
            sets.append(np.array(sorted(changed | {chosen.randrange(1 << 40) for _ in range(chosen.randrange(1 + size // 8))}), np.uint64))
    frame_ = spark.createDataFrame([(i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, n long, hashes binary")
    rest = frame_.selectExpr("node", "node AS class")
    got = {(r.a, r.b) for r in minhash._across(minhash._prefixes(rest, frame_, 85), 85, 7).collect()}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if minhash.similar(sets[i], sets[j], 85)}
    assert want and want <= got and len(got) < len(sets) ** 2 / 4


def test_changed_copies_do_not_meet(spark):
    """Copies of one text, each with more changes of its own than may be: no pair is compared."""
    base = list(range(100))
    sets = [np.array(sorted(base[: 100 - 20] + [1000 * (i + 1) + k for k in range(20)]), np.uint64) for i in range(200)]
    frame_ = spark.createDataFrame([(i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, n long, hashes binary")
    assert minhash._prefixes(frame_.selectExpr("node", "node AS class"), frame_, 85).count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
def test_the_query_on_the_smallest_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_minhash"](spark, SF_DIR).collect()), key=str) == brute(rows)
