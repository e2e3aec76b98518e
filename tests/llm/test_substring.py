import hashlib
import random
import re

import pytest
from odd import LONG, TEXTS, empty, frame

from millrace.llm import substring


def brute(texts, window):
    first = {}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in texts]
    for (i, _), each in zip(texts, words):
        for k in range(len(each) - window + 1):
            if i is not None:
                run = tuple(each[k : k + window])
                first[run] = min(i, first.get(run, i))
    kept = []
    for (i, _), each in zip(texts, words):
        gone = [False] * len(each)
        for k in range(len(each) - window + 1):
            if i is not None and first[tuple(each[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept.append([w for w, g in zip(each, gone) if not g])
    return words, kept


def check(spark, texts, window):
    words, kept = brute(texts, window)
    got = sorted((tuple(r) for r in substring.removal_digests(frame(spark, texts), window).collect()), key=str)
    wanted = [(i, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for (i, _), w, k in zip(texts, words, kept)]
    assert got == sorted(wanted, key=str)


def test_covers():
    for window in (1, 2, 3, 5, 8, 20, 32, 50, 100):
        period, found = substring.cover(window)
        assert period <= window
        assert {(a - b) % period for a in found for b in found} == set(range(period))


def test_odd_rows(spark):
    check(spark, [*TEXTS, (20, LONG), (21, "x " + LONG), (None, LONG), (None, LONG), (20, "other " * 80)], 50)
    assert substring.removal_digests(empty(spark)).collect() == []
    assert substring.without_repeats(empty(spark)).collect() == []


@pytest.mark.parametrize("window", [1, 2, 5, 9, 50])
def test_shared_passages(spark, window):
    chosen = random.Random(window)
    passages = [[f"p{chosen.randrange(40)}" for _ in range(chosen.randrange(window, 3 * window + 2))] for _ in range(6)]
    texts = []
    for i in range(40):
        words = []
        for _ in range(chosen.randrange(4)):
            words += [f"q{chosen.randrange(3)}" for _ in range(chosen.randrange(2 * window))]
            words += chosen.choice(passages)[: chosen.choice([window - 1, 10_000, 10_000])]
        texts.append((chosen.randrange(30), " ".join(words)))
    texts.append(texts[3])
    check(spark, texts, window)


def test_texts_are_cut(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [(1, f"a\n b {passage}"), (2, f"c  {passage} d"), (3, "left\nas  it is"), (4, None), (5, passage), (6, passage)]
    got = {r.doc_id: r.text for r in substring.without_repeats(frame(spark, texts)).collect()}
    assert got == {1: f"a\n b {passage}", 2: "c d", 3: "left\nas  it is", 4: None, 5: "", 6: ""}
    assert substring.without_repeats(frame(spark)).columns == frame(spark).columns
