import random

import numpy as np
from odd import TEXTS, empty, frame

from millrace.llm import decontam


def brute(item, words):
    """Least edits to a stretch of the words, by the plain recurrence."""
    row = [0] * (len(words) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(words):
            new.append(min(row[j] + (w != v), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(chosen, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = chosen.randrange(len(words)), chosen.randrange(3)
        if kind == 0:
            words[at] = f"new{chosen.randrange(9)}"
        elif kind == 1:
            words.insert(at, "in")
        else:
            del words[at]
    return words


def items_and_docs():
    chosen = random.Random(4)
    vocabulary = [f"v{i}" for i in range(150)]
    items = [(i, " ".join(chosen.choices(vocabulary, k=chosen.randrange(9, 50)))) for i in range(30)]
    docs = []
    for i in range(150):
        words = chosen.choices(vocabulary + ["other"] * 40, k=chosen.randrange(120))
        if i % 3 == 0:
            item = items[chosen.randrange(30)][1].split()
            words += edited(chosen, item, chosen.randrange(len(item) // 4 + 1)) + chosen.choices(vocabulary, k=20)
        docs.append((i, " ".join(words).upper() + "."))
    return items, docs


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, edits string, doc_id string")


def test_against_all_places(spark):
    items, docs = items_and_docs()
    got = {(r.doc_id, r.item_id): r.edits for r in decontam.contamination(frame(spark, docs), benchmark(spark, items)).collect()}
    wanted = {}
    for i, text in docs:
        words = decontam.words_of(text)
        for j, item in items:
            cost = brute(item.split(), words)
            if cost <= int(decontam.EDITS * len(item.split())):
                wanted[i, j] = cost
    assert len(wanted) > 40
    assert set(got) <= set(wanted)  # every find is verified
    found = [k for k in wanted if k in got]
    assert len(found) >= 0.95 * len(wanted)
    assert sum(got[k] == wanted[k] for k in found) >= 0.95 * len(found)


def test_blocks_of_items(spark):
    items, docs = items_and_docs()
    bench = benchmark(spark, items)
    parts = list(decontam.indexes(bench, block_bytes=1000))
    assert len(parts) > 3
    assert sorted(i for p in parts for i in p.ids) == list(range(30))


def test_long_items_among_short_ones():
    chosen = random.Random(7)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(chosen.choices(vocabulary, k=chosen.randrange(20, 40)))) for i in range(150)]
    items += [(1000 + n, " ".join(chosen.choices(vocabulary, k=n))) for n in (90, 150, 300, 600, 900)]
    texts, wanted = [], set()
    for item_id, text in items[-5:] * 4:
        words = edited(chosen, text.split(), int(decontam.EDITS * len(text.split())))
        wanted.add((len(texts), item_id))
        texts.append(" ".join(["other"] * 30 + words + ["end"] * 30))
    index = decontam.Index.of(items)
    found = {(text, item_id) for text, item_id, _, _ in index.find(texts)}
    assert found <= wanted and {w for w in wanted if w[1] > 1100} <= found
    assert len(found) >= 0.95 * len(wanted)
    assert index.find(["other", "v1 v2 v3", None, ""]) == []


def test_sizes_that_walks_miss(monkeypatch):
    # one walk is not enough for any size, so that every item has to be found without
    monkeypatch.setattr(decontam, "MOST_WALKS", 1)
    items, docs = items_and_docs()
    got = {(docs[t][0], j): edits for t, j, edits, _ in decontam.Index.of(items).find([t for _, t in docs])}
    wanted = {}
    for i, text in docs:
        for j, item in items:
            cost = brute(item.split(), decontam.words_of(text))
            if cost <= int(decontam.EDITS * len(item.split())):
                wanted[i, j] = cost
    assert got == wanted


def test_short_items_and_scripts_without_spaces(spark):
    items = [(1, "Who wrote Faust?"), (2, "yes"), (3, "one two three four five six"), (4, "日本の首都はどこですか"), (5, "กขคงจ ฉชซ"), (6, "?!"), (7, "b c b c")]
    docs = [(1, "so, who wrote faust"), (2, "who ever wrote faust"), (3, "Yes! yes, or no"), (4, "one two three 4 five six"), (5, "one two 3 4 five six")]
    docs += [(6, "問題：日本の首都はどこですか。"), (7, "日本国の首都は何処ですか"), (8, "日本の天気はどうですか"), (9, "กขคงจฉชซ"), (10, "a b c b c d"), (11, "b c c b")]
    got = sorted((tuple(r) for r in decontam.contamination(frame(spark, docs), benchmark(spark, items)).collect()))
    assert [g[:3] for g in got] == [(1, 1, 0), (3, 2, 0), (4, 3, 1), (6, 4, 0), (9, 5, 0), (10, 7, 0)]
    assert [g[3] for g in got] == [1, 0, 0, 2, 0, 1]
    kept = decontam.without_contaminated(frame(spark, docs), benchmark(spark, items))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 7, 8, 11]


def test_places():
    chosen = random.Random(1)
    for _ in range(300):
        item = [chosen.randrange(4) for _ in range(chosen.randrange(1, 9))]
        region = [chosen.randrange(4) for _ in range(chosen.randrange(12))]
        cost, first = decontam.placed(np.array(item), np.array(region, int))
        assert cost == brute(item, region)
        assert cost == min(brute(item, region[first:end]) for end in range(first, len(region) + 1)) and 0 <= first <= len(region)


def test_odd_rows(spark):
    items = [(1, TEXTS[0][1]), (None, "an item without any id is an item too"), (3, None), (4, ""), (5, "too short"), (1, TEXTS[0][1])]
    texts = [*TEXTS, (30, "so an item without any id is an item too, yes")]
    got = sorted((tuple(r) for r in decontam.contamination(frame(spark, texts), benchmark(spark, items)).collect()), key=str)
    assert got == sorted([(1, 1, 0, 0), (6, 1, 0, 0), (6, 1, 0, 0), (30, None, 0, 1)], key=str)
    kept = decontam.without_contaminated(frame(spark, texts), benchmark(spark, items))
    assert kept.count() == len(texts) - 4 and kept.columns == frame(spark).columns
    assert decontam.contamination(empty(spark), benchmark(spark, items)).collect() == []
    assert decontam.contamination(frame(spark), benchmark(spark, items).limit(0)).collect() == []
    assert decontam.without_contaminated(frame(spark), benchmark(spark, items).limit(0)).count() == len(TEXTS)


def test_items_without_id_are_many_blocks(spark):
    """Items without an id, or with one id, are dealt over bounded blocks; the best of an id's items counts once."""
    items = spark.createDataFrame([(None, f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i} eta{i} theta{i}") for i in range(400)] + [(7, f"one{i} two{i} three{i} four{i} five{i} six{i} seven{i} eight{i}") for i in range(400)], "item_id long, text string")
    size = sum(len(r.text) for r in items.collect())
    blocks = list(decontam.indexes(items, block_bytes=size // 8))
    assert len(blocks) >= 8 and max(len(b.items) for b in blocks) < 200
    docs = [(1, "x one3 two3 three3 four3 five3 six3 seven3 eight3 y one9 two9 three9 four9 five9 six9 seven9 eight9"), (1, "x one3 two3 three3 four3 five3 six3 seven3 eight3 y"), (2, "alpha5 beta5 gamma5 delta5 eps5 zeta5 eta5 theta5"), (3, "none")]
    got = sorted((tuple(r) for r in decontam.contamination(frame(spark, docs), items, block_bytes=size // 8).collect()), key=str)
    assert got == [(1, 7, 0, 1), (1, 7, 0, 1), (2, None, 0, 0)]


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("d1", "alpha beta gamma delta eps zeta eta theta"), (None, "nothing")], "doc_id string, text string")
    items = spark.createDataFrame([("i1", "alpha beta gamma delta eps zeta eta theta")], "item_id string, text string")
    assert [tuple(r) for r in decontam.contamination(docs, items).collect()] == [("d1", "i1", 0, 0)]
