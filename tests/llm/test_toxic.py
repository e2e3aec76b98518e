import random
import string
from pathlib import Path

import numpy as np
import pytest
from odd import TEXTS, empty, frame

from millrace.llm import toxic
from millrace.llm.common import remainder
from millrace.llm.queries import toxicity_scorer

SF_DIR = "/root/testdata/sf0.1"

CLEAN = [f"{a}{b}{c}" for a in ("ba", "ko", "ri", "te", "mu", "la") for b in ("na", "so", "ti", "ve") for c in ("l", "r", "st", "n", "ko", "mi")]
BAD = ["idiot", "stupid", "worthless", "moron"]


def corpus(n=400, seed=1):
    chosen = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = chosen.choices(CLEAN, k=chosen.randrange(5, 60))
        bad = i % 4 == 0
        if bad:
            for _ in range(chosen.randrange(1, 4)):
                words.insert(chosen.randrange(len(words)), chosen.choice(BAD))
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(bad)))
    return docs, labels


def scorer(spark):
    docs, labels = corpus()
    found = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxic.train(frame(spark, docs).select("doc_id", "text"), found.where(remainder("doc_id", 5) != 0))


def test_kernel_of_gapped_words():
    words = ["idiot", "i.d.i.o.t", "idxiot", "IDIOT".lower(), "clown", "abc"]
    index, features = toxic._landmark_features(["idiot"])
    k = toxic._kernel(words, index, features)[:, 0]
    assert np.isclose(k[0], k[1]) and np.isclose(k[0], k[3])
    assert k[0] > k[2] > 0 and k[4] == 0 and k[5] == 0


def test_kernel_against_its_definition():
    chosen = random.Random(2)

    def features(word):
        codes = [toxic._BEGIN, *[ord(c) - 96 for c in word], toxic._END]
        found = {}
        for i in range(len(codes)):
            for offsets in toxic._OFFSETS:
                if i + offsets[2] < len(codes):
                    key = (codes[i], *[codes[i + o] for o in offsets[:3]])
                    found[key] = found.get(key, 0) + offsets[3]
        return found, sum(o[3] ** 2 for i in range(len(codes)) for o in toxic._OFFSETS if i + o[2] < len(codes))

    words = ["".join(chosen.choices("abcd", k=chosen.randrange(1, 12))) for _ in range(30)]
    index, rows = toxic._landmark_features(words[:10])
    got = toxic._kernel(words, index, rows)
    for i, a in enumerate(words):
        for j, b in enumerate(words[:10]):
            (x, nx), (y, ny) = features(a), features(b)
            wanted = sum(v * y.get(k, 0) for k, v in x.items()) / max(nx, 1) ** 0.5 / max(ny, 1) ** 0.5
            assert np.isclose(got[i, j], wanted, atol=1e-5), (a, b)


def test_letters_of_all_scripts():
    for bad, clean in (("дурак", "мирно"), ("βλακας", "θαλασσ"), ("멍청한놈이", "고마워요네"), ("あほばかやろ", "ありがとうね"), ("façonné", "fàñônnè")):
        index, features = toxic._landmark_features([bad])
        same, other, gapped = toxic._kernel([bad, clean, bad[:3] + "x" + bad[3:]], index, features)[:, 0]
        assert same > gapped > 0.2 * same and other < 0.2 * same


def test_insults_of_another_script():
    chosen = random.Random(3)
    clean = sorted({"".join(chosen.choices("абвгдежзиклмнопрстуы", k=chosen.randrange(4, 10))) for _ in range(600)})
    bad = ["дурак", "идиот", "тупица"]
    bags = [[chosen.choice(bad), *("".join(chosen.choices("бвгжзлмнопрс", k=8)) for _ in range(4))] for _ in range(200)]
    model = toxic.fit_words(bags, clean, 2000)
    assert (model.words(["дурак", "идиот", "идхиот"]) > 0).all()
    assert (model.words(clean) > 0).mean() < 0.02


def test_held_out_accuracy(spark):
    model = scorer(spark)
    docs, labels = corpus(300, seed=9)
    got = {r.doc_id: r for r in toxic.score(frame(spark, docs), model).collect()}
    assert len(got) == 300 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert np.mean([got[i].predicted == y for i, y in labels]) >= 0.97
    odd = [(1, "ko rin you i.d.i.o.t"), (2, "you i d i o t s"), (3, "you stuupid one"), (4, "nothing of this kind")]
    found = {r.doc_id: r.predicted for r in toxic.score(frame(spark, odd), model).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 0}
    kept = toxic.without_toxic(frame(spark, odd), model)
    assert [r.doc_id for r in kept.collect()] == [4] and kept.columns == frame(spark).columns


def test_wrong_labels_teach_nothing(spark):
    docs, labels = corpus()
    noisy = [(i, 1 if i % 37 == 1 else y) for i, y in labels]
    model = toxic.train(frame(spark, docs).select("doc_id", "text"), spark.createDataFrame(noisy, "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in toxic.score(frame(spark, docs), model).collect()}
    assert np.mean([got[i] == y for i, y in labels]) >= 0.97


def test_quoted_and_mislabelled_insults(spark):
    docs, labels = corpus(800)
    wrong = {i for i, y in labels if y and i % 50 == 0}  # toxic ones labelled clean
    docs += [(1000 + i, f"ko rin said {w} once more batil") for i, w in enumerate(BAD)]  # clean ones that quote
    noisy = [(i, 0 if i in wrong else y) for i, y in labels] + [(1000 + i, 0) for i in range(len(BAD))]
    model = toxic.train(frame(spark, docs).select("doc_id", "text"), spark.createDataFrame(noisy, "doc_id long, toxic int"))
    held, truth = corpus(300, seed=9)
    got = {r.doc_id: r.predicted for r in toxic.score(frame(spark, held), model).collect()}
    assert np.mean([got[i] == y for i, y in truth]) >= 0.97


def test_odd_rows(spark):
    model = scorer(spark)
    found = toxic.score(frame(spark), model).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((i for i, _ in TEXTS), key=str)
    base = {r.score for r in found if r.doc_id in (2, 3, 4)}
    assert len(base) == 1 and base.pop() < 0.5
    assert toxic.score(empty(spark), model).collect() == []


def test_nothing_to_learn_from(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    for docs, known in ((empty(spark), labels), (frame(spark), labels), (frame(spark), labels.limit(0))):
        model = toxic.train(docs.select("doc_id", "text"), known)
        assert all(r.predicted == 0 for r in toxic.score(frame(spark), model).collect())


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
def test_on_held_out_documents(spark):
    """Insults score high, also with a letter put in; clean words that begin like them do not.

    One toxic document in seven holds nothing that any clean one lacks: no scorer finds those.
    """
    model = toxicity_scorer(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxic.score(spark.read.parquet(f"{SF_DIR}/documents.parquet"), model).join(labels, "doc_id")
    rows = scored.where(remainder("doc_id", 5) == 0).select("toxic", "predicted").collect()
    caught = sum(r.toxic and r.predicted for r in rows)
    assert np.mean([r.toxic == r.predicted for r in rows]) >= 0.97
    assert caught >= 0.95 * sum(r.predicted for r in rows)
    assert caught >= 0.85 * sum(r.toxic for r in rows)

    def probability(words):
        return model.probability(model.words(words))

    insults = ["pathetic", "trash", "disgusting", "moron", "worthless", "clown", "loser", "scum", "idiot", "stupid"]
    assert (probability(insults) >= 0.5).all()
    assert (probability(["réeux", "achlich"]) < 0.5).all()
    chosen = random.Random(1)
    altered = [w[:k] + chosen.choice(string.ascii_lowercase) + w[k:] for w in insults for _ in range(40) for k in [chosen.randrange(1, len(w))]]
    assert (probability(altered) >= 0.5).mean() >= 0.8
