import math
import random

import numpy as np
from odd import TEXTS, empty, frame

from millrace.llm import langid

VOCABULARY = langid.Vocabulary(open(langid.MODEL, "rb").read())
PIECES = {k: VOCABULARY.matches.get(k) >> 8 for k in VOCABULARY.matches.keys()}
PIECES |= {chr(c): int(VOCABULARY.letters[c]) for c in np.nonzero(VOCABULARY.letters)[0]}


def test_all_segmentations_are_summed():
    model = langid.fit(VOCABULARY, [("a", "hello", 5), ("a", "the", 9), ("b", "bonjour", 4), ("b", "ouéé", 2)], 2)

    def brute(text, column):
        if not text:
            return 1.0
        total = model.probability[0, column] * brute(text[1:], column)
        for size in range(1, len(text) + 1):
            if text[:size] in PIECES:
                total += model.probability[PIECES[text[:size]], column] * brute(text[size:], column)
        return total

    words = ["hello", "the", "ouéé", "x", "hellothe", "中", "ß"]
    got = model.loglikelihood(VOCABULARY, words)
    for i, word in enumerate(words):
        assert np.allclose(got[i], [math.log(brute("▁" + word, c)) for c in (0, 1)])


def test_expectations_add_up():
    words, weight = ["hello", "the", "ouéé"], np.array([[2.0], [1.0], [3.0]])
    probability = np.full((VOCABULARY.size, 1), 1e-4)
    seen = VOCABULARY.lattice(words).expected(probability, weight)
    length = np.ones(VOCABULARY.size)
    for piece, at in PIECES.items():
        length[at] = len(piece)
    # each letter and word mark is in exactly one piece of a segmentation; few are in piece 0
    letters = sum(w * (len(x) + 1) for x, w in zip(words, weight[:, 0]))
    assert 0.4 * letters < (seen[:, 0] * length).sum() <= letters
    probability[0] = 1e-12
    seen = VOCABULARY.lattice(words).expected(probability, weight)
    assert np.isclose((seen[:, 0] * length).sum(), letters)


def samples(n, seed):
    chosen = random.Random(seed)
    kinds = {"xx": ["the", "and", "thing", "over", "with", "mother"], "yy": ["und", "der", "nicht", "über", "mutter", "sein"], "zz": ["les", "été", "vous", "mère", "quoi", "avec"]}
    return [(i, " ".join(chosen.choices(kinds[k], k=6)).upper() + "! 123", k) for i, k in enumerate(chosen.choices(list(kinds), k=n))]


def test_languages(spark):
    train = spark.createDataFrame([*samples(200, 1), (900, None, "xx"), (901, "the", None)], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.languages == ["xx", "yy", "zz"]
    held = samples(100, 2)
    docs = frame(spark, [(i, t) for i, t, _ in held])
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert np.mean([got[i].lang_pred == k for i, _, k in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    found = sorted((tuple(r)[:2] for r in langid.identify(frame(spark), model).collect()), key=str)
    assert [i for i, _ in found] == sorted((i for i, _ in TEXTS), key=str)
    assert all(lang == "und" for i, lang in found if i in (2, 3, 4))
    signs = langid.identify(frame(spark, [(1, "12 ² !! _"), (2, "a")]), model).collect()
    assert [(r.lang_pred == "und", r.score > 0) for r in sorted(signs)] == [(True, False), (False, True)]
    assert langid.identify(empty(spark), model).collect() == []


def test_every_sampled_word_counts(spark, monkeypatch):
    # one bound over all languages would leave nothing of the last one, all of whose words are rare
    monkeypatch.setattr(langid, "WORDS", 6, raising=False)
    rows = [(i, " ".join(["the", "and", "mother", "over", "with", "thing"] * 3), "aa") for i in range(20)]
    rows += [(100 + i, w, "zz") for i, w in enumerate(["слово", "другое", "было", "мать"])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "zz"]
    counts = [("aa", w, 60) for w in ("the", "and", "mother", "over", "with", "thing")] + [("zz", r[1], 1) for r in rows[20:]]
    assert np.allclose(model.probability, langid.fit(VOCABULARY, counts).probability)


def test_no_language_known(spark):
    model = langid.train(empty(spark))
    assert {(r.lang_pred, r.score) for r in langid.identify(frame(spark), model).collect()} == {("und", 0.0)}
