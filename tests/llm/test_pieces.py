import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, empty, frame
from pyspark.sql import functions as F

from millrace.llm import pieces

MODEL = pieces.PieceModel(open(pieces.MODEL, "rb").read())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tetaoinshr.,=<>/s0189é中"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_as_the_library_has_it(text):
    ids = [*LIBRARY.encode(text), MODEL.end]
    assert MODEL.encode(text) == " ".join(map(str, ids))
    assert MODEL.decode(MODEL.encode(text)) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 300), max_size=20))
def test_any_ids_as_the_library_has_them(ids):
    assert MODEL.decode(" ".join(map(str, ids))) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["=" * 200, " " * 100, "a" * 300, "\n" * 50, "▁▁ ▁ ▁▁▁x", "<s>", "�", "﻿x"])
def test_runs(text):
    assert MODEL.encode(text) == " ".join(map(str, [*LIBRARY.encode(text), MODEL.end]))


def test_round_trip(spark):
    got = [tuple(r) for r in pieces.round_trip(frame(spark)).collect()]
    wanted = []
    for doc_id, text in TEXTS:
        ids = [*LIBRARY.encode(text or ""), LIBRARY.eos_id()]
        wanted.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert pieces.round_trip(empty(spark)).collect() == []


def test_columns(spark):
    df = frame(spark)
    found = df.select("text", pieces.encode_column(df, "text").alias("ids"))
    found = found.withColumn("back", pieces.decode_column(found, "ids"))
    for row in found.collect():
        assert row.ids == [*LIBRARY.encode(row.text or ""), 2]
        assert row.back == LIBRARY.decode(row.ids)
    none = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert none.select(pieces.decode_column(none, "ids")).first()[0] is None


def test_a_full_cache_starts_anew():
    small = pieces.PieceModel(open(pieces.MODEL, "rb").read())
    small.chunk.limit = small.apart.limit = 3
    text = "one two three four five six one two"
    assert small.encode(text) == MODEL.encode(text)
