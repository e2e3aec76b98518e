import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, empty, frame

from millrace.llm import tokencount
from millrace.llm.common import BoundedCache

MODEL = tokencount.TokenLengths(open(tokencount.MODEL, "rb").read())
LIBRARY = tokenizers.Tokenizer.from_file(tokencount.MODEL)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x0b\x1c\x85\xa0'sdlretoaABC019½Ⅳé中.,!"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_pretokens_add_up(text):
    cache = BoundedCache(MODEL.encoded, 1000)
    pretokens, added = MODEL.parts(text)
    assert sum(map(cache.__getitem__, pretokens)) + added == library(text)


def test_counts(spark):
    got = sorted((tuple(r) for r in tokencount.token_counts(frame(spark)).collect()), key=str)
    wanted = [(i, len((t or "").encode()), library(t), library(t) > 1024) for i, t in TEXTS]
    assert got == sorted(wanted, key=str)
    assert tokencount.token_counts(empty(spark)).collect() == []


def test_special_strings_inside_texts(spark):
    for text in ["<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|endoftext|"]:
        pretokens, added = MODEL.parts(text)
        assert sum(map(MODEL.encoded, pretokens)) + added == library(text)


def test_the_first_tier_never_decides_a_count():
    lengths = {f"w{i}": i % 7 + 1 for i in range(5000)}
    table = tokencount.FrequentTable(lengths)
    assert all(table.get(w) == n for w, n in lengths.items())
    assert [table.get(f"none{i}") for i in range(5000)] == [0] * 5000
    assert tokencount.FrequentTable({}).get("x") == 0
