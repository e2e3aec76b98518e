"""Each stage against a brute-force version on its own input, and the queries against their contracts."""

import hashlib
import re
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from test_decontam import brute as least_edits
from test_simhash import brute_components, brute_fingerprint
from test_substring import brute as passages

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import decontam, pieces
from millrace.llm.common import staged, table
from millrace.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept():
    """What each stage was given, by its name."""
    return {}


@pytest.fixture(scope="module")
def stages(kept):
    from conftest import SESSION as spark

    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs
        docs = staged(stage(spark, docs, SF_DIR), name)
        kept[f"{name} out"] = docs
    return kept


def texts(df):
    return [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substring", "decontamination", "sentencepiece"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert sorted(stages[f"{name} out"].columns) == sorted(COLUMNS)


def test_toxicity(spark, stages):
    labels = {r.doc_id: r.toxic for r in table(spark, SF_DIR, "labels").collect()}
    out = {i for i, _ in texts(stages["toxicity out"])}
    known = [i for i, _ in texts(stages["toxicity"]) if i in labels]
    assert np.mean([(i not in out) == labels[i] for i in known]) >= 0.85
    assert np.mean([i in out for i in known if not labels[i]]) >= 0.95


def test_simhash(stages):
    rows = texts(stages["simhash"])
    roots = brute_components([brute_fingerprint(t) for _, t in rows], 4)
    least = {}
    for (i, _), root in zip(rows, roots):
        least[root] = min(i, least.get(root, i))
    assert {i for i, _ in texts(stages["simhash out"])} == set(least.values())


def test_substring(stages):
    rows = texts(stages["substring"])
    words, left = passages(rows, 50)
    got = dict(texts(stages["substring out"]))
    for (i, text), each, some in zip(rows, words, left):
        assert got[i] == (text if len(some) == len(each) else " ".join(some))
    assert all(r.n_chars == len(r.text) for r in stages["substring out"].collect())


def test_decontamination(spark, stages):
    items = [decontam.words_of(r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    holds = set()
    for i, text in texts(stages["decontamination"]):
        words = decontam.words_of(text)
        known = set(words)
        near = [x for x in items if sum(w in known for w in x) >= len(x) - int(0.2 * len(x))]
        if any(least_edits(x, words) <= int(0.2 * len(x)) for x in near):
            holds.add(i)
    out = {i for i, _ in texts(stages["decontamination out"])}
    assert out == {i for i, _ in texts(stages["decontamination"])} - holds


def test_sentencepiece(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {r.doc_id: r for r in stages["sentencepiece out"].collect()}
    rows = texts(stages["sentencepiece"])
    assert len(got) == len(rows)
    for i, text in rows:
        ids = [*library.encode(text), 2]
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_registered(spark):
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


CONTRACTS = {
    "op1_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_language": "doc_id held_out lang_pred score",
    "op3_neighbours": "query_id rank vec_id score",
    "op4_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_decontamination": "doc_id item_id edits first_word",
    "op7_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8_substring": "doc_id n_words n_removed kept_sha256",
    "op9_toxicity": "doc_id held_out score predicted",
    "op10_sharding": "doc_id n_bytes shard depth shard_bytes shard_rows",
    "op11_minhash": "doc_id n_shingles component_id kept",
    "op12_infill": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op13_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}
TYPES = {"doc_id": "bigint", "score": "double", "held_out": "boolean", "n_tokens": "bigint", "rank": "int", "predicted": "int", "component_id": "bigint", "n_turns": "bigint", "loss_chars": "bigint"}
TYPES |= dict.fromkeys(["n_shingles", "n", "prefix_chars", "middle_chars", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"], "bigint") | {"kept": "boolean", "audit": "string"}


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_contract(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert set(CONTRACTS[name].split()) <= set(df.columns)
    assert all(kind == TYPES.get(c, kind) for c, kind in df.dtypes)
    n = df.count()
    documents = table(spark, SF_DIR, "documents").count()
    if "conv_id" in df.columns:
        # op7 adds one of its own
        assert n == table(spark, SF_DIR, "conversations").select("conv_id").distinct().count() + (name == "op7_chat")
    elif name not in ("op3_neighbours", "op6_decontamination"):
        assert n == documents
    else:
        assert n > 0


def test_held_out_languages(spark):
    got = QUERIES["op2_language"](spark, SF_DIR).where("held_out").join(table(spark, SF_DIR, "documents"), "doc_id")
    rows = got.where("lang is not null").select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95


def test_the_awkward_conversation(spark):
    row = QUERIES["op7_chat"](spark, SF_DIR).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert (row.n_turns, row.loss_chars) == (2, len(text))
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_nothing_swallows_import_errors():
    root = Path(entry.__file__).parent
    for path in [root / "corpus_pipeline.py", *(root / "millrace" / "llm").glob("*.py")]:
        assert not re.search(r"except\s+(ImportError|ModuleNotFoundError)|localCheckpoint|crossJoin", path.read_text())
