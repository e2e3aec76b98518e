"""The registered queries of the subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, decontam, infill, langid, minhash, neighbours, pieces, repair, shards, simhash, substring, tokencount, toxic
from millrace.llm.common import remainder, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(remainder("doc_id", 3) != 1))
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: A conversation whose texts hold all that the template escapes.
AWKWARD = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string"))
    # a list of turns is a tree of one branch, which ranks first
    written = chat.conversations(chat.replies(rows).withColumn("score", F.lit(0.0)), branches=1)
    return chat.digests(written).drop("leaf").withColumnRenamed("tree", "conv_id")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_digests(table(spark, sf_dir, "documents"))


def toxicity_scorer(spark: SparkSession, sf_dir: str) -> toxic.Scorer:
    """Trained on the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxic.train(docs, labels.where(remainder("doc_id", 5) != 0))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxic.score(table(spark, sf_dir, "documents"), toxicity_scorer(spark, sf_dir))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("score"), "predicted")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.infilled(table(spark, sf_dir, "documents")))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_language": op2_language,
    "op3_neighbours": op3_neighbours,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_chat": op7_chat,
    "op8_substring": op8_substring,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
    "op11_minhash": op11_minhash,
    "op12_infill": op12_infill,
    "op13_repair": op13_repair,
}
SQL: dict[str, str] = {"op10_sharding": shards.SQL, "op12_infill": infill.SQL}
