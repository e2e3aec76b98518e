"""From raw documents to token digests: five stages, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, pieces, simhash, substring, toxic
from millrace.llm.common import remainder, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; trained on the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scorer = toxic.train(docs.select("doc_id", "text"), labels.where(remainder("doc_id", 5) != 0))
    return toxic.without_toxic(docs, scorer)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document of the smallest id."""
    return simhash.without_copies(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words and more that an earlier one holds."""
    cut = substring.without_repeats(docs)
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of each document, as digests."""
    return pieces.round_trip(docs, forget=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_copies),
    ("substring", cut_passages),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_and_decode),
]

#: No stage can be SQL; the tests hold each one against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
