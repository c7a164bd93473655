"""From raw documents to packed training sequences, as five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a table, which is
written as Parquet and read again as the next one's ``docs``. All but the last keep the columns of
``documents``; n_chars follows the text. Rows with null or empty texts pass every stage but the
duplicates of each other, and an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarframe.llm import mixing, packing, simhash, substrings, toxicity
from lidarframe.llm.common import new_path, table

MAX_REPEATS = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents at or above the threshold; the lexicon is learned from all of their labels."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of linked fingerprints.

    Links are op9's three bits; most near copies by five-word shingles differ in more and stay (README).
    """
    return simhash.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out of all documents but the first that has them."""
    found = substrings.remove_repeats(docs).drop("removed_spans")
    count = F.when(F.col("n_chars").isNotNull() | F.col("text").isNotNull(), F.char_length("text"))
    return found.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, small sources up to MAX_REPEATS times, as even as that allows."""
    return mixing.mix(docs, max_repeats=MAX_REPEATS).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", one_of_near_copies),
    ("substrings", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Tokens, fingerprints and learned scores are beyond SQL: tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
