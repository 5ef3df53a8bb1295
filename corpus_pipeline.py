"""Documents to packed training sequences, one operator a stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.llm import decontaminate, exact_dedup, jaccard_join, language, packing
from lexiframe.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go; the model learns from the labelled rows."""
    model = language.fit(docs.filter(~language.held_out()))
    told = language.identify(docs, model)
    return told.filter(~F.col("rejected")).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, one row with the largest id stays."""
    return exact_dedup.drop_copies(docs, one_each=True).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links connect, the one with the smallest id stays. Links have
    0.8 or more of their runs of five words in common."""
    return jaccard_join.drop_near_copies(docs, shingle=5, percent=80).select(*COLUMNS)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, all others stay as they are."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its sequence and its place there."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", keep_known_languages),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned language model nor the tokenizer; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
