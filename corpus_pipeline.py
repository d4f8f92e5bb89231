"""The corpus pipeline: quality, line dedup, near-dedup, mixing, packing.

Each stage works on all rows that the stage before kept.  ``run`` writes each
stage's result to the shared folder and reads it again, so a lost executor
costs a part of one stage at most.  All stages but the last return the columns
of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripstats.llm import dartminhash, linededup, mixing, packing, quality
from tripstats.llm.queries import vocabulary
from tripstats.llm.shared import stored

# Every document is taken once at most, so that ids stay unique for packing; four fifths of the tokens that
# are left are the budget, shared out by the weights of the registered mixing query.
PIPELINE_MIX = mixing.Mix(budget_share=0.8, max_epochs=1)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules fail or the weak-supervision model finds likelier bad than good."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that three or more documents share, but for the last document with them."""
    return linededup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return dartminhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents up to the token budget of each domain, language and source."""
    return mixing.take_mixture(docs, PIPELINE_MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of at most 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Signatures, the fitted quality model and subword tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
