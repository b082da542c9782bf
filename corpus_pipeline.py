"""From raw documents to token id files: every stage takes what the one before kept.

    python -c "import corpus_pipeline"   # STAGES, run(spark, sf_dir), ORACLE_SQL
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adloom.llm import decontaminate, mixing, near_dup, token_ids, toxicity
from adloom.llm.batches import prepared
from adloom.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the documents given; rows scored 0.5 or more go."""
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    prepared(spark)
    return near_dup.one_of_each_group(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, prepared(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the source, language and topic targets."""
    prepared(spark)
    return mixing.sample(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed id files in the shared folder; returns where each document's ids are."""
    return token_ids.token_file_table(prepared(spark), docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_files),
]

# Viterbi decoding, band hashing and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
