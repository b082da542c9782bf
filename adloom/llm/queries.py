"""One registered query for each operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import (
    chat,
    decontaminate,
    fingerprints,
    lexical,
    licences,
    mixing,
    near_dup,
    piece_counts,
    secrets,
    token_ids,
    toxicity,
    warc,
    whitening,
)
from adloom.llm.batches import prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = lambda spark, sf_dir: run(prepared(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_licences", licences.oracle())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(licences.laid_out(load(spark, sf_dir, "documents")))


@query("op2_warc", warc.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, load(spark, sf_dir, "pages"))


@query("op3_lz_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(load(spark, sf_dir, "documents"))


@query("op4_near_dup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(load(spark, sf_dir, "documents"))


@query("op5_token_ids")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_file_table(spark, load(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


@query("op7_piece_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.piece_counts(load(spark, sf_dir, "documents"))


@query("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op9_mixing", mixing.oracle())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(load(spark, sf_dir, "documents"))


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(load(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


@query("op12_lexical", lexical.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op13_chat", chat.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_conversations(load(spark, sf_dir, "conversations"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
