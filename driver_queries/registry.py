"""Where the query modules register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[name] = configured
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """For CPU-heavy work on a table that is one small file: its rows are dealt over all
    cores, whatever number of splits it has."""
    return load(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism, key)
