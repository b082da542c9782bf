"""Session settings of the operators that work on Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adloom.session import configure


def prepared(spark: SparkSession) -> SparkSession:
    """Batches of few rows and bytes: a task holds one batch, and what it makes of it."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return spark


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until ``df`` has no such column (in either case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
