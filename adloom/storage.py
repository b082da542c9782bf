"""Shared scratch space and materialisation.

Everything written between stages goes to the folder named by
``spark.checkpoint.dir``, which every executor can reach, so a lost executor
never takes intermediate data with it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        # A single machine (tests, bench): the local disk is the shared folder.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="adloom-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/adloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage is cut, and later readers
    still prune columns and push filters into the scan."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
