"""Bronze, snapshot, file and relational writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adloom.functions.values import split_table_name
from adloom.operators.quality import assert_primary_key, assert_unique, conform
from adloom.schemas import EXPORT_INDEXES, EXPORT_TABLES, EXPORT_UNIQUE
from adloom.sources.readers import CSV_OPTIONS


def append_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("y", "m")) -> None:
    """Append zstd parquet below partition folders.

    REBALANCE brings the rows of a partition together so that few files are
    written, and splits a partition that holds much of the data over many tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, by: tuple[str, ...] = ("y", "m")) -> None:
    """Overwrite only the partitions that ``df`` touches."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def rebuild(df: DataFrame, path: str, by: tuple[str, ...] = ("y", "m"), full_refresh: bool = True) -> None:
    """Full rebuild, or only the touched partitions."""
    if not full_refresh:
        return replace_partitions(df, path, by)
    df.hint("rebalance", *by).write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "zstd").parquet(path)


def snapshot(df: DataFrame, root: str, table_fqn: str) -> str:
    """Replace the snapshot of one table; returns where it is."""
    path = f"{root.rstrip('/')}/{split_table_name(table_fqn)[1]}.zst.parquet"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def write_json(df: DataFrame, path: str, gzip: bool = False) -> None:
    """``gzip`` at its fastest level: payloads are written and read once, and compressing
    them harder takes longer than making them."""
    writer = df.write.mode("append")
    (writer.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}) if gzip else writer).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(**CSV_OPTIONS).csv(path)


def replace_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create-or-replace a table from a query."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, path: str, name: str, by: str, buckets: int) -> DataFrame:
    """Replace the table ``name`` at ``path``, dealt by the hash of ``by`` into ``buckets``
    files. Tables of the same number of buckets are joined, and grouped, by that column
    without an exchange. One task writes one bucket: no key may hold much of the table."""
    writer = df.repartition(buckets, by).write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, name: str, by: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed`` in a session whose catalog does not know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet "
        f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def export_frame(df: DataFrame, table: str) -> DataFrame:
    """Rows as the relational table declares them. Ids of dimensions must be a
    primary key and their values unique."""
    frame = conform(df, EXPORT_TABLES[table])
    if table in EXPORT_UNIQUE:
        assert_primary_key(frame, ["id"])
        for column in EXPORT_UNIQUE[table]:
            assert_unique(frame, [column])
    return frame


def jdbc_column_types(table: str) -> str:
    """Column types for the writer; text and timestamps as the target names them."""
    # Spark type -> relational type.
    names = {T.IntegerType(): "INTEGER", T.LongType(): "BIGINT", T.StringType(): "TEXT", T.TimestampType(): "TIMESTAMP"}
    fields = T.StructType.fromDDL(EXPORT_TABLES[table]).fields
    return ", ".join(f"{f.name} {names[f.dataType]}" for f in fields)


def key_statements(table: str) -> list[str]:
    """Constraints to add after a load, in the order to run them."""
    if table not in EXPORT_UNIQUE:
        return []
    keys = [f"ALTER TABLE {table} ADD CONSTRAINT pk_{table} PRIMARY KEY (id)"]
    return keys + [f"ALTER TABLE {table} ADD CONSTRAINT uq_{table}_{c} UNIQUE ({c})" for c in EXPORT_UNIQUE[table]]


def index_statements(table: str) -> list[str]:
    """DDL to run on the target after a load; Spark's writer creates no indexes."""
    return [f"CREATE INDEX IF NOT EXISTS idx_{table}_{c} ON {table} ({c})" for c in EXPORT_INDEXES.get(table, [])]


def export_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    truncate: bool = False,
    batch_size: int = 10_000,
    connections: int = 32,
) -> None:
    """Drop (or truncate), create and fill one relational table. ``connections``
    bounds the parallel writers, not the rows."""
    (
        export_frame(df, table)
        .write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=table, **(properties or {}))
        .option("truncate", str(truncate).lower())
        .option("createTableColumnTypes", jdbc_column_types(table))
        .option("batchsize", str(batch_size))
        .option("numPartitions", str(connections))
        .save()
    )
