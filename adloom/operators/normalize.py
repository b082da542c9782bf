"""Raw search documents to bronze metadata rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.values import category_name, epoch_ms, epoch_ms_or_null, month_of, year_of
from adloom.operators.flatten import ensure_columns, expand_struct, explode_docs, flatten_category
from adloom.schemas import NESTED_COLUMNS, REDUNDANT_COLUMNS


def _epoch(df: DataFrame, column: str, lenient: bool = False) -> DataFrame:
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    convert = epoch_ms_or_null if lenient else epoch_ms
    return df.withColumn(column, convert(F.col(column)))


def normalize_common(df: DataFrame) -> DataFrame:
    """What every category shares: coordinates, dropped columns, dates, y/m, audit time.

    A missing timestamp leaves ``y`` and ``m`` NULL.
    """
    df = expand_struct(df, "coordinates", drop=True).drop(*REDUNDANT_COLUMNS)
    df = ensure_columns(df, {"timestamp": "timestamp", "published": "timestamp"})
    for column in ("timestamp", "published"):
        df = _epoch(df, column)
    return df.withColumns(
        {
            "y": year_of(F.col("timestamp")),
            "m": month_of(F.col("timestamp")),
            "ingestion_ts": F.current_timestamp(),
        }
    )


def normalize_category(df: DataFrame, category: str) -> DataFrame:
    if category not in NESTED_COLUMNS:
        raise ValueError(f"unknown category: {category}")
    df = normalize_common(df)
    for column in NESTED_COLUMNS[category]:
        df = expand_struct(df, column, drop=True)
    if category == "job_fulltime":
        df = _epoch(ensure_columns(df, {"deadline": "timestamp"}), "deadline", lenient=True)
    if isinstance(df.schema["id"].dataType, T.StringType):
        df = df.withColumn("id", F.col("id").try_cast("bigint"))
    return df


def normalize_search_key(df: DataFrame, search_key: str) -> DataFrame:
    return normalize_category(df, category_name(search_key))


def bronze_metadata(payloads: DataFrame, category: str, keep_nested: bool = False) -> DataFrame:
    """Payloads of one category as bronze rows.

    ``keep_nested=False`` drops images, labels and flags and partitions by ``y, m``.
    ``keep_nested=True`` keeps every field, typed, and partitions by ``_y, _m``.
    Payloads with undeclared fields get ``source_doc`` too, a document's place in its list.
    """
    docs = explode_docs(payloads)
    if "_other" in payloads.columns:
        # Undeclared fields stand at the same place of their own list.
        carried = [c for c in payloads.columns if c not in ("docs", "metadata", "_other")]
        pairs = F.posexplode(F.arrays_zip("docs", "_other")).alias("source_doc", "_d")
        docs = payloads.select(pairs, *carried).select(
            F.col("_d.docs").alias("doc"), *carried, "source_doc", F.col("_d._other").alias("other")
        )
    if keep_nested:
        flat = flatten_category(docs, category)
        return flat.withColumns(
            {
                "_y": year_of(F.col("timestamp")),
                "_m": month_of(F.col("timestamp")),
                "ingestion_ts": F.current_timestamp(),
            }
        )
    carried = [c for c in docs.columns if c != "doc"]
    return normalize_category(docs.select("doc.*", *carried), category)


def select_categories(df: DataFrame, column: str, selected: list[str]) -> DataFrame:
    return df.where(F.col(column).isin(selected))


def published_on(df: DataFrame, flag: str, run_date: str, column: str = "published") -> DataFrame:
    """``flag`` ``1`` keeps the documents published on ``run_date``; empty keeps all."""
    return df.where(F.to_date(column) == F.lit(run_date).cast("date")) if flag else df
