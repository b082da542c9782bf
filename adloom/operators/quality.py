"""Checks to run before rows leave for a relational table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityError(ValueError):
    pass


def assert_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise QualityError(f"missing columns: {', '.join(missing)}")
    return df


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. As in SQL, a NULL equals no other NULL."""
    known = df
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    example = duplicate_keys(df, keys).first()
    if example is not None:
        raise QualityError(f"duplicate key in {keys}: {example.asDict()}")
    return df


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def assert_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    found = {c: n for c, n in null_counts(df, columns).first().asDict().items() if n}
    if found:
        raise QualityError(f"NULL in required columns: {found}")
    return df


def assert_primary_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return assert_unique(assert_not_null(df, keys), keys)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns, order, types and nullability of a declared table. Required columns
    are checked, missing optional ones become NULL."""
    schema = T.StructType.fromDDL(ddl)
    required = [f.name for f in schema.fields if not f.nullable]
    assert_columns(df, required)
    if required:
        assert_not_null(df, required)
    typed = df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    return typed.select(
        *[F.col(f"`{f.name}`") if f.nullable else _never_null(f).alias(f.name) for f in schema.fields]
    )


def _never_null(field: T.StructField) -> Column:
    """The column, failing on a NULL that only the cast produced. The last value is
    never reached; it tells Spark that the result cannot be NULL."""
    col = F.col(f"`{field.name}`")
    checked = F.when(col.isNull(), F.raise_error(F.lit(f"NULL in {field.name}"))).otherwise(col)
    blank = F.lit("") if isinstance(field.dataType, T.StringType) else F.lit(0)
    return F.coalesce(checked, blank.cast(field.dataType))
