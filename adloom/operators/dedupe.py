"""One row per key. All forms combine on the map side, so a key that holds a
large share of the rows shrinks to one row per task before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.joins import fits_broadcast
from adloom.storage import materialize


def latest_row(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values. Remaining ties go to the
    greatest row, so the outcome does not depend on row order."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    unordered = [c for c in rest if "map<" in df.schema[c].dataType.simpleString()]
    ranked = F.struct(*order_by, *[c for c in rest if c not in unordered])
    if unordered:  # maps cannot be compared, so they ride along
        best = F.max_by(F.struct(*order_by, *rest), ranked)
    else:
        best = F.max(ranked)
    picked = df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")
    return picked.select(*df.columns)


def merge_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Per column, the known value of the latest row that has one: a reproducible
    choice among the values that "any known value of the group" allows.

    The keys are counted first, without any other column. Rows whose key occurs once are
    what they should be and go through as they are, neither sorted nor exchanged; only the
    others are compared. ``df`` is read twice, the first time for its keys alone.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = materialize(repeated.select(*(F.col(k).alias(f"_{k}") for k in keys)), "repeated-keys")
    if repeated.isEmpty():
        return df.select(*keys, *[c for c in df.columns if c not in keys])
    if not fits_broadcast(repeated):
        return _merged(df, keys, order_by)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    several = _merged(df.join(F.broadcast(repeated), same, "left_semi"), keys, order_by)
    return df.join(F.broadcast(repeated), same, "left_anti").select(*several.columns).unionAll(several)


def _merged(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]

    order = [F.col(c).alias(f"_{i}") for i, c in enumerate(order_by)]

    def pick(column: str):
        # The value is the last part of what is compared, so it travels once.
        ranked = F.struct(*order, F.col(column).alias("value"))
        if "map<" in df.schema[column].dataType.simpleString():  # maps cannot be compared
            best = F.max_by(ranked, F.when(F.col(column).isNotNull(), F.struct(*order)))
        else:
            best = F.max(F.when(F.col(column).isNotNull(), ranked))
        return best["value"].alias(column)

    return df.groupBy(*keys).agg(*[pick(c) for c in rest])


def page_versions(html: DataFrame) -> DataFrame:
    """One row per page version, named by ``html_hash``; rows without id or HTML are
    dropped. Rows are dealt by id, which a join on the id uses again, and grouped by
    the hash, not by the page."""
    known = html.where(F.col("html_main").isNotNull() & F.col("id").isNotNull())
    return (
        known.withColumn("html_hash", F.sha2("html_main", 256))
        .repartition("id")
        .groupBy("id", "html_hash")
        .agg(F.first("html_main").alias("html_main"), F.min("ingestion_ts").alias("ingestion_ts"))
    )


def dedupe_html(html: DataFrame) -> DataFrame:
    return page_versions(html).select("html_main", "id", "ingestion_ts")


def dedupe_urls(urls: DataFrame) -> DataFrame:
    """One row per ad and URL: earliest times and the first known occupation."""
    first_seen = F.when(F.col("occupation").isNotNull(), F.struct("ingeston_ts", "occupation"))
    return (
        urls.where(F.col("id").isNotNull() & F.col("canonical_url").isNotNull())
        .groupBy("id", "canonical_url")
        .agg(
            F.min("timestamp").alias("timestamp"),
            F.min_by("occupation", first_seen).alias("occupation"),
            F.min("ingeston_ts").alias("ingeston_ts_url"),
        )
    )
