"""Dense surrogate ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.storage import materialize

# The low bits of monotonically_increasing_id count rows inside a partition.
_ROW_BITS = 33


# Positions that one task sums up.
_SUMMED_TOGETHER = 1000


def prefix_sums(sizes: DataFrame, at: str, n: str, start: str) -> DataFrame:
    """(at, start): the sum of ``n`` over all smaller ``at`` (whole numbers, each once).

    Summed in two steps, inside groups of neighbours and over the groups; the plan is the
    same whatever the number of positions.
    """
    grouped = sizes.withColumn("_group", F.floor(F.col(at) / _SUMMED_TOGETHER))
    groups = grouped.groupBy("_group").agg(F.sum(n).alias("_sum"))
    # One task sees one row per group: a thousandth of the positions.
    before = Window.partitionBy(F.pmod("_group", F.lit(1))).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_group").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.select(at, "_group", F.coalesce(F.sum(n).over(inside), F.lit(0)).alias("_within"))
    return within.join(groups, "_group").select(at, (F.col("_base") + F.col("_within")).alias(start))


def dense_ids(df: DataFrame, order_by: list[str], id_col: str = "id") -> DataFrame:
    """``row_number() over (order by ...)`` over a whole table, NULLs last.

    The rows are range-partitioned and sorted, written once together with their
    partition and their position in it, and numbered by adding the sizes of the
    partitions before. Writing first matters: range boundaries come from a
    sample, so counting and numbering must see the very same partitions. Name
    enough columns in ``order_by`` to split values that repeat very often.
    """
    keys = [F.col(c).asc_nulls_last() for c in order_by]
    placed = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))),
        "dense-ids",
    )
    # One row per task of the sort: spark.sql.shuffle.partitions bounds what is broadcast.
    starts = F.broadcast(prefix_sums(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_part", "_n", "_start"))
    number = F.col("_start") + F.col("_pos") + F.lit(1)
    return placed.join(starts, "_part").select(number.alias(id_col), *df.columns)
