"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.storage import materialize

# A side is broadcast only when measured to be below both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A heavy key is split into cells of about this many rows.
ROWS_PER_CELL = 500_000
# Rows whose key is NULL match nothing; they are spread over so many cells.
NULL_CELLS = 4096


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a join side before it may be broadcast: one combined row per task."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(8)) for c in df.columns), F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return size.n <= max_rows and size.b <= max_bytes


def shuffled(df: DataFrame) -> DataFrame:
    """A join side that was not measured, or is not small. Spark would guess its size from
    the bytes of the files below it, and broadcast millions of rows that compress well or
    that a list is still to be exploded to."""
    return df.hint("merge")


def heavy_keys(df: DataFrame, on: list[str], rows_per_cell: int = ROWS_PER_CELL) -> DataFrame | None:
    """Every key with more than ``rows_per_cell`` rows and how many cells to split it
    into, or None when there is none.

    Counting combines on the map side. There are at most rows / rows_per_cell such
    keys; they stay a table, broadcast only when measured to be small.
    """
    known = df
    for column in on:
        known = known.where(F.col(column).isNotNull())
    counts = known.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_cell)
    heavy = materialize(counts.select(*on, F.ceil(F.col("_n") / rows_per_cell).cast("int").alias("_cells")), "heavy-keys")
    if heavy.isEmpty():
        return None
    return F.broadcast(heavy) if fits_broadcast(heavy) else heavy


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str,
    spread_by: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    condition: Column | None = None,
) -> DataFrame:
    """Shuffle join in which each heavy key of ``facts`` is split into cells and
    the matching ``lookup`` rows are repeated once per cell. Exact for inner,
    left, left_semi and left_anti.

    The cell comes from a hash of the row, not from a random number, so a task
    that is run again puts its rows where they were before. Rows whose key is
    NULL match nothing and are spread over all cells.
    """
    spread = F.xxhash64(*(spread_by or facts.columns))
    null_key = F.lit(False)
    for column in on:
        null_key = null_key | F.col(column).isNull()
    heavy = heavy_keys(facts, on, rows_per_cell)
    if heavy is None:
        cells: Column = F.lit(1)
        # Computed, not a literal: a literal would be folded out of the join keys.
        left, right = facts, lookup.withColumn("_cell", F.pmod(F.xxhash64(*on), F.lit(1)).cast("int"))
    else:
        cells = F.coalesce(F.col("_cells"), F.lit(1))
        left = facts.join(heavy, on, "left")
        right = (
            lookup.join(heavy, on, "left")
            .withColumn("_cell", F.explode(F.sequence(F.lit(0), cells - 1)))
            .drop("_cells")
        )
    left = left.withColumn(
        "_cell",
        F.when(null_key, F.pmod(spread, F.lit(NULL_CELLS))).otherwise(F.pmod(spread, cells)).cast("int"),
    ).drop("_cells")
    keys = [*on, "_cell"]
    if condition is None:
        return left.join(shuffled(right), keys, how).drop("_cell")
    matched = left.alias("f").join(
        shuffled(right.alias("l")),
        [F.col(f"f.{k}") == F.col(f"l.{k}") for k in keys] + [condition],
        how,
    )
    kept = [F.col(f"f.{c}") for c in facts.columns]
    if how not in ("left_semi", "left_anti"):
        kept += [F.col(f"l.{c}") for c in lookup.columns if c not in on]
    return matched.select(*kept)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join to a dimension: broadcast when it is measured to be small, salted
    shuffle otherwise. ``facts`` may be read twice (heavy keys are counted first),
    so pass a table or something as cheap as one.
    """
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), on, how)
    return salted_join(facts, lookup, on, how, spread_by)
