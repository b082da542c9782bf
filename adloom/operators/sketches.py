"""Distinct counts that can be stored and merged.

A count of distinct values cannot be added up over months; a sketch of the values can.
Sketches are stored per period and merged for any range, without the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^16 registers: a standard error of 0.4 %.
LOG_REGISTERS = 16


def period_sketches(rows: DataFrame, by: list[str], values: dict[str, Column]) -> DataFrame:
    """Per period ``by``: ``rows`` counted and a sketch of each of ``values`` (name -> a
    column of numbers or text). Sketches combine before the shuffle. NULL is no value."""
    sketches = [F.hll_sketch_agg(value, F.lit(LOG_REGISTERS)).alias(name) for name, value in values.items()]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merged_counts(sketches: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """``rows`` and the estimated distinct values of each name over all stored periods given,
    per ``by`` if there is one. No periods have no rows and no values."""
    estimates = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(name) for name in names]
    return sketches.groupBy(*(by or [])).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *estimates)
