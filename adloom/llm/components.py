"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.operators.joins import lookup_join
from adloom.storage import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0)).alias("h")).first()
    return row.n, row.h


def _with(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """Every edge with what is known of its node; a node with very many edges is split."""
    return lookup_join(edges, smallest, ["a"], "inner", spread_by=["b"])


def star_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that
    can be reached.

    Alternates two steps until the edges stay the same: every node links its larger
    neighbours to its smallest one, then its smaller neighbours. Edges never get
    more than they were; the minima are combined before the shuffle, and the edges of a
    hot node meet theirs where they lie or in cells. Every pass is written to the shared folder, so the lineage
    stays one pass long. No edges give no rows.
    """
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(now)
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _with(both, materialize(least, "least")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large")
        # After the first step every edge points down: a is larger than b.
        smallest = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "smallest")
        small = (
            _with(large, smallest)
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        now = materialize(small, "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
