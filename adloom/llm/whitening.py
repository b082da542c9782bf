"""Whitening of embeddings along their leading principal directions.

Every entry c becomes the whole number floor(256 c). The distinct vectors are the fit
list: their count and sums are exact, blocks of their centred rows are reduced by QR,
first inside each task, then the triangular factors 32 at a time, until one factor R
of dimension x dimension stands for all rows. Its singular values and directions
(``singular``) are those of the centred rows. A last pass projects every row.

Only counts, sums and R, whose sizes depend on the dimension alone, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.singular import leading_directions
from adloom.storage import materialize

# Triangular factors that one task reduces to one.
FAN_IN = 32
# Bytes of centred rows reduced at a time.
BLOCK_BYTES = 8 << 20
# Products below this stay exact in 64-bit integers.
_SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: n vectors, their sums, directions as columns and the
    variance along each; ``trace`` is the sum of all variances."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows minus the mean; the difference is formed in whole numbers where these fit."""
        sums = np.array(self.sums, dtype=object)
        if _largest(x) * self.n + max(map(abs, self.sums), default=0) < _SAFE:
            return (x * self.n - sums.astype(np.int64)) / float(self.n)
        return ((x.astype(object) * self.n - sums) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN along directions without variance."""
        scale = np.where(self.variances > 0, np.sqrt(self.variances), np.nan)
        return self.centred(x) @ self.directions / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        n, most = self.n, _largest(x)
        if not x.shape[1]:
            return [0] * len(x)
        sums = np.array(self.sums, dtype=object)
        largest = max(map(abs, self.sums))
        wide = x.astype(object) if most * max(most, largest) * x.shape[1] >= _SAFE else x
        by = sums if wide.dtype == object else sums.astype(np.int64)
        squares, crossed, constant = (wide * wide).sum(axis=1), (wide * by).sum(axis=1), sum(int(s) ** 2 for s in self.sums)
        totals = (n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(squares, crossed, strict=True))
        return [t if t < 1 << 63 else None for t in totals]


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _matrix(column, width: int) -> np.ndarray:
    """A list column of whole numbers as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    rows = np.zeros((len(column), width), np.int64)
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def quantised(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """``vectors`` without those that are null or hold null or non-finite entries, with
    the whole numbers as ``_x``. Entries beyond 2^55 stop at the ends of 64 bits."""
    entries = F.col(f"`{vector_col}`")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    kept = vectors.where(entries.isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.withColumn("_x", F.transform(entries, lambda c: F.floor(c.cast("double") * 256)))


def _sums(fit: DataFrame, width: int) -> tuple[int, ...]:
    """Exact sums of every dimension: whole numbers in two halves inside a task, decimals
    between tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        totals = [(int(h) << 32) + int(lo) for h, lo in zip(high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(totals, pa.decimal128(38, 0))], names=["at", "total"])

    found = fit.mapInArrow(run, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).collect()
    sums = {r["at"]: int(r["total"]) for r in found}
    return tuple(sums.get(i, 0) for i in range(width))


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The square upper factor of a stack of rows."""
    factor = np.linalg.qr(rows, mode="r")
    missing = rows.shape[1] - len(factor)
    return np.vstack([factor, np.zeros((missing, rows.shape[1]))]) if missing else factor


def _factor(fit: DataFrame, width: int, model: Whitening) -> np.ndarray:
    """R of the centred fit list."""
    block = max(2 * width, BLOCK_BYTES // (8 * width))

    def reduce_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        factor, held, size = np.zeros((width, width)), [], 0
        for batch in batches:
            held.append(model.centred(_matrix(batch.column(0), width)))
            size += len(held[-1])
            if size >= block:
                factor, held, size = _triangle(np.vstack([factor, *held])), [], 0
        if held:
            factor = _triangle(np.vstack([factor, *held]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([factor.tobytes()], pa.binary())], names=["at", "factor"]
        )

    def reduce_factors(group: pa.Table) -> pa.Table:
        # In the order of the tasks, so that a repeated task gives the same factor.
        group = group.sort_by("at")
        total = np.zeros((width, width))
        for raw in group["factor"].to_pylist():
            total = _triangle(np.vstack([total, np.frombuffer(raw).reshape(width, width)]))
        at = group["at"][0].as_py() // FAN_IN
        return pa.table({"at": pa.array([at], pa.int64()), "factor": pa.array([total.tobytes()], pa.binary())})

    factors = materialize(fit.mapInArrow(reduce_rows, "at long, factor binary"), "factors")
    tasks = factors.agg(F.max("at").alias("last")).first()["last"] or 0
    while True:
        factors = factors.groupBy(F.floor(F.col("at") / FAN_IN)).applyInArrow(reduce_factors, "at long, factor binary")
        tasks //= FAN_IN
        if not tasks:
            break
    left = factors.collect()
    return np.frombuffer(left[0]["factor"]).reshape(width, width) if left else np.zeros((width, width))


def fit_whitening(x: DataFrame, components: int = 4) -> Whitening:
    """The model of the distinct vectors of column ``_x``. Vectors of different lengths
    are filled up with zeros to the longest."""
    fit = materialize(x.select("_x").distinct(), "fit-list")
    sizes = fit.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("_x")).alias("low"), F.max(F.size("_x")).alias("high")).first()
    width = sizes["high"] or 0
    n = sizes["n"]
    if n and sizes["low"] != width:
        filled = F.concat("_x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("_x")))
        fit = materialize(fit.select(filled.alias("_x")).distinct(), "fit-list")
        n = fit.count()
    if not n or not width:
        return Whitening(n, (0,) * width, np.zeros((width, 0)), np.zeros(0), 0.0)
    start = Whitening(n, _sums(fit, width), np.zeros((width, 0)), np.zeros(0), 0.0)
    factor = _factor(fit, width, start)
    values, directions = leading_directions(factor, min(components, width))
    model = Whitening(n, start.sums, directions, values**2 / n, float(np.sum(factor**2)) / n)
    return Whitening(**vars(model) | {"identity_error": _identity_error(fit, width, model)})


def _identity_error(fit: DataFrame, width: int, model: Whitening) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity), over
    the directions that have variance."""
    used = [i for i, v in enumerate(model.variances) if v > 0]
    if not used:
        return None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.whitened(_matrix(batch.column(0), width))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in used], names=[f"w{i}" for i in used])

    whitened = fit.mapInArrow(run, ", ".join(f"w{i} double" for i in used))
    pairs = [(i, j) for i in used for j in used if i <= j]
    row = whitened.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row for
    each usable vector and component; components are numbered from 1 by falling variance.

    Vectors that are null or hold null or non-finite entries give no rows; ids may be
    null or repeat. A vector shorter than the longest counts as having zeros behind it.
    There are at most as many components as dimensions, so empty vectors and empty tables
    give none. Along a component without variance ``whitened`` is null; without any
    variance so is ``explained``, and ``identity_error`` too. ``deviation`` is null where
    it does not fit into 64 bits. Other columns are ignored.
    """
    x = quantised(vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding"))).select("vec_id", "_x")
    model = fit_whitening(x, components)
    width, k = model.directions.shape
    shares = [float(v) / model.trace if model.trace else None for v in model.variances]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1), width)
            values = model.whitened(rows).ravel()
            each = np.repeat(np.arange(len(rows)), k)
            deviation = pa.array(model.deviations(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), model.n, np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array([None if math.isnan(v) else v for v in values.tolist()], pa.float64()),
                    pa.array(shares * len(rows), pa.float64()),
                    pa.array([model.identity_error] * len(each), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = x.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return (x if k else x.limit(0)).mapInArrow(run, out)
