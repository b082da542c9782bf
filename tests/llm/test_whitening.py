import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adloom.llm.singular import bidiagonalise, leading_directions, singular_values
from adloom.llm.whitening import whiten

RNG = np.random.default_rng(3)


def _with_values(values):
    size = len(values)
    left, right = (np.linalg.qr(RNG.normal(size=(size, size)))[0] for _ in range(2))
    return left @ np.diag(values) @ right


MATRICES = {
    "one": np.array([[2.0]]),
    "random": RNG.normal(size=(64, 64)),
    "identity": np.eye(8),
    "zero": np.zeros((5, 5)),
    "ones": np.ones((6, 6)),
    "zeros on the diagonal": np.diag([3.0, 0, 2, 0, 1, 1]),
    "rank 3": RNG.normal(size=(40, 3)) @ RNG.normal(size=(3, 40)),
    "six equal values": _with_values(np.r_[np.full(6, 5.0), np.linspace(1, 0.1, 30)]),
    "close values": _with_values(np.r_[5 + 1e-9 * np.arange(6), np.linspace(1, 0.1, 30)]),
    "graded": _with_values(10.0 ** -np.arange(30)),
    "graded upwards": np.diag(10.0 ** np.linspace(-8, 0, 30)) @ np.triu(RNG.normal(size=(30, 30))),
}


@pytest.mark.parametrize("name", MATRICES)
def test_singular(name):
    matrix = MATRICES[name]
    exact = np.linalg.svd(matrix, compute_uv=False)
    diagonal, above, _ = bidiagonalise(matrix)
    top = max(exact[0], 1e-300)
    assert np.abs(singular_values(diagonal, above) - exact).max() <= 1e-14 * top
    values, vectors = leading_directions(matrix, 4)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    for value, vector in zip(values, vectors.T, strict=True):
        assert np.linalg.norm(matrix.T @ (matrix @ vector) - value**2 * vector) <= 1e-13 * top**2


def test_small_values_to_relative_accuracy():
    above = np.full(29, 1e-3)
    diagonal = 10.0 ** -np.linspace(0, 12, 30)
    above *= diagonal[1:]
    got = singular_values(diagonal, above)
    # The product of all values is that of the diagonal, which holds digit by digit.
    assert math.isclose(np.log(got).sum(), np.log(diagonal).sum(), rel_tol=1e-12)


def brute(rows):
    kept = [(i, [math.floor(float(c) * 256) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    x = np.array(distinct, float)
    centred = x - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:4]
    out = {}
    for i, row in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))
        w = (np.array(row) - np.array(sums) / n) @ vectors[:, order] / np.sqrt(values[order])
        out[i] = (n, deviation, w, values[order] / values.sum())
    return out


def test_whole_table_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = brute([(r.vec_id, r.embedding) for r in table.collect()])
    got = whiten(table.repartition(40)).collect()
    assert len(got) == 4 * len(expected)
    signs = {}
    for r in got:
        n, deviation, w, explained = expected[r.vec_id]
        c = r.component - 1
        assert (r.n, r.deviation) == (n, deviation) and math.isclose(r.explained, explained[c], rel_tol=1e-9)
        sign = signs.setdefault(c, 1 if r.whitened * w[c] > 0 else -1)
        assert abs(r.whitened - sign * w[c]) < 1e-7 and r.identity_error < 1e-9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, [nan, 1.0]), (4, [1.0, None]), (5, [-inf, 0.0]), (None, [-0.0, 1.0]), (6, [0.001, -0.001])]
    table = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], "vec_id long, embedding array<float>, n string, component int, _x int")
    got = whiten(table).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["1", "1", "None", "6"] * 2)
    assert {r.n for r in got} == {3}
    fit = [(128, 64), (0, 256), (0, -1)]
    sums = [sum(c) for c in zip(*fit, strict=True)]
    one = next(r for r in got if r.vec_id == 6)
    assert one.deviation == sum((3 * c - s) ** 2 for c, s in zip(fit[2], sums, strict=True))
    assert sum({r.component: r.explained for r in got}.values()) == pytest.approx(1)


def test_no_variance_short_and_huge_vectors(spark):
    ddl = "vec_id long, embedding array<double>"
    assert whiten(spark.createDataFrame([], ddl)).count() == 0
    assert whiten(spark.createDataFrame([(1, [])], ddl)).count() == 0
    same = whiten(spark.createDataFrame([(1, [0.5]), (2, [0.5])], ddl)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None)] * 2
    # [1] counts as [1, 0].
    short = whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], ddl)).collect()
    assert {r.n for r in short} == {2} and len(short) == 6
    assert all((r.whitened is None) == (r.component == 2) for r in short)
    huge = whiten(spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 5.0])], ddl)).collect()
    assert len(huge) == 6 and all(r.deviation is None for r in huge if r.vec_id < 3)


def test_repeated_vectors_do_not_weigh(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    more = table.unionAll(table.where("vec_id = 7").crossJoin(spark.range(300)).drop("id"))
    a = {(r.vec_id, r.component): r for r in whiten(table).collect()}
    for r in whiten(more).where(F.col("vec_id") != 7).collect():
        known = a[r.vec_id, r.component]
        assert (r.n, r.deviation) == (known.n, known.deviation) and abs(r.whitened - known.whitened) < 1e-9
