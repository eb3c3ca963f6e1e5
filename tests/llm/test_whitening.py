"""Whitening against dense linear algebra and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kontora.llm import whitening

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("spectrum", [[5, 4, 3, 2, 1, 0.5], [3, 3, 3, 1, 1, 0], [1, 1 + 1e-13, 1 + 1e-9, 1 - 1e-7, 1e-6, 0], [0] * 6, [7] * 6])
def test_leading_pairs(spectrum):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((6, 6)))[0]
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading(a, 5)
    want = sorted((s for s in spectrum if s > 0), reverse=True)[:5]
    assert np.allclose(values, want, rtol=1e-9, atol=1e-15)
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max(initial=0) < 1e-12
    assert np.abs(a @ vectors - vectors * values).max(initial=0) < 1e-12
    if any(spectrum):
        assert [whitening.above(a, t) for t in (-1, 0.7, 2.5, 9)] == [sum(s > t for s in spectrum) for t in (-1, 0.7, 2.5, 9)]


def brute(vectors):
    """All columns of the report by whole-matrix arithmetic."""
    x = np.array([[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    d = np.array((n * x - s) / n, float)
    v = d.T @ d / n
    e, u = np.linalg.eigh(v)
    return n, deviation, d, v, e[::-1], u[:, ::-1]


def test_report_equals_dense_algebra(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = whitening.report(table.repartition(5)).toPandas()
    rows = table.toPandas()
    n, deviation, d, v, e, u = brute(rows.embedding)
    assert len(got) == n * 32 and set(got.n) == {n} and got.identity_error.max() < 1e-9
    assert dict(zip(got.vec_id, got.deviation)) == dict(zip(rows.vec_id, deviation))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows.vec_id].to_numpy()
    want = d @ u[:, :32] / np.sqrt(e[:32])
    want *= np.sign((want * wide).sum(axis=0))
    assert np.abs(wide - want).max() < 1e-7
    assert np.allclose(got.groupby("component").explained.first(), e[:32] / np.trace(v), rtol=1e-9)
    again = whitening.report(table.repartition(3)).toPandas().set_index(["vec_id", "component"]).whitened
    assert (again.sort_index() == got.set_index(["vec_id", "component"]).whitened.sort_index()).all()


def test_odd_vectors(spark):
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0], [1.0, 2.0]]
    good = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [2.0, 0.5, -3.25], [1e5, 2.0, 0.0], [-1.0, 7.0, 1.0]]
    rows = [(None if i == 1 else i, v, i) for i, v in enumerate([*odd, *good])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    got = whitening.report(docs).collect()
    n, deviation, *_, e, _ = brute(good)
    assert len(got) == 5 * 3 and {r.n for r in got} == {n} and sorted({r.deviation for r in got}) == sorted(set(deviation))
    assert max(r.identity_error for r in got) < 1e-6
    assert whitening.report(docs.limit(0)).collect() == []
    assert whitening.report(docs.filter(F.col("component") < 3)).collect() == []
    assert whitening.report(docs.filter(F.col("component") == 8)).collect() == []  # one vector has no variance
    huge = spark.createDataFrame([(i, [float((i * 7 + k) % 5) * 1e15 for k in range(3)]) for i in range(9)], "vec_id long, embedding array<double>")
    assert all(r.deviation is None for r in whitening.report(huge).collect())
