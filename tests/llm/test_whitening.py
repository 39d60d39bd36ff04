from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opticlake.llm import whitening
from opticlake.llm.bidiagonal import bidiagonalise, dqds, turn_back, twisted_vectors
from opticlake.llm.catalog import QUERIES, load_all
from opticlake.llm.whitening import whiten

load_all()
SCHEMA = "vec_id long, embedding array<float>, n string, white int"


def run(spark, rows, parts=7, **more):
    frame = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], SCHEMA).repartition(parts)
    return whiten(frame, **more).collect()


def whole(v, scale=64, offset=1_000_000):
    return [math.floor(scale * float(np.float32(x))) + offset for x in v]


def check(found, rows, components=32):
    """Against eigenvectors of the covariance of whole numbers, and the definitions."""
    x = [(i, whole(v)) for i, v in rows]
    n, size = len(x), len(x[0][1])
    sums = [sum(v[d] for _, v in x) for d in range(size)]
    far = {(i, tuple(v)): [n * a - s for a, s in zip(v, sums, strict=True)] for i, v in x}
    centred = np.array([[a / n for a in far[i, tuple(v)]] for i, v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    held = min(components, int((values > 1e-13 * values[0]).sum()))
    assert sorted((str(r["number"]), r["deviation"]) for r in found) == sorted((str(i), sum(a * a for a in far[i, tuple(v)])) for i, v in x)
    white = np.array([r["white"] for r in found])
    assert {len(r["white"]) for r in found} == {held} and {r["n"] for r in found} == {n}
    assert found[0]["explained"] == pytest.approx((values[:held] / values.sum()).tolist(), rel=1e-8)
    covariance = white.T @ white / n - np.outer(white.mean(0), white.mean(0))
    error = np.abs(covariance - np.eye(held)).max()
    assert error < 1e-6 and found[0]["identity_error"] == pytest.approx(error, abs=1e-9)
    if held > 1 and (values[: held - 1] / np.maximum(values[1:held], 1e-300)).min() > 1.0001:
        by = {(r["number"], r["deviation"]): r["white"] for r in found}
        plain = centred @ vectors[:, :held] / np.sqrt(values[:held])
        own = np.array([by[i, sum(a * a for a in far[i, tuple(v)])] for i, v in x])
        assert np.abs(np.abs(own) - np.abs(plain)).max() < 1e-5
        assert np.abs(own * np.sign((own * plain).sum(0)) - plain).max() < 1e-5  # one sign for all rows


def test_equal_to_eigenvectors(spark):
    rng = np.random.default_rng(1)
    turn = rng.normal(size=(48, 48)) * np.linspace(3, 0.2, 48)
    rows = [(i, (rng.normal(size=48) @ turn + 5).tolist()) for i in range(700)]
    check(run(spark, rows), rows)


def test_merging_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5]).tolist()) for i in range(60)]
    check(run(spark, rows, parts=13), rows)


def test_dimensions_without_variance_repeated_rows_and_few_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, *x, x[0], *(2 * y for y in x)]) for i, x in enumerate(rng.integers(-9, 9, (40, 3)).astype(float).tolist())]
    check(run(spark, rows + rows[:10]), rows + rows[:10])
    wide = [(i, rng.normal(size=20).tolist()) for i in range(5)]
    check(run(spark, wide), wide)


def test_equal_eigenvalues(spark):
    rows = [(2 * d + (s > 0), [s * 4.0 * (d == k) for k in range(6)]) for d in range(6) for s in (1, -1)]
    check(run(spark, rows), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=3).tolist()) for i in range(9)] + [(None, [0.1, 0.2, 0.3]), (2, [5.0, 6.0, 7.0])]
    odd = [(20, None), (21, [1.0, None, 2.0]), (22, [float("nan"), 1.0, 2.0]), (23, [float("inf"), 1.0, 2.0]), (24, []), (25, [1.0]), (26, [1e30, 0.0, 0.0])]
    check(run(spark, good + odd), good)
    assert run(spark, []) == [] and run(spark, odd[:2]) == []
    assert run(spark, [(1, [1.0, 2.0])]) == [] and run(spark, [(i, [1.0, 2.0]) for i in range(5)]) == []


def test_values_beyond_a_long(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, -1.0])]
    found = run(spark, rows)
    assert [r["deviation"] for r in found] == [None if r["number"] < 3 else r["deviation"] for r in found]
    assert found[0]["identity_error"] < 1e-4


def test_query(spark):
    rows = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001")
    assert rows.groupBy("vec_id").count().where("count <> 32").isEmpty()
    error, shares = rows.agg(F.max("identity_error"), F.count_distinct("explained")).first()
    assert error < 1e-9 and shares == 32


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_singular_values(size):
    rng = np.random.default_rng(size)
    for spread in (0, -8):
        r = rng.normal(size=(size + 3, size)) * np.logspace(0, spread, size)
        diagonal, upper, right = bidiagonalise(r)
        values = dqds(diagonal, upper)
        assert np.sqrt(values) == pytest.approx(np.linalg.svd(r, compute_uv=False), rel=1e-6, abs=1e-15)
        most = int((values > 1e-22 * values[0]).sum())
        z = turn_back(twisted_vectors(diagonal, upper, values, most), right)
        assert np.abs(z.T @ z - np.eye(most)).max() < 1e-9
        assert np.abs(r.T @ (r @ z) - z * values[:most]).max() < 1e-12 * values[0]


@pytest.mark.parametrize("gap", [0, 1e-14, 1e-9, 1e-5, 1e-3])
def test_values_that_nearly_coincide(gap):
    rng = np.random.default_rng(5)
    r = np.linalg.qr(rng.normal(size=(20, 20)))[0] @ np.diag(1 + gap * np.arange(20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    diagonal, upper, right = bidiagonalise(r)
    values = dqds(diagonal, upper)
    z = turn_back(twisted_vectors(diagonal, upper, values, 20), right)
    assert np.abs(z.T @ z - np.eye(20)).max() < 1e-10 and np.abs(r.T @ (r @ z) - z * values).max() < 1e-13
