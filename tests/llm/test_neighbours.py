from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from opticlake.llm import neighbours
from opticlake.llm.catalog import QUERIES, load_all

load_all()
SCHEMA = "vec_id long, embedding array<float>, score string"


def run(spark, rows, k=5, step=3):
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = neighbours.nearest_neighbours(frame, F.col("number") % step == 0, k).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def plain(rows, k=5, step=3):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = max({len(v) for _, v in good}, key=lambda n: sum(len(v) == n for _, v in good)) if good else 0
    good = [(i, v) for i, v in good if len(v) == size]
    out = {}
    for q, v in good:
        if q % step == 0:
            near = sorted((-sum(float(a * b) for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def check(found, expected, least=0.9):
    assert found.keys() == {q for q, near in expected.items() if near}
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in near}) for q, near in expected.items() if near)
    assert hits >= least * sum(map(len, expected.values()))


def test_recall_and_order(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.2, 3)).tolist()) for i in range(900)]
    found = run(spark, rows)
    check(found, plain(rows))
    vectors = dict(rows)
    for q, near in found.items():
        assert [(-s, i) for i, s in near] == sorted((-s, i) for i, s in near)
        for i, s in near:
            a, b = (np.array(vectors[x], np.float32).astype(float) for x in (q, i))
            assert s == pytest.approx(float(a @ b), abs=1e-12) and i != q


def test_copies_ties_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PIECE_ROWS", 16)
    rng = np.random.default_rng(2)
    one = rng.normal(size=8).tolist()
    rows = [(i, one if i % 2 else rng.integers(-1, 2, 8).astype(float).tolist()) for i in range(400)]
    found, expected = run(spark, rows), plain(rows)
    check(found, expected)
    assert [i for i, _ in found[3]] == [i for i, _ in expected[3]]


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [0.0, 1.0]), (1, [2.0, 1.0]), (6, None), (9, []), (12, [0.0, 0.0]),
            (15, [float("nan"), 1.0]), (18, [1.0, 2.0, 3.0]), (21, [None, 1.0]), (None, [1.0, 1.0]), (4, [float("inf"), 1.0])]
    found = run(spark, rows)
    assert found == {0: [(1, 2.0), (3, 1.0)], 3: [(1, 2.0), (0, 1.0)]}
    assert run(spark, []) == {} and run(spark, [(0, [1.0])]) == {}


def test_registered_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected = plain(rows, 20, 20)
    found = {}
    for r in QUERIES["op1_nearest_neighbours"](spark, sf).collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    check(found, expected)
    assert all(len(f) == 20 for f in found.values())
