from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opticlake.llm import exact_topk
from opticlake.llm.exact_topk import best_scores, exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score string, number int"


def run(spark, rows, k=5, step=3):
    frame = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], SCHEMA)
    found = exact_top_k(frame, F.col("vec_id") % step == 0, k).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)


def plain(rows, k=5, step=3, scale=256):
    good = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    usual = max(sorted({len(v) for _, v in good}), key=lambda n: sum(len(v) == n for _, v in good)) if good else 0
    good = [(i, v) for i, v in good if len(v) == usual]
    out = []
    for q, v in good:
        if q % step == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(near[:k])]
    return sorted(out)


def test_equal_to_all_pairs_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_BYTES", 0)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.2).tolist()) for i in range(1500)]
    assert run(spark, rows) == plain(rows)


def test_bounds_exclude_blocks_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_BYTES", 0)
    met = []
    score = exact_topk._score
    monkeypatch.setattr(exact_topk, "_score", lambda pairs, *rest: met.append(pairs.count()) or score(pairs, *rest))
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8)) * 5
    rows = [(i, (centres[i % 20] + rng.normal(size=8) * 0.05).tolist()) for i in range(4000)]
    assert run(spark, rows, step=50) == plain(rows, step=50)
    blocks = 4000 // 64
    assert sum(met) < blocks * math.ceil(80 / 64) * 20 / 2  # fewer than half of all pairs of a block and a cluster of queries


def test_ties_copies_and_fewer_candidates_than_k(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK_BYTES", 0)
    rng = np.random.default_rng(3)
    one = rng.normal(size=4).tolist()
    rows = [(i, one if i % 3 else rng.integers(-1, 2, 4).astype(float).tolist()) for i in range(400)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[:4], k=9) == plain(rows[:4], k=9)
    assert run(spark, rows[:1]) == []


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (3, None), (6, [1.0, None]), (9, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (15, []),
            (18, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (1, [0.0, 0.0]), (2, [-1.0, -2.0]), (21, [3.0, -4.0]), (24, [1e30, 0.0])]
    assert run(spark, rows) == plain([r for r in rows if r[0] != 24])
    assert run(spark, []) == []
    assert run(spark, [(3, None)]) == []


def test_repeated_rows_are_found_as_often_and_asked_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.0])]
    assert run(spark, rows) == [(0, 1, 1, 131072), (0, 2, 1, 131072), (0, 3, 2, 32768)]


@pytest.mark.parametrize("large", [1, 1 << 26])
def test_scores_in_doubles_and_in_longs(large):
    rng = np.random.default_rng(4)
    asked, rows = (rng.integers(-3, 4, (n, 6)).astype(np.int32) * large for n in (5, 40))
    ids, numbers = np.arange(5) * 3, np.arange(40)
    top, scores = best_scores(asked, ids, rows, numbers, 4)
    for i in range(5):
        near = sorted((-int(sum(int(a) * int(b) for a, b in zip(asked[i], rows[j], strict=True))), j) for j in range(40) if j != ids[i])
        assert [(-s, j) for s, j in sorted(zip((-scores[i]).tolist(), top[i].tolist(), strict=True))] == [(-s, j) for s, j in near[:4]]
