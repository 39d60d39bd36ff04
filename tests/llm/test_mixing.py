from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opticlake.llm import mixing
from opticlake.llm.mixing import mix_sources
from tests.llm import brute

SCHEMA = "doc_id long, a string, b string, text string, epoch string, n_tokens string"


def plain_budgets(supply, weights, budget, epochs):
    """Top-down by repeated sharing: whoever is full keeps its cap, the others share anew."""

    def cap(path):
        return sum(s * epochs for leaf, s in supply.items() if leaf[: len(path)] == path)

    def split(path, left):
        depth = len(path)
        if depth == 2:
            return {path: left}
        kids = sorted({leaf[: depth + 1] for leaf in supply if leaf[:depth] == path})
        kids = [k for k in kids if weights.get(k, 1) > 0 and cap(k)]
        full = set()
        while True:
            free = left - sum(cap(k) for k in full)
            others = [k for k in kids if k not in full]
            total = sum(weights.get(k, 1) for k in others)
            more = {k for k in others if cap(k) * total <= weights.get(k, 1) * free}
            if not more:
                break
            # The most constrained one first, as the others then get more.
            full.add(min(more, key=lambda k: (cap(k) / weights.get(k, 1), k)))
        out = {}
        for k in kids:
            share = cap(k) if k in full else weights.get(k, 1) * free // total
            out |= split(k, share)
        return out

    return split((), budget)


def plain(docs, weights, budget_of, seed, epochs):
    counted = [(i, (a or "", b or ""), len(brute.words(t))) for i, a, b, t in docs]
    counted = [c for c in counted if c[2]]
    supply = {}
    for _, leaf, n in counted:
        supply[leaf] = supply.get(leaf, 0) + n
    taken = []
    for leaf, budget in plain_budgets(supply, weights, budget_of(sum(supply.values())), epochs).items():
        own = [(i, n) for i, x, n in counted if x == leaf]
        whole, rest = divmod(budget, supply[leaf])
        taken += [(i, *leaf, e, n) for i, n in own for e in range(whole)]
        keyed = [(hashlib.md5(":".join([str(seed), str(whole), "" if i is None else str(i)]).encode()).hexdigest(), n, i) for i, n in own]
        for _, n, i in sorted(keyed, key=lambda k: k[:2]):
            rest -= n
            if rest >= 0:
                taken.append((i, *leaf, whole, n))
    return sorted(taken, key=str)


def run(spark, docs, weights, budget, seed, epochs):
    frame = spark.createDataFrame([(i, a, b, t, "x", "x") for i, a, b, t in docs], SCHEMA)
    return sorted(((r["doc_id"], r["a"], r["b"], r["epoch"], r["n_tokens"]) for r in mix_sources(frame, ["a", "b"], weights, budget, seed, epochs).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_plain(spark, seed):
    rng = random.Random(seed)
    docs = [(i, rng.choice(["x", "x", "x", "y", "z", None]), rng.choice(["p", "p", "p", "q", "r", None]),
             " ".join(brute.random_words(rng, rng.choice([0, 1, 5, 40])))) for i in range(300)]
    docs += [(None, "x", "p", "a b c"), (900, "y", "q", None), (901, "x", "q", "one"), (901, "x", "q", "one"), (901, "x", "q", "one two")]
    weights = {("x",): 1, ("y",): 3, ("z",): 0, ("x", "p"): 2, ("y", "q"): 5, ("", "r"): 4, ("gone",): 9}
    for part, epochs in ((2, 2), (1, 1), (1, 3)):
        assert run(spark, docs, weights, F.expr(f"tokens div {part}"), seed, epochs) == plain(docs, weights, lambda n: n // part, seed, epochs)


def test_leaves_joined_by_shuffle(spark, monkeypatch):
    rng = random.Random(8)
    docs = [(i, "x" if i % 3 else "y", str(i % 5), " ".join(brute.random_words(rng, 9))) for i in range(60)]
    expected = run(spark, docs, {}, F.expr("tokens div 2"), 1, 1)
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", 0)
    assert run(spark, docs, {}, F.expr("tokens div 2"), 1, 1) == expected


def test_shortage_goes_to_siblings_before_ancestors(spark):
    docs = [(i, "x", "p", "w " * 10) for i in range(2)] + [(10 + i, "x", "q", "w " * 10) for i in range(50)] + [(100 + i, "y", "p", "w " * 10) for i in range(50)]
    taken = run(spark, docs, {}, F.lit(400), 1, 1)
    sums = {}
    for _, a, b, _, n in taken:
        sums[a, b] = sums.get((a, b), 0) + n
    assert sums == {("x", "p"): 20, ("x", "q"): 180, ("y", "p"): 200}


def test_empty_and_bad_weights(spark):
    assert run(spark, [], {}, F.lit(100), 1, 1) == []
    assert run(spark, [(1, "x", "p", "a b")], {}, F.lit(0), 1, 1) == []
    with pytest.raises(ValueError):
        run(spark, [], {("x",): -1}, F.lit(1), 1, 1)


def test_plan_is_native(spark):
    frame = spark.createDataFrame([(1, "x", "p", "a", "x", "x")], SCHEMA)
    plan = mix_sources(frame, ["a", "b"], {}, F.lit(5), 1)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("ids", [[5] * 100, [None] * 100, [5] * 60 + [6] * 40])
def test_of_equal_rows_as_many_as_fit(spark, ids):
    docs = [(i, "x", "p", "a b c") for i in ids]
    assert len(run(spark, docs, {}, F.expr("tokens div 2"), 3, 1)) == 50
    assert len(run(spark, docs, {}, F.lit(10), 3, 1)) == 3
    assert run(spark, docs, {}, F.expr("tokens div 2"), 3, 1) == plain(docs, {}, lambda n: n // 2, 3, 1)


def test_kept_columns(spark):
    rows = [(i % 3, "x", "p", f"word {i}", f"e{i}", "n") for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = mix_sources(frame, ["a", "b"], {}, F.expr("tokens div 2"), 1, 1, ["text", "epoch", "n_tokens", "A"])
    assert found.columns == ["doc_id", "a", "b", "epoch", "n_tokens", "text"]
    texts = [r["text"] for r in found.collect()]
    assert len(texts) == len(set(texts)) == 20


def test_rows_with_their_texts_are_not_exchanged(spark):
    docs = spark.range(400).select(
        "id", F.concat(F.lit("x"), (F.col("id") % 3).cast("string")).alias("a"), F.lit("l").alias("b"),
        F.concat(F.lit("some words of "), F.col("id").cast("string")).alias("text")).withColumnRenamed("id", "doc_id")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "500"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        mix = mix_sources(docs, ["a", "b"], {("x0",): 3}, F.expr("tokens div 2"), 7, 2, ["text"])
        assert 0 < mix.where("text IS NOT NULL").count() < 400
        plan = mix._jdf.queryExecution().simpleString().splitlines()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    depths, found = [], 0
    for line in plan:
        depth = len(line) - len(line.lstrip(" :+-"))
        depths = [d for d in depths if d < depth]
        if "Exchange hashpartitioning" in line:
            depths.append(depth)
        if "mix-counted" in line:
            found += 1
            assert not depths
    assert found
