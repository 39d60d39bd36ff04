"""Quantiles and distinct sets from states that merge."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from opticlake.operators import aggregate as G
from opticlake.operators import sketches as K
from opticlake.session import GROUP_ROWS_SETTING

SHARES = {"least": 0.0, "low": 0.05, "median": 0.5, "high": 0.95, "far": 0.999, "most": 1.0}
INF, NAN = float("inf"), float("nan")


def plain(values, p):
    ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    if not ordered:
        return None
    at = p * (len(ordered) - 1)
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low if math.floor(at) == math.ceil(at) else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def groups(seed=3):
    rng = random.Random(seed)
    return {"a": [rng.gauss(0, 1) for _ in range(3_000)] + [None], "b": [float(rng.randrange(4)) for _ in range(2_000)], None: [1.0, 2.0],
            "c": [5.0], "d": [None, None], "e": [NAN, 1.0, INF, -INF, NAN], "f": [7.0] * 900 + [NAN] * 300, "g": [NAN]}


def frame(spark, data):
    rows = [(k, v) for k, vs in data.items() for v in vs]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double").repartition(7)


def check(found, data):
    assert {r["k"] for r in found} == set(data)
    for r in found:
        for name, p in SHARES.items():
            want = plain(data[r["k"]], p)
            assert r[f"v_{name}"] == (want if want is None else pytest.approx(want, abs=1e-12, nan_ok=True)), (r["k"], name)


@pytest.mark.parametrize("limit, size", [(10**6, 4096), (100, 256), (100, 4096), (1, 16)])
def test_exact_quantiles(spark, monkeypatch, limit, size):
    """The built-in quantile, and brackets of finer and coarser sketches; NaN and infinite values."""
    monkeypatch.setattr(K, "SIZE", size)
    data = groups()
    spark.conf.set(GROUP_ROWS_SETTING, limit)
    try:
        found = K.exact_quantiles(frame(spark, data), ["k"], ["v"], SHARES, [F.count("*").alias("n")], ["n"], columns=[]).collect()
    finally:
        spark.conf.unset(GROUP_ROWS_SETTING)
    check(found, data)
    assert {r["k"]: r["n"] for r in found} == {k: len(v) for k, v in data.items()}


def test_brackets_that_miss_are_widened(spark):
    """The sketches of other groups: the ranks lie outside, which is seen, and the whole group is looked at."""
    data = {k: v for k, v in groups(4).items() if k in ("a", "b")}
    df = frame(spark, data)
    states = K.quantile_states(df, ["k"], ["v"])
    other = states.select(F.when(F.col("k") == "a", "b").otherwise("a").alias("k"), F.col("v_kll").alias("other"))
    far = states.join(other, "k").withColumn("v_kll", F.col("other")).drop("other")
    found = K.quantiles_by_bracket(df, ["k"], "v", far, list(SHARES.values()), 0.0).collect()
    assert {(r["k"], r["share"]): r["quantile"] for r in found} == {
        (k, p): pytest.approx(plain(v, p), abs=1e-12) for k, v in data.items() for p in SHARES.values()}


def test_states_merge(spark):
    data = groups(5)
    df = frame(spark, data).withColumn("hour", F.pmod(F.hash("v"), F.lit(5)))
    states = K.merged_states(K.quantile_states(df, ["k", "hour"], ["v"]), ["k"], ["v"])
    for r in K.state_quantiles(states, ["v"], SHARES).collect():
        values = sorted(v for v in data[r["k"]] if v is not None and not math.isnan(v))
        assert (r["v_n"], r["v_nans"]) == (len(values), sum(v is not None and math.isnan(v) for v in data[r["k"]]))
        for name, p in SHARES.items():
            if values:
                below, upto = (sum(f(v) for v in values) / len(values) for f in (lambda v: v < r[f"v_{name}"], lambda v: v <= r[f"v_{name}"]))
                assert below - K.SLACK <= p <= upto + K.SLACK


def test_sets_are_exact_while_small_and_near_beyond(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("large").alias("vendor"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.col("id") % 20_000).cast("string").alias("device"),
        F.lit("i").alias("if_name"), (F.col("id") % 10 * 3600).alias("ts"))
    sets = G.fleet_sets(rows, ["vendor"])
    stored = sets.count()
    assert stored == 20
    changes = {r["vendor"]: r for r in G.fleet_changes(sets, ["vendor"], F.lit(5 * 3600)).collect()}
    ids = {v: [{r["device"] for r in rows.where(f"vendor = '{v}' and ts {test} 18000").select("device").distinct().collect()} for test in ("<", ">=")]
           for v in ("small", "large")}
    for v, (before, after) in ids.items():
        want = {"before": len(before), "after": len(after), "both": len(before & after), "gone": len(before - after), "new": len(after - before)}
        slack = 0 if v == "small" else 5 / math.sqrt(2**K.LOG_SIZE) * len(before | after)
        assert all(abs(changes[v][name] - n) <= slack for name, n in want.items()), (v, want, changes[v])


def test_sets_of_one_period_only(spark):
    rows = spark.createDataFrame([("x", "a", 0), ("x", "b", 0), ("y", "a", 7200)], "device string, if_name string, ts long")
    found = {r["device"]: tuple(r)[1:] for r in G.fleet_changes(G.fleet_sets(rows, ["device"], members=["if_name"]), ["device"], F.lit(3600)).collect()}
    assert found == {"x": (2, 0, 0, 2, 0), "y": (0, 1, 0, 0, 1)}
    assert K.member("device", "if_name") is not None


def test_members_are_told_apart(spark):
    rows = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), (None, "x"), ("x", None)], "p string, q string")
    assert rows.select(K.member("p", "q").alias("m")).distinct().count() == 4
