from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from opticlake.operators import timeseries as W
from opticlake.operators.slices import SLICE, series
from opticlake.session import GROUP_ROWS_SETTING

TIE = ["event_id"]


@pytest.fixture(scope="module")
def samples(spark):
    """One series holds a third of all rows; times repeat, counters have gaps and resets."""
    rng = random.Random(7)
    rows, total = [], 0
    for i in range(900):
        key = 0 if i % 3 == 0 else rng.randrange(1, 40)
        total += rng.randrange(0, 5)
        if rng.random() < 0.03:
            total = 0
        ccw = None if rng.random() < 0.1 else total
        nccw = None if rng.random() < 0.3 else rng.randrange(0, 3)
        rows.append((f"dev-{key % 7}", f"et-{key}", i, 1_700_000_000 + rng.randrange(0, 400_000), ccw, nccw, rng.random() * 9))
    return spark.createDataFrame(
        rows, "device string, if_name string, event_id long, ts long, fec_ccw long, fec_nccw long, value double").cache()


def same(a, b, digits=9):
    def rows(df):
        return sorted(
            (tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(a.columns)).collect()),
            key=repr)

    assert rows(a) == rows(b)


WIDTHS = [86_400, 3_600, 60, 1]


@pytest.mark.parametrize("width", WIDTHS)
def test_sliced_deltas(samples, width):
    plain = W.counter_deltas(samples, ["fec_ccw", "fec_nccw"], tiebreak=TIE, width=None)
    same(plain, W.counter_deltas(samples, ["fec_ccw", "fec_nccw"], tiebreak=TIE, width=width))


@pytest.mark.parametrize("width", WIDTHS)
def test_sliced_features(samples, width):
    plain = W.moving_features(samples, ["value"], 4, 3_600, tiebreak=TIE, width=None)
    same(plain, W.moving_features(samples, ["value"], 4, 3_600, tiebreak=TIE, width=width), 6)


@pytest.mark.parametrize("width", WIDTHS)
def test_sliced_labels(samples, width):
    deltas = W.counter_deltas(samples, ["fec_nccw"], tiebreak=TIE, width=None)
    same(W.failure_label(deltas, 50_000, tiebreak=TIE, width=None),
         W.failure_label(deltas, 50_000, tiebreak=TIE, width=width))


def test_drift_is_the_fitted_slope(samples):
    rows = samples.collect()
    found = {r["event_id"]: r["value_drift"] for r in W.power_drift(samples, "value", 7_200).collect()}
    for r in rows:
        span = [o for o in rows if o["if_name"] == r["if_name"] and r["ts"] - 7_200 <= o["ts"] <= r["ts"]]
        if len({o["ts"] for o in span}) < 2:
            assert found[r["event_id"]] is None
        else:
            slope = statistics.linear_regression([o["ts"] - r["ts"] for o in span], [o["value"] for o in span]).slope
            assert found[r["event_id"]] == pytest.approx(slope, rel=1e-6, abs=1e-12)


def largest_range(s):
    return s.sliced().groupBy(*s.keys, SLICE).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("limit", [3, 40, 150])
def test_ranges_of_large_keys(samples, spark, limit):
    """Only the large keys are cut, into ranges that a task can hold; all results are those of no cut."""
    plain = W.counter_deltas(samples, ["fec_ccw", "fec_nccw"], tiebreak=TIE, width=None)
    features = W.moving_features(samples, ["value"], 7, 3_600, tiebreak=TIE, width=None)
    labels = W.failure_label(plain, 50_000, tiebreak=TIE, width=None)
    spark.conf.set(GROUP_ROWS_SETTING, str(limit))
    try:
        s = series(samples, W.KEYS, "ts", ["ts", *TIE])
        assert largest_range(s) <= limit
        cut = {r["if_name"] for r in s.cuts.collect()}
        assert cut == {r["if_name"] for r in samples.groupBy("if_name").count().where(f"count > {limit}").collect()}
        same(plain, W.counter_deltas(samples, ["fec_ccw", "fec_nccw"], tiebreak=TIE))
        same(features, W.moving_features(samples, ["value"], 7, 3_600, tiebreak=TIE), 6)
        same(labels, W.failure_label(plain, 50_000, tiebreak=TIE))
    finally:
        spark.conf.unset(GROUP_ROWS_SETTING)
    assert series(samples, W.KEYS, "ts").whole


def test_a_dense_second(spark):
    """All rows of a key in one second: they are cut by the rest of the order."""
    rows = spark.range(20_000).select(F.lit("d").alias("device"), F.lit("i").alias("if_name"), F.lit(1_700_000_000).alias("ts"),
                                      F.col("id").alias("event_id"), F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id"), F.lit(9))).alias("c"),
                                      (F.col("id") % 1000).cast("double").alias("v"))
    plain = W.counter_deltas(rows, ["c"], tiebreak=TIE, width=None)
    features = W.moving_features(rows, ["v"], 4, 60, tiebreak=TIE, width=None)
    spark.conf.set(GROUP_ROWS_SETTING, "1000")
    try:
        assert largest_range(series(rows, W.KEYS, "ts", ["ts", *TIE])) <= 1000
        assert largest_range(series(rows, W.KEYS, "ts")) <= 1000  # no tiebreak: rows are told apart by their values
        same(plain, W.counter_deltas(rows, ["c"], tiebreak=TIE))
        same(features, W.moving_features(rows, ["v"], 4, 60, tiebreak=TIE), 6)
    finally:
        spark.conf.unset(GROUP_ROWS_SETTING)


def test_label_by_brute_force(samples):
    deltas = W.counter_deltas(samples, ["fec_nccw"], tiebreak=TIE)
    rows = deltas.collect()
    labels = {r["event_id"]: r["failure_label"] for r in W.failure_label(deltas, 20_000, tiebreak=TIE, width=600).collect()}
    for r in rows:
        own = [o for o in rows if (o["device"], o["if_name"]) == (r["device"], r["if_name"])]
        hit = any(r["ts"] < o["ts"] <= r["ts"] + 20_000 and (o["fec_nccw_delta"] or 0) > 0 for o in own)
        seen = r["ts"] + 20_000 <= max(o["ts"] for o in own)
        assert labels[r["event_id"]] == (1 if hit else 0 if seen else None)


def test_anomaly_methods(samples):
    scored = W.anomaly_score(samples, ["value"], "mad").where("if_name = 'et-0'").collect()
    values = [r["value"] for r in scored]
    centre = statistics.median(values)
    spread = 1.4826 * statistics.median(abs(v - centre) for v in values)
    for r in scored:
        assert r["anomaly_score"] == pytest.approx(abs(r["value"] - centre) / spread)
    with pytest.raises(ValueError):
        W.anomaly_score(samples, ["value"], "forest")


def test_latest_sample(samples):
    newest = W.latest_sample(samples, W.KEYS, "ts", TIE)
    expected = {}
    for r in samples.collect():
        key = (r["device"], r["if_name"])
        expected[key] = max(expected.get(key, (0, 0)), (r["ts"], r["event_id"]))
    assert {(r["device"], r["if_name"]): (r["ts"], r["event_id"]) for r in newest.collect()} == expected


def test_status_and_health(spark):
    bounds = ["x_high_alarm", "x_low_alarm", "x_high_warn", "x_low_warn"]
    rows = [(5.0, 5.0, None, None, None), (4.0, 5.0, 0.0, 4.0, 1.0), (1.0, None, 0.0, None, 1.0), (2.0, 5.0, 0.0, 4.0, 1.0),
            (None, 5.0, 0.0, 4.0, 1.0), (2.0, None, None, None, None)]
    df = spark.createDataFrame(rows, "x double, " + ", ".join(f"{b} double" for b in bounds))
    assert [r["status"] for r in W.threshold_status(df, ["x"]).collect()] == ["Alarm", "Warning", "Warning", "OK", None, "OK"]
    health = spark.createDataFrame(
        [("OK", None, None), ("OK", 1.0, 0.0), ("Alarm", 0.0, 0.0), ("Warning", 0.0, 0.0), ("OK", 0.0, -1.0), (None, 0.0, 0.0)],
        "status string, fec_nccw_rate double, rx_power_drift double")
    assert [r["health"] for r in W.health_class(health).collect()] == [
        "healthy", "critical", "critical", "degrading", "degrading", "healthy"]


def test_time_to_threshold(spark):
    rows = [("d", "up", t, 1.0 + t) for t in range(5)] + [("d", "down", t, 9.0 - t) for t in range(5)] + [("d", "one", 0, 1.0)]
    df = spark.createDataFrame(rows, "device string, if_name string, ts long, v double")
    found = {r["if_name"]: r["seconds_left"] for r in W.time_to_threshold(df, "v", 10.0).collect()}
    assert found["up"] == pytest.approx(5.0) and found["down"] is None and found["one"] is None


def test_rates(spark):
    df = spark.createDataFrame([("d", "i", 0, 5), ("d", "i", 0, 7), ("d", "i", 10, 2)],
                               "device string, if_name string, ts long, c long").withColumn("n", F.monotonically_increasing_id())
    rows = W.counter_rates(W.counter_deltas(df, ["c"], tiebreak=["n"]), ["c"]).orderBy("n").collect()
    assert [(r["interval"], r["c_delta"], r["c_reset"], r["c_rate"]) for r in rows] == [
        (None, None, None, None), (0, 2, False, None), (10, 2, True, 0.2)]
