"""Stored rollups: only hours with other files are read again, and the result is that of a whole run."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from opticlake.functions import run_time_columns
from opticlake.operators import aggregate as G
from opticlake.session import scratch
from opticlake.sources import lake as K
from opticlake.sources.rollups import stored_quantiles, stored_rollup, update_rollup

START = 1_706_342_400  # 2024-01-27 08:00 UTC


def same(a, b):
    def rows(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(a.columns)).collect()), key=repr)

    assert rows(a) == rows(b)


def test_late_files_change_their_hours_alone(spark):
    rng = random.Random(1)
    data = [(f"d{i % 3}", f"i{i % 4}", START + rng.randrange(30 * 3600), i, None if i % 9 == 0 else rng.random() * 5) for i in range(600)]
    rows = run_time_columns(spark.createDataFrame(data, "device string, if_name string, timestamp long, id long, v double"))
    lake, root = scratch(spark, "lake"), scratch(spark, "rollup")

    def update():
        return {tuple(r) for r in update_rollup(spark, f"{lake}/s", root, ["v"], order="id").collect()}

    def whole():
        return G.rollup_hourly_daily(spark.read.parquet(f"{lake}/s"), ["v"], ts="timestamp", order="id")

    first, late = rows.where("id % 40 <> 7"), rows.where("id % 40 = 7 and dt = '2024-01-27'")
    K.write_lake_hourly({"s": first}, lake)
    assert update() == {tuple(r) for r in first.select("dt", "hr").distinct().collect()}
    same(whole(), stored_rollup(spark, root, ["v"]))
    assert update() == set()
    K.write_lake_hourly({"s": late}, lake)
    assert update() == {tuple(r) for r in late.select("dt", "hr").distinct().collect()}
    same(whole(), stored_rollup(spark, root, ["v"]))
    # An hour that is dropped from the lake goes from the results.
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{lake}/s/dt=2024-01-27/hr=09")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    assert update() == set()
    same(whole(), stored_rollup(spark, root, ["v"]))
    medians = {r["device"]: r["v_p50"] for r in stored_quantiles(spark, root, ["v"], {"p50": 0.5}, ["device"]).collect()}
    left = spark.read.parquet(f"{lake}/s").where("v is not null")
    for device, median in medians.items():
        values = sorted(r["v"] for r in left.where(F.col("device") == device).collect())
        assert median == pytest.approx(values[(len(values) - 1) // 2], abs=0.1)
