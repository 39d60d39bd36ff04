"""Joins with the facts of a run: both ways give what a plain search gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.operators import as_of
from opticlake.operators import enrich as J
from opticlake.session import GROUP_ROWS_SETTING


def plain(rows, facts):
    """The values of the newest run at or before the row's, the largest of equal ones; a row without a run takes the newest."""
    out = {}
    for i, (device, run) in enumerate(rows):
        own = [(r, v) for d, r, v in facts if d is not None and d == device and r is not None and (run is None or r <= run)]
        newest = max((r for r, _ in own), default=None)
        out[i] = max(((v is not None, v) for r, v in own if r == newest), default=(0, None))[1]
    return out


@pytest.mark.parametrize("few", [0, 32])
@pytest.mark.parametrize("limit", [None, 40])
def test_both_ways(spark, monkeypatch, few, limit):
    """Several tables, hot keys, NULL keys, runs and values, repeated facts and facts that do not change."""
    monkeypatch.setattr(as_of, "FEW", few)
    rng = random.Random(few)
    devices = ["hot"] * 6 + ["b", "c", None]
    rows = [(rng.choice(devices), rng.choice([None, *range(0, 60, 3)])) for _ in range(400)]
    one = [(rng.choice(devices), rng.choice([None, *range(5, 60, 2)]), rng.choice(["x", "y", None])) for _ in range(150)]
    two = [(rng.choice(devices), rng.choice(range(40, 50)), rng.choice("pq")) for _ in range(30)]
    frame = spark.createDataFrame([(d, r, i) for i, (d, r) in enumerate(rows)], "device string, run_timestamp long, i int")
    sides = [spark.createDataFrame(f, f"device string, run_timestamp long, {c} string") for f, c in ((one, "v"), (two, "w"))]
    if limit:
        spark.conf.set(GROUP_ROWS_SETTING, limit)
    try:
        joined = as_of.join_all_as_of(frame, sides, ["device"])
        assert joined.columns == ["device", "run_timestamp", "i", "v", "w"]
        found = joined.collect()
    finally:
        spark.conf.unset(GROUP_ROWS_SETTING)
    assert {r["i"]: (r["device"], r["run_timestamp"]) for r in found} == dict(enumerate(rows)) and len(found) == len(rows)
    assert {r["i"]: r["v"] for r in found} == plain(rows, one)
    assert {r["i"]: r["w"] for r in found} == plain(rows, two)


def test_sides_without_a_run_and_empty_ones(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 7)], "device string, run_timestamp long")
    undated = spark.createDataFrame([("a", "u")], "device string, u string")
    empty = spark.createDataFrame([], "device string, run_timestamp long, e string")
    dated = spark.createDataFrame([("b", 7, "d"), ("a", 6, "late")], "device string, run_timestamp long, v string")
    found = as_of.join_all_as_of(rows, [undated, empty, dated], ["device"])
    assert found.columns == ["device", "run_timestamp", "u", "e", "v"]
    assert sorted(map(tuple, found.collect())) == [("a", 5, "u", None, None), ("b", 7, None, None, "d")]


def test_ports_and_chassis_at_once(spark):
    blank = dict.fromkeys(C.TRANSCEIVER_COLUMNS)
    ports = spark.createDataFrame(
        [("d", f"et-0/0/{p}", run, *(blank | {"vendor": f"v{p}{run}", "serial_number": None if run == 2 else f"s{p}{run}"}).values())
         for p in range(3) for run in (1, 2, 3)], "device string, if_name string, run_timestamp long, " + ", ".join(f"{c} string" for c in blank))
    chassis = spark.createDataFrame([("d", f"et-0/0/{p}", 1, f"c{p}") for p in (1, 2, 5)],
                                    "device string, if_name string, run_timestamp long, serial_number string")
    rows = spark.createDataFrame([("d", f"et-0/0/{p}:0", run) for p in (0, 1, 2, 5) for run in range(5)],
                                 "device string, if_name string, run_timestamp long")
    one = J.enrich_ports(rows, ports, chassis)
    two = J.serial_precedence(J.enrich_transceiver(rows, ports), chassis).select(*one.columns)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and one.count() == 20


def test_a_port_with_many_versions_is_carried(spark):
    """No row meets all versions of its port."""
    facts = spark.range(20_000).select(F.lit("a").alias("device"), F.col("id").alias("run_timestamp"), F.uuid().alias("v"))
    rows = spark.range(0, 20_000, 2).select(F.lit("a").alias("device"), F.col("id").alias("run_timestamp"))
    joined = as_of.join_as_of(rows, facts, ["device"])
    assert joined.join(facts, ["run_timestamp", "v"]).count() == 10_000
    assert "Join" not in joined._jdf.queryExecution().executedPlan().toString()


def test_device_facts_by_run(spark):
    system = spark.createDataFrame([("d", 1, "old", "p"), ("d", 3, "new", "p")], "device string, run_timestamp long, origin_hostname string, device_profile string")
    serials = spark.createDataFrame([("d", 2, "S")], "device string, run_timestamp long, origin_name string")
    seen = spark.createDataFrame([("d", run) for run in (0, 1, 2, 3)], "device string, run_timestamp long")
    found = {r["run_timestamp"]: (r["origin_hostname"], r["origin_name"], r["has_system"], r["has_chassis"])
             for r in J.assemble_device_bundle(system, serials, seen, seen.where("false")).collect()}
    assert found == {0: ("d", "d", False, False), 1: ("old", "d", True, False), 2: ("old", "S", True, True), 3: ("new", "S", True, True)}
