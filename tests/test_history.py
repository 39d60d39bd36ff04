"""Several runs, repeated metadata, odd numbers, lost merges: cases in which rows must neither multiply, vanish nor change."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.functions import run_time_columns
from opticlake.operators import aggregate as G
from opticlake.operators import enrich as J
from opticlake.operators import extract as X
from opticlake.operators import filters as P
from opticlake.operators import timeseries as W
from opticlake.operators.as_of import join_as_of
from opticlake.session import scratch
from opticlake.sources import lake as K
from opticlake.sources import replies as A


def test_facts_as_of_the_run(spark):
    rows = spark.createDataFrame([("a", r, i) for i, r in enumerate([5, 10, 15, 20, 25, None])] + [("b", 10, 9)], "device string, run_timestamp long, i int")
    facts = spark.createDataFrame([("a", 10, "old"), ("a", 15, "old"), ("a", 20, "new"), ("a", 20, "mew"), ("c", 1, "x")], "device string, run_timestamp long, v string")
    found = {r["i"]: r["v"] for r in join_as_of(rows, facts, ["device"]).collect()}
    assert found == {0: None, 1: "old", 2: "old", 3: "new", 4: "new", 5: "new", 9: None}


def test_a_changed_transceiver(spark):
    blank = dict.fromkeys(C.TRANSCEIVER_COLUMNS)
    ports = spark.createDataFrame(
        [("d", "et-0/0/1", run, *(blank | {"vendor": v}).values()) for run, v in ((100, "ZZZ"), (200, "AAA"))],
        "device string, if_name string, run_timestamp long, " + ", ".join(f"{c} string" for c in blank))
    rows = spark.createDataFrame([("d", "et-0/0/1:0", r) for r in (100, 150, 200, 300)], "device string, if_name string, run_timestamp long")
    found = {r["run_timestamp"]: r["vendor"] for r in J.enrich_transceiver(rows, ports).collect()}
    assert found == {100: "ZZZ", 150: "ZZZ", 200: "AAA", 300: "AAA"}


def test_device_metadata_by_run(spark):
    system = spark.createDataFrame([("d", 1, "old", "p"), ("d", 2, "new", "p")], "device string, run_timestamp long, origin_hostname string, device_profile string")
    serials = spark.createDataFrame([("d", 1, "S9"), ("d", 2, "S1")], "device string, run_timestamp long, origin_name string")
    rows = spark.createDataFrame([("d", 1), ("d", 2), ("e", 1)], "device string, run_timestamp long")
    found = {(r["device"], r["run_timestamp"]): (r["origin_hostname"], r["origin_name"], r["inventory_instance"])
             for r in J.enrich_device_metadata(rows, system, serials).collect()}
    assert found == {("d", 1): ("old", "S9", "d"), ("d", 2): ("new", "S1", "d"), ("e", 1): (None, None, None)}
    empty = spark.createDataFrame([], "device string")
    bundle = J.assemble_device_bundle(system, serials, empty, empty).first()
    assert (bundle["origin_hostname"], bundle["origin_name"]) == ("new", "S1")


def test_counts_per_call(spark):
    docs = spark.createDataFrame([("d", 1, "optics_diagnostics"), ("d", 1, "interface_statistics")], "device string, run_timestamp long, rpc string")
    interfaces = spark.createDataFrame([("d", 1)], "device string, run_timestamp long")
    found = {r["rpc"]: (r["interfaces_count"], r["stats_count"], r["empty"])
             for r in G.doc_metric_counts(docs, interfaces=interfaces, stats=interfaces.limit(0)).collect()}
    assert found == {"optics_diagnostics": (1, 0, False), "interface_statistics": (0, 0, True)}


def test_devices_listed_twice(spark):
    schema = "device string, interface_filter string, hardware_model string"
    first = spark.createDataFrame([("d", "et-0/0/1", "a"), ("d", "", "b")], schema)
    second = spark.createDataFrame([("e", None, "c"), ("d", "et-0/0/2", None)], schema)
    rows = spark.createDataFrame([("d", "et-0/0/1"), ("d", "et-0/0/2")], "device string, if_name string")
    assert P.resolve_filter_precedence(rows, first).collect() == [rows.first()]
    assert X.inject_metadata(rows, first).count() == 2
    devices = {r["device"]: r["interface_filter"] for r in A.load_device_inventory(first, second).collect()}
    assert devices == {"d": "et-0/0/2", "e": None}


def test_thresholds_with_history(spark):
    bounds = ["high_alarm", "low_alarm", "high_warn", "low_warn"]
    lanes = spark.createDataFrame([("d", "i", 1, 5.0), ("d", "i", 2, 5.0)], "device string, if_name string, run_timestamp long, tx_bias double")
    limits = spark.createDataFrame([("d", "i", 1, 4.0), ("d", "i", 2, 9.0)], "device string, if_name string, run_timestamp long, tx_bias_high_alarm double")
    limits = limits.withColumns({f"tx_bias_{b}": F.lit(None).cast("double") for b in bounds[1:]})
    found = {r["run_timestamp"]: r["status"] for r in W.lane_threshold_status(lanes, limits, ["tx_bias"]).collect()}
    assert found == {1: "Alarm", 2: "OK"}
    assert W.lane_threshold_status(lanes.drop("run_timestamp"), limits, ["tx_bias"]).count() == 2


INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("odd", [[-INF], [INF, -INF], [NAN], [1e17], [1e15, 1e-3], [None], []])
def test_odd_samples_act_on_their_frames_only(spark, odd):
    """Sums over frames by slices against frames read one by one."""
    data = [("d", "i", 7 * n, 0.5) for n in range(60)]
    data += [("d", "i", 200 + 3 * n, v) for n, v in enumerate(odd)]
    rows = spark.createDataFrame(data, "device string, if_name string, ts long, t double")
    for width in (None, 60):
        found = {}
        for r in W.moving_features(rows, ["t"], 3, 50, tiebreak=["t"], width=width).collect():
            found.setdefault(r["ts"], set()).add(repr(r["t_ma_t"]))
        for ts, said in found.items():
            own = [v for _, _, at, v in data if ts - 50 <= at <= ts and v is not None]
            assert len(said) == 1
            mean, expected = float(next(iter(said))), math.fsum(own) / len(own) if all(map(math.isfinite, own)) else sum(own)
            assert mean == pytest.approx(expected, rel=1e-12, nan_ok=True), (width, ts)
    drift = {r["ts"]: r["t_drift"] for r in W.power_drift(rows, "t", 50).collect()}
    plain = {ts for ts in drift if not any(ts - 50 <= at <= ts for _, _, at, v in data if v != 0.5)}
    assert plain and all(drift[ts] is None or drift[ts] == pytest.approx(0, abs=1e-12) for ts in plain)


def test_hot_second_and_distant_rows(spark):
    """One key with most of its rows in one second and the others years apart."""
    data = [("d", "i", 1000, float(n)) for n in range(300)] + [("d", "i", 10**8 * n, 1.0) for n in range(1, 9)]
    rows = spark.createDataFrame(data, "device string, if_name string, ts long, t double")
    found = {r["ts"]: r["t_ma_t"] for r in W.moving_features(rows, ["t"], 2, 300, tiebreak=["t"], width=1).collect()}
    assert found == {1000: 149.5, **{10**8 * n: 1.0 for n in range(1, 9)}}


@pytest.fixture
def hour(spark):
    data = [("d", f"et-0/0/{i % 5}", 1706342400 + i, i) for i in range(40)]
    return run_time_columns(spark.createDataFrame(data, "device string, if_name string, timestamp long, fec_nccw long"))


def test_rows_that_arrive_during_a_merge_stay(spark, hour, monkeypatch):
    root = scratch(spark, "merge")
    K.append_same_file(hour.repartition(4), root, K.PARTITIONS)
    hour.repartition(5).write.mode("append").partitionBy("dt", "hr").parquet(root)
    listed = K._files

    def late(spark_, folder):
        found = listed(spark_, folder)
        if "staging" in folder:
            hour.limit(7).write.mode("append").partitionBy("dt", "hr").parquet(root)
        return found

    monkeypatch.setattr(K, "_files", late)
    K.compact_partition(spark, root, "2024-01-27", "08", 1, scratch(spark, "staging"))
    monkeypatch.undo()
    assert spark.read.parquet(root).count() == 87
    K.compact_partition(spark, root, "2024-01-27", "08", 1, scratch(spark, "staging"))
    assert spark.read.parquet(root).count() == 87 and len(K._files(spark, f"{root}/dt=2024-01-27/hr=08")) == 1


@pytest.mark.parametrize("lost_after", [0, 1])
def test_a_lost_merge_is_settled(spark, hour, lost_after, monkeypatch):
    root = scratch(spark, "merge")
    hour.repartition(6).write.partitionBy("dt", "hr").parquet(root)
    settle, calls = K._settle, []

    def once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt  # the driver is lost before the old files are deleted
        settle(*args)

    monkeypatch.setattr(K, "_settle", once)
    with pytest.raises(KeyboardInterrupt):
        K.compact_partition(spark, root, "2024-01-27", "08", 2, scratch(spark, "staging"))
    monkeypatch.undo()
    folder = f"{root}/dt=2024-01-27/hr=08"
    merged = [n for n in K._files(spark, folder) if n.startswith("merged-")]
    if lost_after:  # not all merged files got there
        path = spark._jvm.org.apache.hadoop.fs.Path
        path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(f"{folder}/{merged[0]}"), False)
    K.compact_partition(spark, root, "2024-01-27", "08", 2, scratch(spark, "staging"))
    spark.catalog.clearCache()
    assert spark.read.parquet(root).count() == 40 and len(K._files(spark, folder)) == 2


def test_exposition_of_two_jobs(spark):
    folder = scratch(spark, "text")
    lines = spark.createDataFrame([("i", "m 1"), ("j", "m 2")], "instance string, value string")
    K.write_exposition(lines, folder, "a")
    K.write_exposition(lines, folder, "b")
    K.write_exposition(lines.where("instance = 'i'").withColumn("value", F.lit("m 3")), folder, "a")
    found = {(r["job"], r["instance"]): r["value"] for r in spark.read.text(folder).collect()}
    assert found == {("a", "i"): "m 3", ("a", "j"): "m 2", ("b", "i"): "m 1", ("b", "j"): "m 2"}


def test_the_model_scores_every_later_row(spark):
    data = [(i, "k" if i % 3 else None, None if i % 4 == 0 else float(i % 7), INF if i == 250 else 1.0, i % 2 if i < 270 else None) for i in range(300)]
    frame = spark.createDataFrame(data, "ts long, kind string, x double, y double, failure_label int")
    _, scored = W.degradation_model(frame, ["x", "y"], categories=["kind"])
    cut = 270 * 0.7
    late = {r["ts"] for r in scored.collect()}
    assert late == set(range(min(late), 300)) and abs(min(late) - cut) < 5
    assert scored.where("prediction in (0.0, 1.0)").count() == len(late)


def test_stream_deltas_equal_the_batch(spark):
    """Several polls with late rows, unknown counters, resets and numbers beyond 2**53, against the batch operator."""
    from opticlake.streaming import jobs

    big = 2**60
    data = [("d", f"i{n % 2}", n, None if n % 5 == 0 else big + (n if n % 7 else 0), None if n % 3 else n) for n in range(40)]
    rows = spark.createDataFrame(data, "device string, if_name string, ts long, c long, other long")
    source, sink, progress = (scratch(spark, label) for label in ("in", "out", "progress"))
    late = rows.where("ts between 3 and 6")
    for poll in (rows.where("ts < 13"), rows.where("ts >= 13 and ts < 14").unionByName(late), rows.where("ts >= 14")):
        poll.write.mode("append").parquet(source)
        jobs.stream_counter_deltas(spark.readStream.schema(rows.schema).parquet(source), ["c"], sink, progress).awaitTermination()
    found = spark.read.parquet(f"{sink}/rows").drop("batch_id")
    batch = W.counter_deltas(rows, ["c"]).select(*found.columns)
    assert found.exceptAll(batch).isEmpty() and batch.exceptAll(found).isEmpty() and found.count() == 40
    assert sum(r["late"] for r in spark.read.parquet(f"{sink}/late").collect()) == 4


def test_broken_documents_are_rejected(spark):
    folder = scratch(spark, "metrics")
    files = [("a_optics_diagnostics_metrics.json", '{"interfaces": [{"if_name": "et-0/0/1"}]}'), ("b_optics_diagnostics_metrics.json", '{"interfaces": [')]
    A.write_named_files(spark.createDataFrame(files, "name string, content string"), folder)
    read = A.scan_metrics_json(spark, folder)
    assert [r["device"] for r in read["optics_diagnostics"].collect()] == ["a"]
    assert [(r["device"], r["kind"]) for r in read["rejects"].collect()] == [("b", "optics_diagnostics")]


def test_the_registry_gives_every_table_and_filters(spark):
    from opticlake.plans.registry import default_registry
    from tests import replies as R

    docs = R.docs(spark, R.LANED_REPLY)
    registry = default_registry()
    assert {"optics_diagnostics", "optics_interfaces", "chassis_inventory", "chassis_serials"} <= set(registry.entries)
    devices = spark.createDataFrame([("dev-0", "et-9/9/9")], "device string, interface_filter string")
    assert registry.run(docs)["optics_interfaces"].count() == 1 and registry.run(docs)["optics_diagnostics"].count() == R.LANES
    assert registry.run(docs, devices)["optics_interfaces"].count() == 0
    assert registry.run(docs, devices.withColumn("interface_filter", F.lit("")))["optics_diagnostics"].count() == R.LANES
