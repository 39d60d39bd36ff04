from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.operators import aggregate as G
from opticlake.operators import enrich as J
from opticlake.operators import exposition as U
from opticlake.operators import filters as P
from opticlake.plans.collection import collect_run, exposition_text, hourly_datasets
from tests import replies as R
from tests.test_extract import CHASSIS, stats_interface


def lines(df, lane=False):
    samples = U.unpivot_exposition_lane(df) if lane else U.unpivot_exposition_interface(df)
    return {r["value"] for r in U.exposition_lines(samples).collect()}


def test_interface_without_lanes(spark):
    df = spark.createDataFrame([("xe-0/0/3", 39.0, 3.296, 6.904, None, "up", "")],
                               "if_name string, temperature double, voltage double, tx_bias double, tx_power double, "
                               "admin_status string, vendor string")
    assert lines(df) == {'temperature{interface="xe-0/0/3"} 39.0', 'voltage{interface="xe-0/0/3"} 3.296',
                         'tx_bias{interface="xe-0/0/3"} 6.904', 'interface_admin_status{interface="xe-0/0/3"} 1.0'}


def test_lanes_and_labels(spark):
    df = spark.createDataFrame([("xe-0/0/48", 0, 6.1, "h", "V"), ("xe-0/0/48", 1, 6.2, None, ""), (None, None, 1.0, None, None)],
                               "if_name string, lane int, tx_bias double, origin_hostname string, vendor string")
    assert lines(df, lane=True) == {
        'tx_bias{interface="xe-0/0/48",lane="0",origin_hostname="h",vendor="V"} 6.1',
        'tx_bias{interface="xe-0/0/48",lane="1"} 6.2', 'tx_bias{interface="unknown",lane="0"} 1.0'}


def test_all_thresholds_and_bins(spark):
    names = [*C.THRESHOLD_TAGS, *[f"histogram_bin_{i}" for i in range(C.HISTOGRAM_BINS)], *C.PREFIXED_MEASURES]
    df = spark.createDataFrame([("a", *[float(i) for i in range(len(names))])],
                               "if_name string, " + ", ".join(f"{n} double" for n in names))
    found = {line.split("{")[0] for line in lines(df)}
    assert found == {*C.THRESHOLD_TAGS, *[f"interface_fec_histogram_bin_{i}" for i in range(16)],
                     *[f"interface_{m}" for m in C.PREFIXED_MEASURES]}


def test_escaping_and_device_label(spark):
    df = spark.createDataFrame([('a"b\\', "d", 1.0)], "if_name string, device string, voltage double")
    raw = U.label_text(U.exposition_labels(df, False))
    safe = U.label_text(U.exposition_labels(df, False, escape=True, device=True))
    assert df.select(raw, safe).first()[:] == ('interface="a"b\\"', 'device="d",interface="a\\"b\\\\"')


def test_empty_input_gives_no_lines(spark):
    assert lines(spark.createDataFrame([], "if_name string, voltage double")) == set()


def test_joins_keep_the_row_count(spark):
    lanes = spark.createDataFrame([("d", f"et-0/0/1:{i}", i) for i in range(4)] + [("d", "xe-0/0/1", 9), (None, "et-0/0/1", 1)],
                                  "device string, if_name string, lane int")
    ports = spark.createDataFrame([("d", "et-0/0/1", "V", "P", None), ("d", "et-0/0/1", "V", "P", None)],
                                  "device string, if_name string, vendor string, part_number string, serial_number string")
    ports = ports.withColumns({c: F.lit("").alias(c) for c in C.TRANSCEIVER_COLUMNS if c not in ports.columns})
    chassis = spark.createDataFrame([("d", "et-0/0/1", "S")], "device string, if_name string, serial_number string")
    rows = J.serial_precedence(J.enrich_transceiver(lanes, ports), chassis).collect()
    assert len(rows) == 6
    assert {(r["device"], r["vendor"], r["serial_number"], r["cable_type"]) for r in rows} == {
        ("d", "V", "S", None), (None, None, None, None)}
    assert J.channel_fanout(lanes, ports).count() == 6


def test_serial_of_the_port_goes_first(spark):
    df = spark.createDataFrame([("d", "et-0/0/1", "PORT"), ("d", "et-0/0/2", None)], "device string, if_name string, serial_number string")
    chassis = spark.createDataFrame([("d", "et-0/0/1", "C1"), ("d", "et-0/0/2", "C2")], df.schema)
    assert {r["serial_number"] for r in J.serial_precedence(df, chassis).collect()} == {"PORT", "C2"}


@pytest.mark.parametrize("own, common, kept", [
    ("", "a", {"a", "b", "c:1"}), (None, "a", {"a"}), (None, None, {"a", "b", "c:1"}), (None, "", {"a", "b", "c:1"}),
    ("b, \n c:1", "a", {"b", "c:1"}), ("c", "a", set()),
])
def test_filter_precedence(spark, own, common, kept):
    rows = spark.createDataFrame([("d", n) for n in ("a", "b", "c:1")], "device string, if_name string")
    devices = spark.createDataFrame([("d", own)], "device string, interface_filter string")
    assert {r["if_name"] for r in P.resolve_filter_precedence(rows, devices, common).collect()} == kept


def test_filter_lists(spark):
    rows = spark.createDataFrame([("a",), ("a:0",), ("b",)], "if_name string")
    assert {r[0] for r in P.filter_interfaces(rows, " a:0 , b").collect()} == {"a:0", "b"}
    assert P.filter_interfaces(rows, None).count() == 3


def test_valid_and_rejected_lanes(spark):
    lanes = spark.createDataFrame(
        [("a", 0, 1.0, 1.0, 1.0), ("", 0, 1.0, 1.0, 1.0), (None, None, 1.0, None, 1.0), ("b", 1, None, 2.0, 3.0)],
        "if_name string, lane int, tx_bias double, tx_power double, rx_power double")
    valid, rejects = P.split_valid_lanes(lanes)
    assert valid.count() + rejects.count() == lanes.count()
    assert {r["reason"] for r in rejects.collect()} == {"missing if_name", "missing if_name,lane,tx_power", "missing tx_bias"}


def test_percentile_helpers_agree(spark):
    df = spark.createDataFrame([("d", "i", float(i), i) for i in range(11)], "device string, if_name string, x double, ts long")
    events = spark.createDataFrame([("d", 4)], "device string, event_time long")
    row = G.rma_comparison(df, events, ["x"]).first()
    assert (row["before_x_count"], row["after_x_count"], row["before_x_p50"], row["x_change"]) == (4, 7, 1.5, 5.5)
    fleet = df.withColumns({"vendor": F.lit(None).cast("string"), "part_number": F.lit("p"), "fiber_type": F.lit("f")})
    exact, rough = G.vendor_fleet_stats(fleet, ["x"]).first(), G.vendor_fleet_stats(fleet, ["x"], approximate=True).first()
    assert exact["x_p50"] == rough["x_p50"] == 5.0 and exact["interfaces"] == rough["interfaces"] == 1


def test_whole_run(spark):
    """Replies of two devices to lake rows and exposition text; one device fails on a nameless interface."""
    system = R.docs(spark, "<rpc-reply><system-information><host-name>h0</host-name><hardware-model>m</hardware-model>"
                           "</system-information></rpc-reply>", "<broken")
    chassis = R.docs(spark, CHASSIS.replace("FPC 1", "FPC 2").replace("Xcvr 5", "Xcvr 9"), "<broken")
    optics = R.docs(spark, R.LANED_REPLY, R.LANED_REPLY)
    stats = R.docs(spark, *[R.optics_reply(stats_interface(R.PORT, "<fec_ccw_count>5</fec_ccw_count>"))] * 2)
    ports = spark.createDataFrame([("dev-0", R.PORT)], "device string, if_name string").withColumns(
        {c: F.lit(c.upper()) for c in C.TRANSCEIVER_COLUMNS if c != "serial_number"}).withColumn(
        "serial_number", F.lit(None).cast("string"))
    devices = spark.createDataFrame([("dev-0", None), ("dev-1", "")], "device string, interface_filter string")
    bundle = collect_run(system, chassis, optics, stats, ports, devices)
    datasets, failed = hourly_datasets(bundle, 1700000000)
    assert failed.isEmpty()
    dom = {r["inventory_instance"]: r for r in datasets["interface_dom"].collect()}
    assert datasets["interface_dom"].columns == C.INTERFACE_DOM_COLUMNS
    assert (dom["dev-0"]["origin_hostname"], dom["dev-0"]["origin_name"], dom["dev-0"]["serial_number"],
            dom["dev-0"]["part_number"], dom["dev-0"]["vendor"]) == ("h0", "S1", "B", "PART_NUMBER", "VENDOR")
    assert (dom["dev-1"]["origin_hostname"], dom["dev-1"]["origin_name"], dom["dev-1"]["device_profile"]) == ("dev-1", None or "", None)
    assert dom["dev-0"]["collection_timestamp"] == "2023-11-14T22:13:20Z"
    assert datasets["lane_dom"].columns == C.LANE_DOM_COLUMNS and datasets["lane_dom"].count() == 2 * R.LANES
    assert datasets["interface_counters"].columns == C.INTERFACE_COUNTERS_COLUMNS
    text = exposition_text(bundle).collect()
    assert any(r["value"].startswith('rx_power{interface="et-2/0/9",lane="0",origin_hostname="h0",device_profile="JUNIPER_M",'
                                     'origin_name="S1",vendor="VENDOR"') and r["instance"] == "dev-0" for r in text)

    nameless = dict(bundle, interfaces=bundle["interfaces"].withColumn(
        "if_name", F.when(F.col("device") != "dev-1", F.col("if_name"))))
    datasets, failed = hourly_datasets(nameless, 1700000000)
    assert [r["device"] for r in failed.collect()] == ["dev-1"]
    assert all(df.select("inventory_instance").distinct().collect() == [("dev-0",)] for df in datasets.values())
    summary = {r["device"]: r["exit_status"] for r in G.run_summary(
        {"interfaces": bundle["interfaces"]}, failed).collect()}
    assert summary == {"dev-0": 0, "dev-1": 1, None: 1}


def test_a_dataset_reads_the_parsed_replies_once(spark):
    """Failed devices and device facts are worked out once, not by each dataset from the interface rows again."""
    nothing = R.docs(spark, "<rpc-reply/>")
    stats = R.docs(spark, R.optics_reply(stats_interface(R.PORT, "<fec_ccw_count>5</fec_ccw_count>")))
    ports = spark.createDataFrame([("dev-0", R.PORT)], "device string, if_name string").withColumns(
        {c: F.lit(c.upper()) for c in C.TRANSCEIVER_COLUMNS})
    devices = spark.createDataFrame([("dev-0", None)], "device string, interface_filter string")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "500")
    try:
        datasets, _ = hourly_datasets(collect_run(nothing, nothing, R.docs(spark, R.LANED_REPLY), stats, ports, devices), 1700000000)
        plan = datasets["lane_dom"]._jdf.queryExecution().simpleString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert datasets["lane_dom"].count() == R.LANES
    assert plan.count("/optics-") == 1
