from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake import schemas as S
from opticlake.operators import extract as X
from opticlake.plans import extraction as E
from opticlake.plans.extraction import INTERFACE_MAPPING, LANE_MAPPING
from tests import replies as R


def test_known_reply_with_lanes(spark):
    docs = R.docs(spark, R.LANED_REPLY)
    row = X.extract_optics_interface(docs).collect()
    assert [r["if_name"] for r in row] == [R.PORT]
    assert [row[0][f] for f in C.THRESHOLD_TAGS] == R.THRESHOLDS
    assert [row[0][m] for m in C.INTERFACE_MEASURES] == [R.TEMPERATURE, R.VOLTAGE, None, None, None, None, None]
    lanes = X.extract_optics_lanes(docs).collect()
    assert sorted(tuple(r[c] for c in ("device", "if_name", "lane", *C.LANE_TAGS)) for r in lanes) == [
        ("dev-0", R.PORT, lane, *R.lane_values(lane)) for lane in range(R.LANES)]


def test_known_reply_without_lanes(spark):
    docs = R.docs(spark, R.UNLANED_REPLY)
    row = X.extract_optics_interface(docs).first()
    assert [row[f] for f in C.THRESHOLD_TAGS] == R.THRESHOLDS
    # The temperature is the attribute, not the text; rx comes from the fallback tags.
    assert [row[m] for m in C.INTERFACE_MEASURES] == [R.TEMPERATURE, R.VOLTAGE, *R.SENT.values(), *R.FALLBACKS.values()]
    assert X.extract_optics_lanes(docs).isEmpty()


def test_mapping_equals_extractors(spark):
    docs = R.docs(spark, R.LANED_REPLY)
    by_mapping = X.extract_by_mapping(docs, INTERFACE_MAPPING, "physical-interface").first().asDict()
    by_code = X.extract_optics_interface(docs).first().asDict()
    assert by_mapping == {k: by_code[k] for k in by_mapping}
    lane = "physical-interface/optics-diagnostics/optics-diagnostics-lane-values"
    mapped, coded = X.extract_by_mapping(docs, LANE_MAPPING, lane), X.extract_optics_lanes(docs)
    assert sorted(mapped.select(*coded.columns).collect()) == sorted(coded.collect())


def test_replies_that_do_not_parse(spark):
    docs = R.docs(spark, R.LANED_REPLY, R.LANED_REPLY[:-20], "", None, "no xml at all", "<rpc-reply/>")
    good, rejects = X.quarantine_malformed(docs, S.OPTICS_LANE_REPLY)
    assert {r["device"] for r in good.collect()} == {"dev-0", "dev-5"}
    assert {r["device"]: r["reason"] for r in rejects.collect()} == {
        "dev-1": "malformed", "dev-2": "empty", "dev-3": "missing", "dev-4": "malformed"}
    assert X.extract_optics_lanes(docs).count() == R.LANES


@pytest.mark.parametrize("body, expected", [
    ("<optics-diagnostics><optic-diagnostics-not-available/></optics-diagnostics>", None),
    ("", None),
    ("<optics-diagnostics/>", (None, None)),
    ("<optics-diagnostics><module-voltage>1</module-voltage><module-voltage>2</module-voltage></optics-diagnostics>",
     (1.0, None)),
    ("<optics-diagnostics><module-voltage/><module-voltage>2</module-voltage></optics-diagnostics>", (None, None)),
    ("<optics-diagnostics><laser-rx-optical-power-dbm>- Inf</laser-rx-optical-power-dbm>"
     "<rx-signal-avg-optical-power-dbm>-1</rx-signal-avg-optical-power-dbm></optics-diagnostics>", (None, None)),
    ("<optics-diagnostics><laser-rx-optical-power-dbm/>"
     "<rx-signal-avg-optical-power-dbm>-1</rx-signal-avg-optical-power-dbm></optics-diagnostics>", (None, -1.0)),
    ("<optics-diagnostics><module-voltage><![CDATA[3 V]]></module-voltage><!-- c --></optics-diagnostics>", (3.0, None)),
])
def test_interface_edges(spark, body, expected):
    rows = X.extract_optics_interface(R.docs(spark, R.optics_reply(R.interface("a", body)))).collect()
    assert [(r["voltage"], r["rx_power"]) for r in rows] == ([expected] if expected else [])


def test_lane_edges(spark):
    def lane(index):
        return f"<optics-diagnostics-lane-values>{index}</optics-diagnostics-lane-values>"

    body = "<optics-diagnostics>" + lane("") + lane("<lane-index>3</lane-index>") + lane(
        "<lane-index>x</lane-index>") + "</optics-diagnostics>"
    nameless = f"<physical-interface>{body}</physical-interface>"
    rows = X.extract_optics_lanes(R.docs(spark, R.optics_reply(nameless))).collect()
    assert [(r["if_name"], r["lane"]) for r in rows] == [("unknown", 0), ("unknown", 3), ("unknown", None)]


def test_wrappers_and_prefixes(spark):
    plain = R.LANED_REPLY
    inner = plain[plain.index("<interface-information"):plain.index("</rpc-reply>")].replace(
        "<interface-information", '<interface-information xmlns:u="urn:u"')
    engines = ("<rpc-reply><multi-routing-engine-results><multi-routing-engine-item>" + inner
               + "</multi-routing-engine-item></multi-routing-engine-results></rpc-reply>")
    prefixed = plain.replace("</", "<//").replace("<", "<p:").replace("<p://", "</p:").replace(
        "<p:rpc-reply", '<p:rpc-reply xmlns:p="urn:p"')
    docs = R.docs(spark, plain, inner, engines, prefixed)
    assert X.extract_optics_lanes(docs).groupBy("device").count().count() == 4
    assert X.extract_optics_lanes(docs).drop("device").distinct().count() == R.LANES


def test_filter_and_metadata(spark):
    reply = R.optics_reply(R.interface("et-0/0/1", R.WITHOUT_LANES), R.interface("et-0/0/1:0", R.WITHOUT_LANES))
    docs = R.docs(spark, reply)
    rows = X.extract_optics_interface(docs, {"voltage": 9.0, "site": "s"}, ["et-0/0/1:0"]).collect()
    assert [(r["if_name"], r["voltage"], r["site"]) for r in rows] == [("et-0/0/1:0", 9.0, "s")]
    per_device = spark.createDataFrame([("dev-0", "hall")], "device string, site string")
    assert {r["site"] for r in X.extract_optics_interface(docs, per_device).collect()} == {"hall"}


def stats_interface(name, fec, extra=""):
    return (f"<physical-interface><name>{name}</name><speed>100Gbps</speed><admin-status>up</admin-status>{extra}"
            f"<ethernet-fec-statistics>{fec}</ethernet-fec-statistics></physical-interface>")


def test_stats(spark):
    reply = R.optics_reply(
        stats_interface(" et-0/0/0 ", "<fec_ccw_count>1,234</fec_ccw_count><pre-fec-ber>1.5e-10</pre-fec-ber>"),
        stats_interface("et-0/0/1", "<fec_nccw_count>n/a</fec_nccw_count>"),
        stats_interface("et-0/0/2", "<fec_ccw_count/>"),
        stats_interface("", "<fec_ccw_count>1</fec_ccw_count>"),
    )
    rows = {r["if_name"]: r for r in X.extract_interface_stats(R.docs(spark, reply)).collect()}
    assert set(rows) == {"et-0/0/0", "et-0/0/1"}
    assert rows["et-0/0/0"]["fec_ccw"] == 1234.0 and rows["et-0/0/0"]["pre_fec_ber"] == 1.5e-10
    assert rows["et-0/0/0"]["speed_bps"] == 100_000_000_000 and rows["et-0/0/0"]["oper_status"] is None
    assert rows["et-0/0/1"]["fec_nccw"] is None


def test_histogram(spark):
    def node(n, live, harvest=None):
        tail = f"<sym-harvest-err>{harvest}</sym-harvest-err>" if harvest is not None else ""
        return (f"<ethernet-fechistogram-statistics><bin-num>{n}</bin-num><sym-live-err>{live}</sym-live-err>{tail}"
                "</ethernet-fechistogram-statistics>")

    reply = R.optics_reply(stats_interface("a", "<fec_ccw_count>1</fec_ccw_count>", "".join(
        [node(0, 1, 2), node(3, 9, 9), node("3.0", "x", 4), node(17, 5), node("?", 1)])))
    bins = X.extract_fec_histogram(R.docs(spark, reply))
    assert {r["bin"]: (r["live"], r["harvest"], r["total"]) for r in bins.collect()} == {
        0: (1.0, 2.0, 3.0), 3: (0.0, 4.0, 4.0), 17: (5.0, 0.0, 5.0)}
    wide = X.pivot_fec_histogram(bins).first()
    assert wide["histogram_bin_0"] == 3.0 and wide["histogram_bin_3_harvest"] == 4.0
    assert wide["histogram_bin_1"] is None and "histogram_bin_17" not in wide.asDict()


def test_system(spark):
    body = ("<system-information><host-name>h</host-name><hardware-model>m1</hardware-model><os-name>o</os-name>"
            "</system-information>")
    docs = R.docs(spark, f"<rpc-reply>{body}</rpc-reply>", body, "<rpc-reply><host-name>x</host-name></rpc-reply>",
                  "<broken", f"<rpc-reply>{body.replace('<host-name>h</host-name>', '')}</rpc-reply>")
    rows = {r["device"]: (r["origin_hostname"], r["device_profile"], r["os_version"])
            for r in X.extract_system_info(docs).collect()}
    assert rows == {"dev-0": ("h", "JUNIPER_M1", None), "dev-1": ("h", "JUNIPER_M1", None), "dev-2": (None, None, None),
                    "dev-3": (None, None, None), "dev-4": ("dev-4", "JUNIPER_M1", None)}


CHASSIS = """<rpc-reply><chassis-inventory><chassis><serial-number></serial-number></chassis><chassis>
<serial-number>S1</serial-number><chassis-module><name>Fan 1</name></chassis-module>
<chassis-module><name>FPC 1</name><chassis-sub-module><name>PIC 0</name>
<chassis-sub-sub-module><name>Xcvr 5</name><serial-number>A</serial-number></chassis-sub-sub-module>
<chassis-sub-sub-module><name>Xcvr 6</name><serial-number>BUILTIN</serial-number></chassis-sub-sub-module>
<chassis-sub-sub-module><name>Xcvr 5</name><serial-number>B</serial-number></chassis-sub-sub-module>
</chassis-sub-module><chassis-sub-module><name>My PIC 1</name></chassis-sub-module></chassis-module>
</chassis></chassis-inventory></rpc-reply>"""


def test_chassis(spark):
    docs = R.docs(spark, CHASSIS, "<broken")
    serials, transceivers = X.extract_chassis_inventory(docs, F.lit("ex4300"))
    assert {r["device"]: r["origin_name"] for r in serials.collect()} == {"dev-0": "S1", "dev-1": None}
    # `Xcvr 5` is listed twice: the later one counts. A placeholder serial keeps its row.
    assert {(r["if_name"], r["serial_number"]) for r in transceivers.collect()} == {("xe-1/0/5", "B"), ("xe-1/0/6", None)}
    # Slots are found by names that contain FPC and PIC, not only by those that start with them.
    assert {(r["fpc"], r["pic"]) for r in X.discover_slots(docs).collect()} == {(1, 0), (1, 1)}


def test_ports(spark):
    def port(number, **leaves):
        return f"<port><port-number>{number}</port-number>" + "".join(
            f"<{k}>{v}</{k}>" for k, v in leaves.items()) + "</port>"

    reply = "<rpc-reply><fpc-information><fpc><pic-detail>" + "".join([
        port(1, **{"cable-type": "100G LR4", "fiber-mode": "SM", "sfp-vendor-name": "n/a", "sfp-vendor-fw-ver": "0.0"}),
        port(2, **{"cable-type": "N/A"}),
        port("", **{"cable-type": "x"}),
        port(3, wavelength="850nm"), port(3, wavelength="1310nm"),
    ]) + "</pic-detail></fpc></fpc-information></rpc-reply>"
    docs = R.docs(spark, reply).withColumns({"fpc": F.lit(0), "pic": F.lit(1)})
    rows = {r["if_name"]: r for r in X.extract_pic_ports(docs).collect()}
    assert set(rows) == {"et-0/1/1", "et-0/1/3"}
    one = rows["et-0/1/1"]
    assert (one["cable_type"], one["media_type"], one["fiber_type"], one["vendor"], one["firmware_version"]) == (
        "100G LR4", "100G LR4", "FIBER_TYPE_SINGLE_MODE", None, None)
    assert rows["et-0/1/3"]["wavelength"] == "1310nm"


def test_each_reply_is_parsed_once(spark):
    for df in (X.extract_optics_interface(R.docs(spark, R.LANED_REPLY)), X.extract_optics_lanes(R.docs(spark, R.LANED_REPLY))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml(") == 1
        assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_mapping_file(spark):
    from opticlake.session import scratch

    path = scratch(spark, "mapping")
    spark.createDataFrame([(line,) for line in [*LANE_MAPPING, ""]], "value string").coalesce(1).write.text(path)
    lane = "physical-interface/optics-diagnostics/optics-diagnostics-lane-values"
    lines = X.read_mapping(spark, path)
    assert sorted(lines) == sorted(LANE_MAPPING)
    found = X.extract_by_mapping(R.docs(spark, R.LANED_REPLY), lines, lane).collect()
    assert sorted(r["tx_bias"] for r in found) == [R.lane_values(lane)[-1] for lane in range(R.LANES)]


def test_replies_are_parsed_by_what_is_read(spark, monkeypatch):
    monkeypatch.setattr(E.V, "optics_docs", lambda spark, sf: R.docs(spark, R.LANED_REPLY))
    for name in ("extract_temperature_attr", "coalesce_rx_power"):
        plan = getattr(E, name)(spark, "")._jdf.queryExecution().analyzed().toString()
        assert re.search("(?i)from_?xml|xmltostructs", plan) and "high-alarm" not in plan


def test_generated_methods_stay_compiled(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_both_optics_tables_of_one_parse(spark):
    docs = R.docs(spark, R.LANED_REPLY, R.UNLANED_REPLY, "<broken", None)
    interfaces, lanes = X.optics_tables(docs)
    for found, alone in ((interfaces, X.extract_optics_interface(docs)), (lanes, X.extract_optics_lanes(docs))):
        assert found.schema.simpleString() == alone.schema.simpleString()
        assert alone.count() and sorted(found.collect(), key=str) == sorted(alone.collect(), key=str)
