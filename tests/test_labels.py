from __future__ import annotations

from opticlake.operators import exposition as U
from opticlake.plans.collection import exposition_text


def test_labels_are_built_below_the_generator(spark):
    df = spark.createDataFrame([("et-0/0/0", 1, 2.0, None), (None, None, 3.0, 4.0)], "if_name string, lane int, rx_power double, tx_bias double")
    for text in (False, True):
        for unpivot in (U.unpivot_exposition_interface, U.unpivot_exposition_lane):
            plan = unpivot(df, text=text)._jdf.queryExecution().optimizedPlan().toString()
            assert 0 <= plan.index("Generate") < plan.index("map_from_entries")
        rows = U.unpivot_exposition_lane(df, text=text)
        rows = rows if text else rows.select("metric", U.label_text("labels").alias("labels"), "value")
        assert sorted(tuple(r) for r in rows.collect()) == [
            ("rx_power", 'interface="et-0/0/0",lane="1"', 2.0), ("rx_power", 'interface="unknown",lane="0"', 3.0),
            ("tx_bias", 'interface="unknown",lane="0"', 4.0)]


def test_lines_of_text_labels_are_those_of_maps(spark):
    """The text is made once a row: no label is put together in the plan of the lines, and they stay the same."""
    rows = [("d", 'et-0/0/1"', 3, "V", "", 1.5, None, 2.0), ("d", None, None, None, "N\n", None, 3.0, -0.0)]
    df = spark.createDataFrame(rows, "device string, if_name string, lane int, vendor string, serial_number string, rx_power double, tx_power double, tx_bias double")
    for make in (U.unpivot_exposition_interface, U.unpivot_exposition_lane):
        for options in ({}, {"escape": True, "device": True}):
            held, text = (U.exposition_lines(make(df, ["device"], **options, text=t), ["device"]) for t in (False, True))
            assert sorted(held.collect()) == sorted(text.collect()) and held.count() == 4
            assert "lambda" not in text.select("value")._jdf.queryExecution().analyzed().toString().split("Generate")[0]


def test_lines_of_a_run_have_text_labels(spark):
    optics = spark.createDataFrame([("d", "et-0/0/1", "V", 1.5, 2.0)], "device string, if_name string, vendor string, temperature double, rx_power double")
    lanes = spark.createDataFrame([("d", "et-0/0/1", 2, -1.0)], "device string, if_name string, lane int, rx_power double")
    lines = exposition_text({"interfaces": optics, "stats": optics.drop("rx_power"), "lanes": lanes})
    assert "lambda" not in lines._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert sorted(r["value"] for r in lines.collect()) == sorted([
        'temperature{interface="et-0/0/1",vendor="V"} 1.5', 'rx_power{interface="et-0/0/1",vendor="V"} 2.0',
        'temperature{interface="et-0/0/1",vendor="V"} 1.5', 'rx_power{interface="et-0/0/1",lane="2"} -1.0'])
