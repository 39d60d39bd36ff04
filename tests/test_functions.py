from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from opticlake import functions as fn


def values(spark, function, *rows):
    width = len(rows[0])
    names = [f"c{i}" for i in range(width)]
    indexed = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(indexed, "i int, " + ", ".join(f"{n} string" for n in names))
    return [r["v"] for r in df.select("i", function(*names).alias("v")).orderBy("i").collect()]


def column(spark, function, *texts):
    return values(spark, function, *[(t,) for t in texts])


def test_parse_numeric_units(spark):
    texts = ["3.25 V", "-2.5 dBm", "", None, "- Inf", "Off", "2f", "1.0d", "1_000", "1,234", " 7\t x", "1e-3", ".5", "5."]
    assert column(spark, fn.parse_numeric_units, *texts) == [
        3.25, -2.5, None, None, None, None, None, None, 1000.0, None, 7.0, 0.001, 0.5, 5.0]
    assert column(spark, lambda c: fn.parse_numeric_units(c, 9.0), "x", "1 W") == [9.0, 1.0]


def test_not_finite_numbers(spark):
    found = column(spark, fn.parse_numeric_units, "-Inf", "inf", "infinity dBm", "nan", "1_", "_1", "0x1")
    assert found[:3] == [-math.inf, math.inf, math.inf]
    assert math.isnan(found[3])
    assert found[4:] == [None, None, None]


def test_parse_numeric_commas(spark):
    assert column(spark, fn.parse_numeric_commas, "123", "1.5e-10", "1,234", "5 pps", " 8 ", "", None, "n/a") == [
        123.0, 1.5e-10, 1234.0, None, 8.0, None, None, None]


def test_parse_speed(spark):
    texts = ["400Gbps", "10gbps", "1.5Gbps", "100mbps", "64kbps", "9bps", "Auto", "", None, "xbps", " 2 Gbps "]
    assert column(spark, fn.parse_speed_bps, *texts) == [
        400_000_000_000, 10_000_000_000, 1_500_000_000, 100_000_000, 64_000, 9, None, None, None, None, 2_000_000_000]


@pytest.mark.parametrize("name, base, channel", [
    ("et-0/0/6:2", "et-0/0/6", 2), ("xe-0/0/48", "et-0/0/48", None), ("ge-0/0/1:x", "ge-0/0/1", None),
    ("xe-0/0/48:x", "et-0/0/48", None), ("et-1/2/3:4:5", "et-1/2/3", 4), ("a-xe-1", "a-xe-1", None),
])
def test_names(spark, name, base, channel):
    assert column(spark, fn.normalize_if_name, name) == [base]
    assert column(spark, fn.extract_channel, name) == [channel]


def test_module_slot(spark):
    found = column(spark, fn.parse_module_slot, "FPC 0", "pic  1", "Xcvr 32", "FPC0", "PIC 3 in FPC 2", "Fan 1", None)
    assert [tuple(s) if s else None for s in found] == [
        ("fpc", "0"), ("pic", "1"), ("port", "32"), None, ("fpc", "2"), None, None]


def test_build_if_name(spark):
    def build(platform):
        return fn.build_if_name(F.lit("1"), F.lit("2"), F.lit("3"), platform)

    # The first listed key that the platform contains wins: `ex` comes before `ex4300` and `ex4600`.
    assert column(spark, build, "qfx5240", "MX960", "QFX5110-48s", "ex4300", "ex4600", "other", None) == [
        "et-1/2/3", "et-1/2/3", "xe-1/2/3", "xe-1/2/3", "xe-1/2/3", "et-1/2/3", "et-1/2/3"]


def test_fiber(spark):
    multi, single = "FIBER_TYPE_MULTI_MODE", "FIBER_TYPE_SINGLE_MODE"
    assert column(spark, fn.map_fiber_mode, "Multi Mode", "50um MM", "Single Mode", "SM", "n/a", "NONE", "", None, "x") == [
        multi, multi, single, single, None, None, None, None, None]
    def classify(media, text, wave):
        return fn.classify_fiber_type(media, text, F.col(wave).cast("int"))

    rows = [("100GBASE-SR4", None, None), ("10GBASE-LR", None, None), (None, None, "850"), (None, None, "1310"),
            ("SR", None, "1550"), (None, "short haul", "700"), ("ETHERNET", None, None), (None, None, None),
            ("multi mode", None, "0"), (None, "long", None)]
    assert values(spark, classify, *rows) == [multi, single, multi, single, single, multi, single, None, multi, single]


def test_placeholders_profile_status(spark):
    assert column(spark, fn.cleanse_placeholders, "N/A", "na", "None", "", " n/a", "X") == [None] * 4 + [" n/a", "X"]
    assert column(spark, lambda c: fn.cleanse_placeholders(c, ["0.0"]), "0.0", "1.0") == [None, "1.0"]
    assert column(spark, fn.device_profile, "qfx5240", "", None) == ["JUNIPER_QFX5240", None, None]
    assert column(spark, fn.status_to_gauge, "up", "Up", "down", "", None) == [1, 0, 0, 0, None]


def test_run_time_columns(spark):
    df = spark.createDataFrame([(1706342400 + 5 * 3600,)], "timestamp long")
    assert fn.run_time_columns(df).first()[1:] == ("2024-01-27T13:00:00Z", "2024-01-27", "13")


def test_short_way_for_plain_numbers_reads_the_same(spark):
    """Odd texts are none of its business: each gives what the long way gives."""
    from opticlake.functions import text as X

    rows = ["5", "+5.25 V", "-0", "-.5", ".5", "1.", ".", "", " ", " 7", "7\t8", "7\n", "7\x01", "\x017", "1d", "2F", "0x1p3", "1_000", "1e3", "1E-2x", "- Inf", "-inf",
            "+nan", "Infinity", "12,5", "1.2.3", "--1", "\u0663", "5\u00a0C", "9" * 400, None]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    for short, end in ((X.parse_numeric_units, X._FIRST_WORD), (X.parse_number, X._WHOLE)):
        found = df.select("t", short("t").alias("a"), X._number(F.col("t"), end).alias("b")).collect()
        assert [(r["t"], str(r["a"])) for r in found] == [(r["t"], str(r["b"])) for r in found]
    held = df.select(X._plain_or(F.col("t"), F.col("t"), X._WHOLE).alias("a")).collect()
    assert [str(r["a"]) for r in held[:6]] == ["5.0", "None", "-0.0", "-0.5", "0.5", "1.0"]
