"""Joins that add device and transceiver metadata.

The sides that describe devices and transceivers are made unique per key and run,
and a row takes what was known at its run, so no join adds rows. None is broadcast by hint: the optimizer does so where it
measures a small side, and splits skewed partitions of the other joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.functions import filled, normalize_if_name
from opticlake.operators.as_of import join_all_as_of, join_as_of
from opticlake.operators.joins import join_per_key, unique_per_key

BASE = "_base"


def _run(df: DataFrame) -> list[str]:
    return [c for c in ("run_timestamp",) if c in df.columns]


def _fill_from(df: DataFrame, right: DataFrame, keys: list[str], columns: list[str], keep_old: bool = False) -> DataFrame:
    """Left join; a non-empty new value replaces the old one, or the reverse with `keep_old`."""
    return _fill(join_as_of(df, _renamed(right, keys, columns), keys), columns, keep_old)


def _renamed(right: DataFrame, keys: list[str], columns: list[str], mark: str = "_new") -> DataFrame:
    return right.select(*keys, *_run(right), *[F.col(c).alias(f"{mark}_{c}") for c in columns])


def _fill(joined: DataFrame, columns: list[str], keep_old: bool = False, mark: str = "_new") -> DataFrame:
    merged = {}
    for c in columns:
        new = filled(f"{mark}_{c}")
        old = F.col(c) if c in joined.columns else F.lit(None).cast("string")
        merged[c] = F.coalesce(old, new) if keep_old else F.coalesce(new, old)
    return joined.withColumns(merged).drop(*[f"{mark}_{c}" for c in columns])


def enrich_device_metadata(df: DataFrame, system: DataFrame, serials: DataFrame) -> DataFrame:
    """Host name, profile, serial and inventory name of the device; empty ones change nothing."""
    facts = system.withColumn("inventory_instance", F.col("device"))
    rows = _fill_from(df, facts, ["device"], ["origin_hostname", "device_profile", "inventory_instance"])
    return _fill_from(rows, serials, ["device"], ["origin_name"])


def _by_base(facts: DataFrame, columns: list[str]) -> DataFrame:
    return facts.select("device", F.col("if_name").alias(BASE), *_run(facts), *columns)


def enrich_transceiver(df: DataFrame, ports: DataFrame) -> DataFrame:
    """Eight transceiver columns from the port details of the base interface."""
    rows = df.withColumn(BASE, normalize_if_name("if_name"))
    return _fill_from(rows, _by_base(ports, C.TRANSCEIVER_COLUMNS), ["device", BASE], C.TRANSCEIVER_COLUMNS).drop(BASE)


def serial_precedence(df: DataFrame, chassis: DataFrame) -> DataFrame:
    """The serial already present, from the ports, goes before the chassis one."""
    rows = df.withColumn(BASE, normalize_if_name("if_name"))
    return _fill_from(rows, _by_base(chassis, ["serial_number"]), ["device", BASE], ["serial_number"], keep_old=True).drop(BASE)


def enrich_ports(df: DataFrame, ports: DataFrame, chassis: DataFrame) -> DataFrame:
    """`enrich_transceiver` and then `serial_precedence`, with one exchange of the rows for both."""
    keys = ["device", BASE]
    sides = [_renamed(_by_base(ports, C.TRANSCEIVER_COLUMNS), keys, C.TRANSCEIVER_COLUMNS, "_port"),
             _renamed(_by_base(chassis, ["serial_number"]), keys, ["serial_number"], "_chassis")]
    joined = join_all_as_of(df.withColumn(BASE, normalize_if_name("if_name")), sides, keys)
    return _fill(_fill(joined, C.TRANSCEIVER_COLUMNS, mark="_port"), ["serial_number"], True, "_chassis").drop(BASE)


def channel_fanout(df: DataFrame, xcvr: DataFrame, on: list[str] = ("device",)) -> DataFrame:
    """Every channel `et-x:0..n` gets the row of its one transceiver; the row count stays."""
    values = [c for c in xcvr.columns if c not in (*on, "if_name")]
    right = unique_per_key(xcvr.select(*on, F.col("if_name").alias(BASE), *values), [*on, BASE])
    return join_per_key(df.withColumn(BASE, normalize_if_name("if_name")), right, [*on, BASE]).drop(BASE)


def enrich_lake_chassis(df: DataFrame, chassis: DataFrame) -> DataFrame:
    """Lake rule: part number from the chassis, else the interface; serial from the chassis alone."""
    parts = F.col("part_number") if "part_number" in chassis.columns else F.lit(None).cast("string")
    right = chassis.select("device", F.col("if_name").alias(BASE), *_run(chassis), parts.alias("_part"),
                           F.col("serial_number").alias("_serial"))
    own = F.col("part_number") if "part_number" in df.columns else F.lit(None).cast("string")
    rows = df.withColumns({BASE: normalize_if_name("if_name"), "part_number": own})
    return join_as_of(rows, right, ["device", BASE]).withColumns({
        "part_number": F.coalesce(filled("_part"), "part_number", F.lit("")),
        "serial_number": F.coalesce("_serial", F.lit("")),
    }).drop(BASE, "_part", "_serial")


def assemble_device_bundle(system: DataFrame, chassis: DataFrame, optics: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per device, and run where all documents carry one, that is seen in any of the four, with its facts as of that run.

    Host name and serial default to the device; a system document replaces the
    host name and profile, a chassis document the serial, even by NULL.
    """
    run = ["run_timestamp"] if all("run_timestamp" in df.columns for df in (system, chassis, optics, stats)) else []
    keys = ["device", *run]

    def present(df: DataFrame, flag: str) -> DataFrame:
        return df.select(*keys).withColumn("_flag", F.lit(flag))

    seen = present(system, "system")
    for df, flag in ((chassis, "chassis"), (optics, "optics"), (stats, "stats")):
        seen = seen.unionByName(present(df, flag))
    devices = seen.groupBy(*keys).agg(*[F.max(F.col("_flag") == flag).alias(f"has_{flag}") for flag in ("optics", "stats")])
    facts = system.select("device", *_run(system), F.col("origin_hostname").alias("_host"), F.col("device_profile").alias("_profile"),
                          F.lit(True).alias("_system"))
    serial = chassis.select("device", *_run(chassis), F.col("origin_name").alias("_serial"), F.lit(True).alias("_chassis"))
    rows = join_all_as_of(devices, [facts, serial], ["device"]).withColumns(
        {f"has_{flag}": F.coalesce(f"_{flag}", F.lit(False)) for flag in ("system", "chassis")})
    return rows.select(
        *keys,
        # A system document without host name is a failed one: it holds the device alone and changes nothing.
        F.coalesce("_host", "device").alias("origin_hostname"),
        F.when(F.col("has_chassis"), F.col("_serial")).otherwise(F.col("device")).alias("origin_name"),
        F.when(F.col("has_system"), F.col("device")).alias("inventory_instance"),
        F.col("_profile").alias("device_profile"),
        "has_system", "has_chassis", "has_optics", "has_stats",
    )


def join_counters_lanes(counters: DataFrame, lanes: DataFrame, partitions: tuple[str, ...] = ("dt", "hr")) -> DataFrame:
    """Counters and lanes of the same device, interface and run; partition columns join too, so pruning carries over."""
    shared = [c for c in partitions if c in counters.columns and c in lanes.columns]
    keys = ["device", "if_name", "timestamp", *shared]
    rest = [c for c in lanes.columns if c in keys or c not in counters.columns]
    return counters.join(lanes.select(*rest), keys)


def training_frame(interfaces: DataFrame, lanes: DataFrame, counters: DataFrame,
                   keys: list[str] = ("device", "if_name", "timestamp")) -> DataFrame:
    """One feature row per interface and run: its own columns, lane statistics, counters."""
    stats = [f(m).alias(f"{m}_{name}") for m in ("rx_power", "tx_power", "tx_bias")
             for name, f in (("min", F.min), ("avg", F.avg), ("max", F.max))]
    per_interface = lanes.groupBy(*keys).agg(*stats, F.count("*").alias("lane_count"))
    only = [c for c in counters.columns if c in keys or c not in interfaces.columns]
    return join_per_key(interfaces.join(counters.select(*only), list(keys), "left"), per_interface, list(keys))
