"""Interface filters, row validity and the fixed dataset projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake import constants as C
from opticlake.functions import filled, run_time_columns
from opticlake.operators.as_of import changes, join_as_of
from opticlake.operators.enrich import enrich_lake_chassis
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize


def name_list(text: str | Column) -> Column:
    """Comma list to trimmed names."""
    c = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(c, ","), lambda name: F.regexp_replace(name, r"^\s+|\s+$", ""))


def filter_interfaces(df: DataFrame, names: str | DataFrame | None, on: str = "if_name") -> DataFrame:
    """Keep exact full names, channel included; no list keeps all."""
    if isinstance(names, DataFrame):
        return df.join(names.select(on), on, "left_semi")
    if not names:
        return df
    return df.where(F.col(on).isin([name.strip() for name in names.split(",")]))


def resolve_filter_precedence(df: DataFrame, devices: DataFrame, global_filter: str | None = None) -> DataFrame:
    """The device's filter if it has one (empty means all), else the global one, else all."""
    wanted = F.coalesce("interface_filter", F.lit(global_filter), F.lit(""))
    # A device that is listed twice has one filter: the largest text, so that an empty one does not undo a real one.
    filters = devices.groupBy("device").agg(F.max("interface_filter").alias("interface_filter")).select(
        "device", wanted.alias("_filter"), name_list(wanted).alias("_names"))
    rows = join_per_key(df, filters, ["device"])
    whole = F.coalesce(F.col("_filter"), F.lit(global_filter), F.lit(""))
    names = F.coalesce(F.col("_names"), name_list(F.lit(global_filter)))
    return rows.where((whole == "") | F.array_contains(names, F.col("if_name"))).drop("_filter", "_names")


def split_valid_lanes(lanes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lanes with a name, an index and all three measures; the rest with the reason)."""
    tests = {
        "if_name": filled("if_name").isNull(),
        "lane": F.col("lane").isNull(),
        **{c: F.col(c).isNull() for c in ("tx_bias", "tx_power", "rx_power")},
    }
    missing = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    rejects = lanes.withColumn("reason", F.concat(F.lit("missing "), F.array_join(missing, ",")))
    valid = lanes
    for test in tests.values():
        valid = valid.where(~test)
    return valid, rejects.where(F.size(missing) > 0)


def fail_device_on_missing_name(bundle: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """A nameless optics interface removes its device from every dataset; the other devices go on."""
    # Used for each dataset: looked for once.
    nameless = materialize(bundle["interfaces"].where(filled("if_name").isNull()).select("device").distinct(), "nameless")
    failed = nameless.withColumn("error", F.lit("interface name missing"))
    return {name: df.join(nameless, "device", "left_anti") for name, df in bundle.items()}, failed


def _identity(df: DataFrame, run_timestamp: int | Column | None) -> DataFrame:
    given = F.lit(run_timestamp) if isinstance(run_timestamp, int) else run_timestamp
    if given is None:
        given = F.lit(None)
    # A run stamp of 0 counts as not given.
    stamp = F.coalesce(F.nullif(given.cast("long"), F.lit(0).cast("long")), F.unix_timestamp())
    text = {c: F.coalesce(c, F.lit("")) for c in ("origin_hostname", "origin_name", "inventory_instance")}
    return run_time_columns(df.withColumns(text).withColumn("timestamp", stamp)).drop("dt", "hr")


_DEVICE_FACTS = ["origin_hostname", "origin_name", "inventory_instance", "device_profile"]


def device_changes(devices: DataFrame) -> DataFrame:
    """What the projections take of the devices, once for all of them: the runs at which one of the facts changed."""
    run = [c for c in ("run_timestamp",) if c in devices.columns]
    return changes(devices.select("device", *run, *_DEVICE_FACTS), ["device"])


def _with_device(rows: DataFrame, devices: DataFrame) -> DataFrame:
    """The facts of the device as of the row's run, where the devices are listed by run."""
    run = [c for c in ("run_timestamp",) if c in devices.columns]
    return join_as_of(rows.drop(*_DEVICE_FACTS), devices.select("device", *run, *_DEVICE_FACTS), ["device"])


def project_interface_dom(interfaces: DataFrame, devices: DataFrame, chassis: DataFrame,
                          run_timestamp: int | Column | None, keep: list[str] = ()) -> DataFrame:
    """The 14 columns of the interface dataset, and those of `keep` (as in the other projections)."""
    rows = enrich_lake_chassis(interfaces, chassis)
    rows = _identity(_with_device(rows, devices), run_timestamp)
    text = {c: F.coalesce(c, F.lit("")) for c in ("vendor", "media_type", "fiber_type")}
    return rows.withColumns(text).select(*C.INTERFACE_DOM_COLUMNS, *keep)


def project_lane_dom(lanes: DataFrame, devices: DataFrame, run_timestamp: int | Column | None, keep: list[str] = ()) -> DataFrame:
    """The 10 columns of the lane dataset, valid lanes only."""
    valid, _ = split_valid_lanes(lanes)
    return _identity(_with_device(valid, devices), run_timestamp).select(*C.LANE_DOM_COLUMNS, *keep)


def project_interface_counters(stats: DataFrame, devices: DataFrame, run_timestamp: int | Column | None,
                               keep: list[str] = ()) -> DataFrame:
    """The 18 columns of the counter dataset."""
    rows = _identity(_with_device(stats, devices), run_timestamp)
    text = {c: F.coalesce(c, F.lit("")) for c in ("if_name", "admin_status", "oper_status")}
    return rows.withColumns(text).select(*C.INTERFACE_COUNTERS_COLUMNS, *keep)


def string_hardening(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the fixed schema, so that files written at different times agree; missing columns are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
