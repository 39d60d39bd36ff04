"""Run reports, rollups and fleet statistics. Every aggregate combines before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticlake.operators import sketches as K

SPREAD = {"p50": 0.5, "p95": 0.95}


def run_summary(bundle: dict[str, DataFrame], failed: DataFrame) -> DataFrame:
    """Rows per device and dataset, failed devices, and a total line (device NULL)."""
    tagged = None
    for name, df in bundle.items():
        part = df.groupBy("device").agg(F.count("*").alias("n")).withColumn("dataset", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    tagged = tagged.unionByName(failed.select("device", F.lit(0).cast("long").alias("n"), F.lit("failed").alias("dataset")))
    rows = tagged.groupBy("device").agg(
        *[F.sum(F.when(F.col("dataset") == name, F.col("n")).otherwise(0)).alias(name) for name in bundle],
        F.max((F.col("dataset") == "failed").cast("int")).alias("failed"),
    )
    total = rows.agg(
        *[F.sum(name).alias(name) for name in bundle],
        F.sum("failed").alias("failed_devices"), F.count("*").alias("devices"),
    )
    per_device = rows.select("device", *bundle, F.lit(1).cast("long").alias("devices"),
                             F.col("failed").cast("long").alias("failed_devices"))
    overall = total.select(F.lit(None).cast("string").alias("device"), *bundle, "devices",
                           F.coalesce("failed_devices", F.lit(0).cast("long")).alias("failed_devices"))
    return per_device.unionByName(overall).withColumn("exit_status", (F.col("failed_devices") > 0).cast("int"))


#: The call whose replies a parsed table comes from.
TABLE_RPCS = {
    "interfaces": "optics_diagnostics", "lanes": "optics_diagnostics", "stats": "interface_statistics",
    "system": "system_information", "serials": "chassis_inventory", "transceivers": "chassis_inventory",
}


def doc_metric_counts(docs: DataFrame, rpcs: dict[str, str] | None = None, **parsed: DataFrame) -> DataFrame:
    """Rows that each reply gave, per parsed table, and whether it gave none; replies without rows show 0.

    A table's rows count for the replies of its own call only; `rpcs` names the calls of further tables.
    """
    known = TABLE_RPCS | (rpcs or {})
    keys = ["device", "run_timestamp", "rpc"]
    out = docs.select(*keys).distinct()
    for name, df in parsed.items():
        own = df if "rpc" in df.columns else df.withColumn("rpc", F.lit(known[name]))
        out = out.join(own.groupBy(*keys).agg(F.count("*").alias(f"{name}_count")), keys, "left")
    counts = [f"{name}_count" for name in parsed]
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts})
    empty = F.lit(True)
    for c in counts:
        empty = empty & (F.col(c) == 0)
    return out.withColumn("empty", empty)


def metric_coverage(stats: DataFrame, bins: DataFrame) -> DataFrame:
    """Which metric families a device reports, and how many histogram bins."""
    def any_of(column: str, name: str):
        return F.max(F.col(column).isNotNull()).alias(name)

    families = stats.groupBy("device").agg(
        any_of("fec_ccw", "has_corrected"), any_of("fec_nccw", "has_uncorrected"),
        any_of("fec_ccw_error_rate", "has_rates"), any_of("pre_fec_ber", "has_ber"),
    )
    counted = bins.groupBy("device").agg(F.count_distinct("bin").alias("bins"))
    return families.join(counted, "device", "left").withColumn("bins", F.coalesce("bins", F.lit(0).cast("long")))


def rollup_hourly_daily(df: DataFrame, metrics: list[str], keys: list[str] = ("device", "if_name"),
                        ts: str = "ts", order: str | None = None) -> DataFrame:
    """count, min, avg, max and last per metric by hour and by day; `order` is a finer time to find the last by.

    Days are summed from the hours, so the samples are read and shuffled once.
    Every aggregate keeps plain numbers, so all of it hashes and nothing is sorted.
    """
    return merge_hours(hourly_states(df, metrics, keys, ts, order), metrics, keys)


def hourly_states(df: DataFrame, metrics: list[str], keys: list[str] = ("device", "if_name"), ts: str = "ts", order: str | None = None,
                  also: list[str] = ()) -> DataFrame:
    """One row per key and hour (`bucket`), from which hours and days can be merged; `also` are further columns to group by."""
    def last(m: str):
        at = F.when(F.col(m).isNotNull(), F.col(order or ts))
        return F.max_by(m, at).alias(f"{m}_last"), F.max(at).alias(f"{m}_at")

    hour = F.floor(F.col(ts) / 3600) * 3600
    return df.groupBy(*keys, *also, hour.alias("bucket")).agg(*[
        e for m in metrics for e in (
            F.count(m).alias(f"{m}_count"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"),
            F.sum(F.col(m).cast("double")).alias(f"{m}_sum"), *last(m),
        )
    ])


def merge_hours(hourly: DataFrame, metrics: list[str], keys: list[str] = ("device", "if_name")) -> DataFrame:
    """Hours and days from states of hours."""
    levels = F.array(
        F.struct(F.lit("hour").alias("level"), F.col("bucket").alias("start")),
        F.struct(F.lit("day").alias("level"), (F.floor(F.col("bucket") / 86400) * 86400).alias("start")),
    )
    both = hourly.withColumn("_l", F.explode(levels))
    merged = both.groupBy(*keys, F.col("_l.level").alias("level"), F.col("_l.start").alias("start")).agg(*[
        e for m in metrics for e in (
            F.sum(f"{m}_count").alias(f"{m}_count"), F.min(f"{m}_min").alias(f"{m}_min"),
            F.max(f"{m}_max").alias(f"{m}_max"), F.sum(f"{m}_sum").alias(f"_{m}_sum"),
            F.max_by(f"{m}_last", f"{m}_at").alias(f"{m}_last"),
        )
    ])
    return merged.select(*keys, "level", "start", *[
        e for m in metrics for e in (
            F.col(f"{m}_count"), F.col(f"{m}_min"),
            F.when(F.col(f"{m}_count") > 0, F.col(f"_{m}_sum") / F.col(f"{m}_count")).alias(f"{m}_avg"),
            F.col(f"{m}_max"), F.col(f"{m}_last"),
        )
    ])


def correlate_fec_optics(frame: DataFrame, by: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Correlation, covariance and slope per group and pair; NULL with fewer than three points."""
    aggregates = []
    for y, x in pairs:
        a, b = F.col(y).cast("double"), F.col(x).cast("double")
        points = F.count(F.when(a.isNotNull() & b.isNotNull(), 1))
        name = f"{y}__{x}"
        aggregates += [
            points.alias(f"{name}_points"),
            F.when(points >= 3, F.corr(a, b)).alias(f"{name}_corr"),
            F.when(points >= 3, F.covar_samp(a, b)).alias(f"{name}_covar"),
            F.when(points >= 3, F.regr_slope(a, b)).alias(f"{name}_slope"),
        ]
    return frame.groupBy(*by).agg(*aggregates)


def rma_comparison(df: DataFrame, events: DataFrame, metrics: list[str], ts: str = "ts") -> DataFrame:
    """Mean, p50, p95 and count per device before and from its event on, and the change of the mean."""
    rows = df.join(events.select("device", "event_time"), "device")
    rows = rows.withColumn("phase", F.when(F.col(ts) < F.col("event_time"), "before").otherwise("after"))
    by = ["device", "phase"]
    means = [e for m in metrics for e in (F.count(m).alias(f"{m}_count"), F.avg(m).alias(f"{m}_mean"))]
    names = [f"{m}_{kind}" for m in metrics for kind in ("count", "mean")]
    out = K.exact_quantiles(rows, by, metrics, SPREAD, means, names, columns=[])
    values = [c for c in out.columns if c not in by]
    wide = out.groupBy("device").agg(*[
        F.max(F.when(F.col("phase") == phase, F.col(v))).alias(f"{phase}_{v}")
        for phase in ("before", "after") for v in values
    ])
    return wide.withColumns({f"{m}_change": F.col(f"after_{m}_mean") - F.col(f"before_{m}_mean") for m in metrics})


def vendor_fleet_stats(frame: DataFrame, metrics: list[str], by: list[str] = ("vendor", "part_number", "fiber_type"),
                       approximate: bool = False) -> DataFrame:
    """Counts, interfaces, mean, p50 and p95 per vendor, part and fibre type; sketches on request."""
    by = list(by)
    interface = F.struct("device", "if_name")
    distinct = F.approx_count_distinct(interface) if approximate else F.count_distinct(interface)
    aggregates = [F.count("*").alias("rows"), distinct.alias("interfaces")]
    aggregates += [F.avg(m).alias(f"{m}_mean") for m in metrics]
    names = ["rows", "interfaces", *[f"{m}_mean" for m in metrics]]
    if approximate:
        states = K.quantile_states(frame, by, metrics, aggregates)
        return K.state_quantiles(states, metrics, SPREAD).select(*by, *names, *[f"{m}_{name}" for m in metrics for name in SPREAD])
    return K.exact_quantiles(frame, by, metrics, SPREAD, aggregates, names, columns=["device", "if_name"])


def fleet_sets(df: DataFrame, by: list[str], ts: str = "ts", members: list[str] = ("device", "if_name")) -> DataFrame:
    """(by..., hour, members): sketches of the interfaces that were seen, to be stored and merged over any period."""
    hour = F.floor(F.col(ts) / 3600) * 3600
    return K.distinct_states(df.withColumn("hour", hour), [*by, "hour"], list(members))


def fleet_changes(sets: DataFrame, by: list[str], event: Column | str) -> DataFrame:
    """Interfaces seen before an event time and from then on, in both periods, gone and new, per group; from `fleet_sets`."""
    at = F.col(event) if isinstance(event, str) else event
    phase = F.when(F.col("hour") < F.floor(at / 3600) * 3600, "before").otherwise("after")
    merged = K.merged_sets(sets.withColumn("_phase", phase), [*by, "_phase"])
    wide = merged.groupBy(*by).agg(*[F.max(F.when(F.col("_phase") == p, F.col("members"))).alias(f"_{p}") for p in ("before", "after")])
    return wide.select(*by, *[v.alias(name) for name, v in K.set_sizes("_before", "_after").items()])
