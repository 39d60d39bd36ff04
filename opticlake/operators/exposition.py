"""Text exposition: wide rows to one sample per value, with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake import constants as C
from opticlake.functions import status_to_gauge


def exposition_labels(df: DataFrame, lane: bool, escape: bool = False, device: bool = False) -> Column:
    """Ordered label map; empty values are left out. Values stay as they are unless `escape` is set."""
    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    pairs = [("device", text("device"))] if device else []
    pairs.append(("interface", F.coalesce(text("if_name"), F.lit(C.UNNAMED_INTERFACE))))
    if lane:
        pairs.append(("lane", F.coalesce(text("lane"), F.lit("0"))))
    pairs += [(name, F.nullif(text(name), F.lit(""))) for name in C.LABEL_COLUMNS]
    if escape:
        def quoted(v: Column) -> Column:
            for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
                v = F.replace(v, F.lit(raw), F.lit(safe))
            return v
        pairs = [(name, quoted(value)) for name, value in pairs]
    entries = F.array(*[F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in pairs])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def label_text(labels: str | Column) -> Column:
    """`a="b",c="d"`"""
    c = F.col(labels) if isinstance(labels, str) else labels
    return F.array_join(
        F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"'))), ",")


def _samples(df: DataFrame, values: dict[str, Column], labels: Column, keep: list[str]) -> DataFrame:
    """One row per non-null value; the labels are built once per input row."""
    held = {name: f"_value_{i}" for i, name in enumerate(values)}
    # What stands beside a generator is worked out for each row that it gives: the labels are a column of its input.
    rows = df.select(*keep, labels.alias("labels"), *[values[name].cast("double").alias(c) for name, c in held.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(c).alias("value")) for name, c in held.items()])
    kept = F.filter(pairs, lambda p: p["value"].isNotNull())
    return rows.select(*keep, "labels", F.inline(kept).alias("metric", "value")).select(*keep, "metric", "labels", "value")


def unpivot_exposition_interface(df: DataFrame, keep: list[str] = (), escape: bool = False,
                                 device: bool = False, text: bool = False) -> DataFrame:
    """Thresholds, measures, status, speed, traffic, FEC and bins 0-15 as samples; with `text` the labels as `label_text`."""
    values: dict[str, Column] = {}
    for name in [*C.THRESHOLD_TAGS, *C.INTERFACE_MEASURES]:
        values[name] = name
    for name in [*C.STATUS_MEASURES, *C.PREFIXED_MEASURES]:
        values[f"interface_{name}"] = name
    for i in range(C.HISTOGRAM_BINS):
        values[f"interface_fec_histogram_bin_{i}"] = f"histogram_bin_{i}"
    columns = {
        metric: status_to_gauge(name) if name in C.STATUS_MEASURES else F.col(name)
        for metric, name in values.items() if name in df.columns
    }
    labels = exposition_labels(df, False, escape, device)
    return _samples(df, columns, label_text(labels) if text else labels, list(keep))


def unpivot_exposition_lane(df: DataFrame, keep: list[str] = (), escape: bool = False,
                            device: bool = False, text: bool = False) -> DataFrame:
    """The five lane measures as samples; with `text` the labels as `label_text`."""
    columns = {name: F.col(name) for name in C.LANE_MEASURES if name in df.columns}
    labels = exposition_labels(df, True, escape, device)
    return _samples(df, columns, label_text(labels) if text else labels, list(keep))


def exposition_lines(samples: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The line of each sample. A row has many samples: their labels as text are made once for it, a map's for each of them."""
    made = isinstance(samples.schema["labels"].dataType, T.StringType)
    labels = F.col("labels") if made else label_text("labels")
    line = F.concat("metric", F.lit("{"), labels, F.lit("} "), F.col("value").cast("string"))
    return samples.select(*keep, line.alias("value"))


# --- reshaping of parsed documents -------------------------------------------


def flatten_optical(interfaces: DataFrame, lanes: DataFrame) -> DataFrame:
    """Interfaces and lanes in one wide table, told apart by `metric_type`."""
    return interfaces.withColumn("metric_type", F.lit("interface")).unionByName(
        lanes.withColumn("metric_type", F.lit("lane")), allowMissingColumns=True)


def flatten_stats(stats: DataFrame) -> DataFrame:
    """Statistics rows are flat already: `interfaces` arrays are opened, columns pass through."""
    return stats.select(F.inline("interfaces")) if "interfaces" in stats.columns else stats


def flatten_transceivers(pic: DataFrame) -> DataFrame:
    """The transceiver map of each device as rows."""
    return pic.select("device", F.explode("transceivers").alias("if_name", "t")).select("device", "if_name", "t.*")


def union_devices(*parts: DataFrame) -> DataFrame:
    """Rows of all runs, shards or devices; columns matched by name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
