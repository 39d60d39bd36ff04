"""Rollups that are kept up to date: states of hours are stored, and only hours whose files changed are read again.

`<root>/hours/dt=/hr=` holds the states of each hour of the lake, and `<root>/listing/version=N` the files that each hour's states
came from. A run compares the lake's files with the newest listing, replaces the states of the hours that differ and then writes the
next listing, so a run that is lost before that is simply done again. Hours that are no longer in the lake drop out of the listing, and
with it out of the results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.operators.aggregate import hourly_states, merge_hours
from opticlake.operators.sketches import merged_states, quantile_states, state_quantiles
from opticlake.session import materialize
from opticlake.sources.lake import PARTITIONS, write_options


def lake_files(spark: SparkSession, dataset: str) -> DataFrame:
    """(dt, hr, files): a fingerprint of the names, sizes and times of each hour's files; no column is read."""
    rows = spark.read.parquet(dataset).select(*PARTITIONS, F.struct("_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time").alias("f"))
    return rows.groupBy(*PARTITIONS, "f").agg(F.count("*").alias("n")).groupBy(*PARTITIONS).agg(
        F.xxhash64(F.sort_array(F.collect_list(F.struct("f", "n")))).alias("files"))


def _newest(spark: SparkSession, root: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/listing")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = store.listStatus(path) if store.exists(path) else []
    done = [f.getPath() for f in listed if store.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return max((int(re.search(r"=(\d+)$", p.getName())[1]) for p in done), default=-1)


def _listing(spark: SparkSession, root: str, version: int) -> DataFrame:
    if version < 0:
        return spark.createDataFrame([], "dt string, hr string, files long")
    return spark.read.parquet(f"{root}/listing/version={version}")


def update_rollup(spark: SparkSession, dataset: str, root: str, metrics: list[str], keys: list[str] = ("device", "if_name"),
                  ts: str = "timestamp", order: str | None = None) -> DataFrame:
    """Bring the states up to date; (dt, hr) of the hours that were read again."""
    keys, version = list(keys), _newest(spark, root)
    now = materialize(lake_files(spark, dataset), "lake-files")
    changed = materialize(now.join(_listing(spark, root, version), [*PARTITIONS, "files"], "left_anti").select(*PARTITIONS), "changed-hours")
    # One row per hour of the lake: as few as its folders, and sent to the scan so that it opens no others.
    hours = [tuple(r) for r in changed.collect()]
    if hours:
        rows = spark.read.parquet(dataset).where(F.struct(*PARTITIONS).isin([F.struct(F.lit(d), F.lit(h)) for d, h in hours]) if len(hours) <= 1000 else F.lit(True))
        rows = rows.join(F.broadcast(changed), PARTITIONS, "left_semi")
        by = [*PARTITIONS, *keys]
        plain = hourly_states(rows, metrics, keys, ts, order, PARTITIONS)
        hour = (F.floor(F.col(ts) / 3600) * 3600).alias("bucket")
        sketches = quantile_states(rows.withColumn("bucket", hour), [*by, "bucket"], metrics)
        again = [c for c in sketches.columns if c in plain.columns and c not in (*by, "bucket")]
        both = plain.join(sketches.drop(*again), [*by, "bucket"])
        both.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(
            **write_options()).partitionBy(*PARTITIONS).parquet(f"{root}/hours")
    now.write.mode("overwrite").parquet(f"{root}/listing/version={version + 1}")
    return changed


def stored_hours(spark: SparkSession, root: str) -> DataFrame:
    """The states of the hours of the newest listing."""
    listed = _listing(spark, root, _newest(spark, root)).select(*PARTITIONS)
    return spark.read.parquet(f"{root}/hours").join(F.broadcast(listed), PARTITIONS, "left_semi")


def stored_rollup(spark: SparkSession, root: str, metrics: list[str], keys: list[str] = ("device", "if_name")) -> DataFrame:
    """Hours and days as `rollup_hourly_daily` gives them, from the states alone."""
    return merge_hours(stored_hours(spark, root), metrics, list(keys))


def stored_quantiles(spark: SparkSession, root: str, metrics: list[str], shares: dict[str, float], by: list[str]) -> DataFrame:
    """Quantiles of any larger groups and periods, by columns of the states, from the sketches."""
    merged = merged_states(stored_hours(spark, root), by, metrics)
    return state_quantiles(merged, metrics, shares).select(*by, *[f"{m}_{name}" for m in metrics for name in shares])
