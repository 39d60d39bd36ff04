"""Session settings, shared scratch space and size checks."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a later group-by needs one more exchange for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # dt and hr are strings: without this hr=05 reads back as the number 5.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A repeated slot, port or bin within one reply replaces the earlier one.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The JVM never compiles a method above 8,000 bytes of bytecode: rows of many columns would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A batch of files is listed by path: by default each path is a task of its own, up to 10,000.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # State of streams on local disk instead of the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

GROUP_ROWS_SETTING = "spark.opticlake.maxGroupRows"
GROUP_ROWS_DEFAULT = 1_000_000

#: Rows of a task that makes or reads something large of each, as a reply: some seconds.
SPREAD_ROWS = 100_000


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: (label, folder) of the tables written within the innermost `passing` of this thread.
_WRITTEN: ContextVar[list[tuple[str, str]] | None] = ContextVar("written", default=None)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder, removed when the application ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # one machine, not local-cluster
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="opticlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/opticlake/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    if (written := _WRITTEN.get()) is not None:
        written.append((label, folder))
    return f"{folder}/data"


def release(spark: SparkSession) -> None:
    """Shuffle files, broadcasts and plans of finished jobs go when the driver collects its garbage, which by itself it does late."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def passing(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Scratch tables written within go at the end, but for those with a label of `keep`: nothing else may be read later."""
    written: list[tuple[str, str]] = []
    token = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for label, folder in written:
            if label not in keep:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            elif (outer := _WRITTEN.get()) is not None:
                outer.append((label, folder))
        release(spark)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write costly rows to the shared folder once and read them back from there.

    Later steps read only the columns they need, and a lost executor costs a
    read of files instead of the work that made them.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_limit(spark: SparkSession) -> int:
    """Most rows of one group that a single task may sort or hold."""
    return int(spark.conf.get(GROUP_ROWS_SETTING, str(GROUP_ROWS_DEFAULT)))


def heaviest_group(df: DataFrame, keys: list[str | Column]) -> int:
    """Row count of the largest group; counts are combined before the shuffle."""
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"))
    return top.first()["n"] or 0


def heaviest_slices(df: DataFrame, keys: list[str], ts: str, widths: list[int]) -> dict[int, int]:
    """Row count of the largest (key, time slice) per width, all from one pass: wide slices are sums of narrow ones."""
    narrow_first = sorted(widths)
    counts, tops = df.select(*keys, F.col(ts).alias("_at"), F.lit(1).alias("_n")), []
    for width in narrow_first:
        at = (F.floor(F.col("_at") / width) * width).alias("_at")
        tops.append(f"_top_{width}")
        counts = counts.groupBy(*keys, at).agg(F.sum("_n").alias("_n"), *[F.max(t).alias(t) for t in tops[:-1]])
        counts = counts.withColumn(tops[-1], F.col("_n"))
    row = counts.agg(*[F.max(t).alias(t) for t in tops]).first()
    return {width: row[f"_top_{width}"] or 0 for width in narrow_first}


def spread(df: DataFrame) -> DataFrame:
    """Dealt to all cores in tasks of at most SPREAD_ROWS rows, where the input does not come so.

    A file is cut by its bytes but read by its row groups, so of many partitions a few may hold all rows.
    """
    held = df.groupBy(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    most, rows = held.agg(F.max("n"), F.sum("n")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-(rows or 0) // SPREAD_ROWS))
    # A partition of up to twice its share is left as it is.
    return df.repartition(tasks) if (most or 0) * tasks > 2 * (rows or 0) else df
