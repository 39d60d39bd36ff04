"""The lake: partitioned Parquet datasets, their maintenance, and the text sinks.

A dataset lies at `<root>/<dataset>/dt=YYYY-MM-DD/hr=HH`. Rows are rebalanced by
partition before a write: an hour becomes few files, and an hour with very many
rows is split over several tasks instead of going through one.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake import constants as C
from opticlake.operators.joins import join_per_key
from opticlake.session import group_limit, materialize

PARTITIONS = ["dt", "hr"]
FOLDERS = 500  # that a task writes, about


def write_options(compression: str = "snappy") -> dict[str, str]:
    """Parquet writer options: no dictionary pages, statistics on."""
    if compression not in C.CODECS:
        raise ValueError(f"compression {compression!r} is not available, use one of {C.CODECS}")
    return {"compression": compression, "parquet.enable.dictionary": "false"}


def append_same_file(df: DataFrame, path: str, partitions: list[str] = (), compression: str = "snappy") -> None:
    """Append as new files; what is there is never read or written again."""
    rows = df.hint("rebalance", *partitions) if partitions else df
    rows.write.mode("append").options(**write_options(compression)).partitionBy(*partitions).parquet(path)


def write_lake_hourly(datasets: dict[str, DataFrame], root: str, compression: str = "snappy") -> dict[str, int]:
    """Write each dataset below its dt and hr; a dataset without rows writes nothing. The rows of those that have some."""
    written = {}
    for name, df in datasets.items():
        # Counted as they are written: nothing upstream runs twice, and other writers do not matter.
        seen = Observation()
        append_same_file(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/{name}", PARTITIONS, compression)
        if n := _observed(seen, df):
            written[name] = n
    return written


def _observed(seen: Observation, df: DataFrame) -> int:
    try:
        return seen.get["rows"]
    except Py4JJavaError:  # rows that are known to be none are not run, and so not observed
        return df.count()


def write_per_device(df: DataFrame, root: str, by_device: bool = True, compression: str = "snappy",
                     collected_at: Column | None = None) -> None:
    """Older layout: dt, then the device if asked, with collection date and time as columns."""
    at = F.current_timestamp() if collected_at is None else collected_at
    rows = df.withColumns({
        "collection_date": F.date_format(at, "yyyy-MM-dd"),
        "collection_timestamp": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        "dt": F.date_format(at, "yyyy-MM-dd"),
    })
    if not by_device:
        append_same_file(rows, root, ["dt"], compression)
        return
    # The partition column leaves the files, so the device also stays as data.
    rows = rows.withColumn("device_name", F.col("device"))
    for part in _by_folders(rows, ["dt", "device"]):
        part.write.mode("append").options(**write_options(compression)).partitionBy("dt", "device").parquet(root)


def _by_folders(rows: DataFrame, folders: list[str]) -> list[DataFrame]:
    """The rows dealt to tasks for a write to very many folders, where files and not bytes cost the time.

    A rebalance joins small partitions until they have enough bytes, and one task would write all files. Folders with
    more rows than a task may take stay with the rebalance, which splits them.
    """
    spark = rows.sparkSession
    sizes = materialize(rows.groupBy(*folders).agg(F.count(F.lit(1)).alias("_n")), "folders")
    large = sizes.where(F.col("_n") > group_limit(spark)).withColumnRenamed("_n", "_large")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sizes.count() // FOLDERS)
    if large.isEmpty():
        return [rows.repartition(tasks, *folders)]
    marked = join_per_key(rows, large, folders, nulls_match=True)
    small = marked.where("_large IS NULL").drop("_large").repartition(tasks, *folders)
    return [small, marked.where("_large IS NOT NULL").drop("_large").hint("rebalance", *folders)]


def _dataset(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{dataset}")


def scan_lake_partition(spark: SparkSession, root: str, dataset: str, dt_from: str, dt_to: str,
                        hr: str | None = None, device: str | None = None) -> DataFrame:
    """Days, an hour, a device: dt and hr prune folders, the device is pushed to the files."""
    rows = _dataset(spark, root, dataset).where(F.col("dt").between(dt_from, dt_to))
    if hr is not None:
        rows = rows.where(F.col("hr") == hr)
    return rows if device is None else rows.where(F.col("device") == device)


def scan_columns_pushdown(spark: SparkSession, root: str, dataset: str, columns: list[str],
                          predicate: Column) -> DataFrame:
    """Few columns of the rows that pass; both reach the Parquet scan."""
    return _dataset(spark, root, dataset).where(predicate).select(*columns)


def archive_raw(docs: DataFrame, root: str) -> None:
    """Keep raw replies as they came, by run day and hour.

    Files hold the replies of one call, so a later read of one call skips the others by their statistics.
    """
    at = F.timestamp_seconds("run_timestamp")
    stamped = docs.withColumns({"dt": F.date_format(at, "yyyy-MM-dd"), "hr": F.date_format(at, "HH")})
    (
        stamped.hint("rebalance", *PARTITIONS, "rpc").write.mode("append").options(**write_options())
        .partitionBy(*PARTITIONS).parquet(f"{root}/rpc_docs")
    )


def publish_partition(spark: SparkSession, source: str, target: str, dt: str, hr: str) -> None:
    """Copy one hour to the published lake; running it again replaces the same hour."""
    rows = spark.read.parquet(source).where((F.col("dt") == dt) & (F.col("hr") == hr))
    (
        rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**write_options()).partitionBy(*PARTITIONS).parquet(target)
    )


def _files(spark: SparkSession, folder: str) -> dict[str, object]:
    """Data files of one folder by name, and the file system they are in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = store.listStatus(path) if store.exists(path) else []
    return {f.getPath().getName(): f.getPath() for f in listed if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


_MARK = "_merging"


def _settle(store, folder: str, path) -> None:
    """End a merge that was lost on the way: finish it where all merged files are in place, else undo it."""
    mark = path(f"{folder}/{_MARK}")
    if not store.exists(mark):
        return
    stream = store.open(mark)
    old, new = json.loads(bytes(stream.readAllBytes()))
    stream.close()
    whole = all(store.exists(path(f"{folder}/{name}")) for name in new)
    for name in old if whole else new:
        store.delete(path(f"{folder}/{name}"), False)
    store.delete(mark, False)


def compact_partition(spark: SparkSession, root: str, dt: str, hr: str, files: int, staging: str) -> None:
    """Merge the small files of one hour into at most `files`.

    Only the files that were listed at the start are read and, once the merged ones are in the hour's folder, deleted;
    a file that arrives meanwhile is left alone. A mark in the folder names both, so that the next run can finish or
    undo a merge that was lost on the way.
    """
    folder, path = f"{root}/dt={dt}/hr={hr}", spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    _settle(store, folder, path)
    old = _files(spark, folder)
    if len(old) <= files:
        return
    schema = spark.read.parquet(folder).schema
    rows = spark.read.schema(schema).parquet(*[p.toString() for p in old.values()])
    rows.repartition(files).write.mode("overwrite").options(**write_options()).parquet(staging)
    if spark.read.schema(schema).parquet(staging).count() != rows.count():
        raise RuntimeError(f"{folder} could not be read twice with the same rows")
    moved = {f"merged-{name}": part for name, part in _files(spark, staging).items()}
    stream = store.create(path(f"{folder}/{_MARK}"), False)
    stream.write(json.dumps([list(old), list(moved)]).encode())
    stream.close()
    for name, part in moved.items():
        if not store.rename(part, path(f"{folder}/{name}")):
            _settle(store, folder, path)
            raise RuntimeError(f"{part} could not be moved to {folder}; the old files are still there")
    _settle(store, folder, path)


def register_tables(spark: SparkSession, root: str, schemas: dict[str, T.StructType], database: str = "default") -> list[str]:
    """External tables over the datasets, partition columns as strings, partitions found on disk."""
    names = []
    for dataset, schema in schemas.items():
        name = f"{database}.{dataset}"
        columns = [f for f in schema.fields if f.name not in PARTITIONS]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, dt STRING, hr STRING) USING parquet "
                  f"PARTITIONED BY (dt, hr) LOCATION '{root}/{dataset}'")
        spark.sql(f"MSCK REPAIR TABLE {name}")
        names.append(name)
    return names


def retention_plan(spark: SparkSession, table: str, days: int, as_of: str) -> DataFrame:
    """Partitions of a registered table with their age in days; dropping them is a step of its own."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    dt = F.regexp_extract("partition", r"(?:^|/)dt=([^/]+)", 1)
    age = F.datediff(F.to_date(F.lit(as_of)), F.to_date(dt))
    return listed.select(
        "partition", dt.alias("dt"), age.alias("age_days"),
        F.when(age > days, "expire").otherwise("keep").alias("action"),
    )


def drop_expired(spark: SparkSession, table: str, plan: DataFrame) -> int:
    """Drop the partitions a plan marks from the table; the plan is a listing of folders, one row per hour."""
    expired = [r["partition"] for r in plan.where(F.col("action") == "expire").select("partition").collect()]
    specs = [", ".join("{}='{}'".format(*part.split("=", 1)) for part in name.split("/")) for name in expired]
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec})" for spec in specs))
    return len(specs)


def validate_lake(df: DataFrame, schema: T.StructType, keys: list[str], counters: list[str] = (),
                  lane_range: tuple[int, int] | None = None) -> DataFrame:
    """(rule, checked, failed): schema, nulls, finite values, counters, lanes in one pass; keys in another."""
    present = {f.name: f.dataType for f in df.schema}
    rules: dict[str, Column | int] = {}
    for f in schema:
        if present.get(f.name) != f.dataType:
            rules[f"schema:{f.name}"] = 1
            continue
        rules[f"null:{f.name}"] = F.count_if(F.col(f.name).isNull())
        if isinstance(f.dataType, T.DoubleType):
            finite = F.abs(F.col(f.name)) < float("inf")
            rules[f"finite:{f.name}"] = F.count_if(F.col(f.name).isNotNull() & ~finite)
        if f.name in counters:
            rules[f"negative:{f.name}"] = F.count_if(F.col(f.name) < 0)
        if f.name == "lane" and lane_range:
            rules["range:lane"] = F.count_if(~F.col("lane").between(*lane_range))
    failed = [(F.lit(v).cast("long") if isinstance(v, int) else v).alias(name) for name, v in rules.items()]
    wide = df.agg(F.count("*").alias("_n"), *failed)
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("failed")) for name in rules])
    report = wide.select(F.col("_n").alias("checked"), F.inline(pairs).alias("rule", "failed"))
    repeated = df.groupBy(*keys).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("checked"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("failed"),
    ).withColumn("rule", F.lit("duplicate:" + "+".join(keys)))
    return report.unionByName(repeated).select("rule", "checked", "failed")


def latest_errors_topk(df: DataFrame, dt: str, device: str, k: int = 100) -> DataFrame:
    """Newest rows of a device and day; the limit is the report."""
    rows = df.where((F.col("dt") == dt) & (F.col("device") == device))
    order = [F.col("collection_timestamp").desc(), F.col("if_name"), F.col("timestamp")]
    ties = [F.col(c) for c in df.columns if c not in ("collection_timestamp", "if_name", "timestamp")]
    return rows.orderBy(*order, *ties).limit(k)


# --- text sinks --------------------------------------------------------------


def write_exposition(lines: DataFrame, folder: str, job: str) -> None:
    """Text lines below one folder per job and instance; no lines is a success too.

    The instances that have lines are replaced; other jobs and instances stay as they are.
    """
    rows = lines.withColumn("job", F.lit(job)).hint("rebalance", "job", "instance").write.mode("overwrite")
    rows.option("partitionOverwriteMode", "dynamic").partitionBy("job", "instance").text(folder)


def write_parsed_json(interfaces: DataFrame, lanes: DataFrame, folder: str, fmt: str = "json") -> None:
    """`jsonl`: one lane per line. `json`: both kinds, one record per line and a folder per kind."""
    if fmt not in ("json", "jsonl"):
        raise ValueError(f"format {fmt!r} is neither json nor jsonl")
    if fmt == "jsonl":
        lanes.write.mode("overwrite").json(folder)
        return
    interfaces.write.mode("overwrite").json(f"{folder}/interfaces")
    lanes.write.mode("overwrite").json(f"{folder}/lanes")
