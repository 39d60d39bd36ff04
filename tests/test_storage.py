from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake.functions import run_time_columns
from opticlake.operators.timeseries import counter_deltas
from opticlake.session import GROUP_ROWS_SETTING, scratch
from opticlake.sources import lake as K
from opticlake.sources import replies as A
from opticlake.streaming import jobs, state

HOUR = 3600
START = 1706342400  # 2024-01-27 08:00 UTC


@pytest.fixture
def rows(spark):
    data = [(f"dev-{i % 3}", f"et-0/0/{i % 5}", START + i % 4 * HOUR, i) for i in range(40)]
    return run_time_columns(spark.createDataFrame(data, "device string, if_name string, timestamp long, fec_nccw long"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_and_column_pruning(spark, rows):
    root = scratch(spark, "test")
    assert K.write_lake_hourly({"a": rows, "b": rows.where("false")}, root) == {"a": rows.count()}
    part = K.scan_lake_partition(spark, root, "a", "2024-01-27", "2024-01-27", "09", "dev-1")
    text = plan(part)
    assert "PartitionFilters: [isnotnull(dt" in text and "EqualTo(device,dev-1)" in text
    assert {(r["hr"], r["device"]) for r in part.collect()} == {("09", "dev-1")}
    few = plan(K.scan_columns_pushdown(spark, root, "a", ["if_name"], F.col("fec_nccw") > 3))
    assert "ReadSchema: struct<if_name:string,fec_nccw:bigint>" in few and "GreaterThan(fec_nccw,3)" in few


def test_read_back_equals_input(spark, rows):
    root = scratch(spark, "test")
    K.write_lake_hourly({"a": rows}, root)
    back = spark.read.parquet(f"{root}/a").select(*rows.columns)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    # One hour is one file, however many partitions the rows came in.
    files = back.groupBy("hr").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()
    assert {r["n"] for r in files} == {1}


def test_codecs():
    assert K.write_options("gzip")["compression"] == "gzip"
    with pytest.raises(ValueError, match="brotli"):
        K.write_options("brotli")


def test_publish_twice_and_compact(spark, rows):
    root, target = scratch(spark, "test"), scratch(spark, "target")
    for _ in range(3):
        K.append_same_file(rows.repartition(4), f"{root}/a", K.PARTITIONS)
    for _ in range(2):
        K.publish_partition(spark, f"{root}/a", target, "2024-01-27", "08")
    assert spark.read.parquet(target).count() == 30
    before = spark.read.parquet(f"{root}/a").groupBy("hr").count().collect()
    K.compact_partition(spark, f"{root}/a", "2024-01-27", "08", 1, scratch(spark, "staging"))
    read = spark.read.parquet(f"{root}/a")
    assert sorted(read.groupBy("hr").count().collect()) == sorted(before)
    assert read.where("hr = '08'").select("_metadata.file_path").distinct().count() == 1


def test_retention_and_drop(spark, rows):
    root = scratch(spark, "test")
    old = rows.withColumn("dt", F.lit("2023-01-01"))
    K.write_lake_hourly({"a": rows.unionByName(old)}, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS keep_test LOCATION '{root}/db'")
    spark.sql("DROP TABLE IF EXISTS keep_test.a")
    K.register_tables(spark, root, {"a": rows.schema}, "keep_test")
    plan_rows = K.retention_plan(spark, "keep_test.a", 365, "2024-01-28")
    assert {(r["dt"], r["action"]) for r in plan_rows.collect()} == {("2024-01-27", "keep"), ("2023-01-01", "expire")}
    assert K.drop_expired(spark, "keep_test.a", plan_rows) == 4
    assert spark.table("keep_test.a").count() == 40


def test_validation_of_empty_and_wrong_schema(spark):
    df = spark.createDataFrame([], "a string, b long")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    report = {r["rule"]: (r["checked"], r["failed"]) for r in K.validate_lake(df, schema, ["a"]).collect()}
    assert report == {"null:a": (0, 0), "schema:b": (0, 1), "duplicate:a": (0, 0)}


def test_file_names(spark):
    folder = scratch(spark, "names")
    names = ["my_dev_1_optics_diagnostics_raw.xml", "x_unknown_raw.xml", "_optics_diagnostics_raw.xml", "d_optics_diagnostics.xml"]
    files = spark.createDataFrame([(n, "<a/>") for n in names], "name string, content string")
    assert A.write_named_files(files, folder) == 4
    assert [(r["device"], r["rpc"]) for r in A.scan_rpc_docs(spark, folder, 1).collect()] == [("my_dev_1", "optics_diagnostics")]


def test_late_samples_are_dropped_and_counted(spark):
    source, sink, progress = (scratch(spark, n) for n in ("samples", "deltas", "progress"))
    schema = "device string, if_name string, ts long, c long"
    polls = [[("d", "i", 10, 5), ("d", "i", 20, None)], [("d", "i", 20, 9), ("d", "i", 30, 8), ("d", "j", 1, 1)],
             [("d", "i", 15, 1), ("d", "i", 40, 2)]]
    for poll in polls:
        spark.createDataFrame(poll, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.stream_counter_deltas(stream, ["c"], sink, progress).awaitTermination()
    found = {(r["if_name"], r["ts"]): (r["interval"], r["c_delta"], r["c_reset"])
             for r in spark.read.parquet(f"{sink}/rows").collect()}
    assert found == {("i", 10): (None, None, None), ("i", 20): (10, None, None), ("i", 30): (10, 3, False),
                     ("j", 1): (None, None, None), ("i", 40): (10, 2, True)}
    assert spark.read.parquet(f"{sink}/late").agg(F.sum("late")).first()[0] == 2


def test_state_of_a_key_that_pauses(spark):
    source, sink, progress = (scratch(spark, n) for n in ("samples", "deltas", "progress"))
    schema = "device string, if_name string, ts long, c long"
    for n in range(5):
        # Interface `a` is seen once, at the start, and again at the end.
        rows = [("d", "b", n, n)] + ([("d", "a", n, n)] if n in (0, 4) else [])
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.stream_counter_deltas(stream, ["c"], sink, progress).awaitTermination()
    found = {(r["if_name"], r["ts"]): r["c_delta"] for r in spark.read.parquet(f"{sink}/rows").collect()}
    assert found == {("a", 0): None, ("a", 4): 4, ("b", 0): None, **{("b", n): 1 for n in range(1, 5)}}


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(root.rstrip("/") + "/")


def test_state_versions(spark, monkeypatch):
    """Whole tables, changes since, repeated batches, forgotten keys and removed versions."""
    monkeypatch.setattr(state, "EVERY", 3)
    root, schema = scratch(spark, "state"), T.StructType.fromDDL("k string, seen long, v long")
    kept = state.KeyedState(root, schema, ["k"], "seen", ttl=5)
    expected = {}
    for n in range(12):
        changed = [(f"k{n % 5}", n, 10 * n), (None, n, n)] + ([("once", 0, 7)] if n == 0 else [])
        for repeat in range(2):  # a batch that runs again
            if repeat:
                assert {r["k"]: (r["seen"], r["v"]) for r in kept.before(spark, n).collect()} == expected
            kept.write(spark.createDataFrame(changed, schema), n)
        expected |= {k: (seen, v) for k, seen, v in changed}
        if n % 3 == 2:
            expected = {k: x for k, x in expected.items() if x[0] >= n - 5}
    assert "once" not in expected
    assert {r["k"]: (r["seen"], r["v"]) for r in kept.before(spark, 12).collect()} == expected
    assert sorted(kept._folders(spark, "whole")) == [8, 11] and min(kept._folders(spark, "changes")) == 9


def test_a_batch_of_one_hot_key(spark):
    """A key that is too large for a task is cut, in a batch as elsewhere."""
    source, sink, progress = (scratch(spark, n) for n in ("samples", "deltas", "progress"))
    rows = spark.range(3000).select(F.lit("d").alias("device"), F.when(F.col("id") % 3 == 0, "i").otherwise("j").alias("if_name"),
                                    F.floor(F.col("id") / 100).alias("ts"), "id", F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(50))).alias("c"))
    spark.conf.set(GROUP_ROWS_SETTING, 200)
    try:
        for poll in (rows.where("ts < 11"), rows.where("ts >= 11")):
            poll.write.mode("append").parquet(source)
            stream = spark.readStream.schema(rows.schema).parquet(source)
            jobs.stream_counter_deltas(stream, ["c"], sink, progress, tiebreak=["id"]).awaitTermination()
    finally:
        spark.conf.unset(GROUP_ROWS_SETTING)
    found = spark.read.parquet(f"{sink}/rows").drop("batch_id")
    whole = counter_deltas(rows, ["c"], tiebreak=["id"], width=None).select(*found.columns)
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()


def test_a_batch_of_replies_that_runs_again(spark):
    """Each file is in every table once, also where a batch is done again after a crash; a broken reply is in the rejects."""
    from tests import replies as R

    source, sink, progress = (scratch(spark, n) for n in ("replies", "tables", "progress"))
    texts = [("a", R.LANED_REPLY), ("b", R.UNLANED_REPLY), ("c", R.LANED_REPLY[:-9])]
    for device, text in texts:
        A.write_named_files(spark.createDataFrame([(f"{device}_optics_diagnostics_raw.xml", text)], "name string, content string"), f"{source}/run=5")
        jobs.stream_ingest_run(spark, source, sink, progress).awaitTermination()
    # The last commit is lost: its batch runs again.
    last = max(int(p.name) for p in Path(f"{progress}/query/commits").iterdir() if p.name.isdigit())
    (Path(f"{progress}/query/commits") / str(last)).unlink()
    (Path(f"{progress}/query/commits") / f".{last}.crc").unlink(missing_ok=True)
    jobs.stream_ingest_run(spark, source, sink, progress).awaitTermination()
    counts = {t: {r["device"]: r["count"] for r in spark.read.parquet(f"{sink}/{t}").groupBy("device").count().collect()}
              for t in ("optics_interfaces", "optics_lanes", "rejects")}
    assert counts == {"optics_interfaces": {"a": 1, "b": 1}, "optics_lanes": {"a": R.LANES}, "rejects": {"c": 1}}
    assert {r["run_timestamp"] for r in spark.read.parquet(f"{sink}/optics_lanes").collect()} == {5}


def test_a_batch_of_files_is_opened_once_for_all_calls(spark, tmp_path):
    from tests import replies as R

    source, sink, progress = (str(tmp_path / n) for n in ("replies", "tables", "progress"))
    system = "<rpc-reply><system-information><host-name>h</host-name></system-information></rpc-reply>"
    for run, device in enumerate("ab"):
        files = [(f"{device}_optics_diagnostics_raw.xml", R.LANED_REPLY), (f"{device}_system_information_raw.xml", system)]
        A.write_named_files(spark.createDataFrame(files, "name string, content string"), f"{source}/run={run + 5}")
        jobs.stream_ingest_run(spark, source, sink, progress).awaitTermination()
        # The replies of this batch alone, by call: tables are made from these and not from the files.
        kept = spark.read.parquet(f"{progress}/replies").select("device", "rpc", "run_timestamp").collect()
        assert sorted(map(tuple, kept)) == [(device, rpc, run + 5) for rpc in ("optics_diagnostics", "system_information")]
    hosts = spark.read.parquet(f"{sink}/system_information").select("device", "origin_hostname", "run_timestamp").collect()
    assert sorted(map(tuple, hosts)) == [("a", "h", 5), ("b", "h", 6)]
    assert spark.read.parquet(f"{sink}/optics_lanes").count() == 2 * R.LANES
    # Listing a batch takes few tasks, not one for each file.
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 100


def test_many_folders_are_written_by_many_tasks(spark, tmp_path):
    # A rebalance joins them to one partition, and one task would write them all.
    rows = spark.range(40).select(F.concat(F.lit("dev-"), "id").alias("device"), F.col("id").alias("n"))
    stamp = F.lit("2024-02-03 04:05:06").cast("timestamp")
    K.write_per_device(rows, str(tmp_path / "spread"), collected_at=stamp)
    back = spark.read.parquet(str(tmp_path / "spread"))
    assert back.count() == 40 and back.select("device", "device_name").distinct().count() == 40
    tasks = back.select(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).alias("task")).distinct().count()
    assert tasks > 1


def test_large_folders_keep_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "group_limit", lambda spark: 5)
    rows = spark.range(30).select(
        F.when(F.col("id") < 20, "hot").when(F.col("id") < 24, None).otherwise(F.col("id").cast("string")).alias("device"),
        F.col("id").alias("n"))
    K.write_per_device(rows, str(tmp_path / "hot"), collected_at=F.lit("2024-02-03 04:05:06").cast("timestamp"))
    back = spark.read.parquet(str(tmp_path / "hot"))
    assert sorted((r["device_name"] or "", r["n"]) for r in back.collect()) == sorted((r["device"] or "", r["n"]) for r in rows.collect())
