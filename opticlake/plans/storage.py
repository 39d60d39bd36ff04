"""Queries over sources, lake writes, maintenance and text sinks; each writes to scratch and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake import constants as C
from opticlake import schemas as S
from opticlake.functions import run_time_columns
from opticlake.operators import exposition as U
from opticlake.operators import extract as X
from opticlake.plans import views as V
from opticlake.plans.catalog import query
from opticlake.plans.extraction import _SYSTEM
from opticlake.plans.registry import default_registry
from opticlake.plans.views import view
from opticlake.session import scratch
from opticlake.sources import lake as K
from opticlake.sources import replies as A

# Samples stamped with the start of their six-hour run.
LAKE = """
    select device, if_name, event_id, ts // 21600 * 21600 as timestamp,
           strftime(make_timestamp(ts // 21600 * 21600 * 1000000), '%Y-%m-%dT%H:%M:%SZ') as collection_timestamp,
           strftime(make_timestamp(ts // 21600 * 21600 * 1000000), '%Y-%m-%d') as dt,
           strftime(make_timestamp(ts // 21600 * 21600 * 1000000), '%H') as hr, fec_ccw, fec_nccw, value
    from t_series"""
_SHOWN = ["device", "if_name", "event_id", "timestamp", "fec_ccw", "fec_nccw", "dt", "hr"]


def lake_rows(spark, sf):
    run = (F.floor(F.col("ts") / 21600) * 21600).alias("timestamp")
    rows = view(spark, sf, "t_series").select("device", "if_name", "event_id", run, "fec_ccw", "fec_nccw", "value")
    return run_time_columns(rows)


def _written(spark, sf, label):
    root = scratch(spark, label)
    K.write_lake_hourly({"interface_counters": lake_rows(spark, sf)}, root)
    return root


# --- sources -----------------------------------------------------------------


def _named(docs, suffix):
    return docs.where(F.col("xml").isNotNull()).select(
        F.concat_ws("_", "device", "rpc", F.lit(suffix)).alias("name"), F.col("xml").alias("content"))


@query("scan_rpc_docs", f"""
    select device, 'system_information' as rpc, cast(7 as bigint) as run_timestamp, origin_hostname, os_version
    from ({_SYSTEM})
    union all
    -- A file without a byte holds no reply: the file scan does not list it.
    select device, 'chassis_inventory', 7, null, null from t_devices where s_suppkey % 13 <> 11""")
def scan_rpc_docs(spark, sf):
    folder = scratch(spark, "replies")
    files = _named(V.system_docs(spark, sf), "raw.xml").unionByName(
        _named(V.chassis_docs(spark, sf).drop("hardware_model"), "raw.xml"))
    A.write_named_files(files, folder)
    docs = A.scan_rpc_docs(spark, folder, 7)
    system = X.extract_system_info(docs.where(F.col("rpc") == "system_information"))
    return docs.select("device", "rpc", "run_timestamp").join(
        system.select("device", F.lit("system_information").alias("rpc"), "origin_hostname", "os_version"),
        ["device", "rpc"], "left")


def _device_optics(spark, sf):
    """One reply per device with up to four interfaces below an unusual wrapper."""
    reply = """'<rpc-reply><any><deep>' || array_join(transform(sequence(0, cast(s_suppkey % 4 as int)), i ->
        '<physical-interface><name>et-0/0/' || i || '</name><optics-diagnostics><optics-diagnostics-lane-values>'
        || '<lane-index>' || i || '</lane-index><laser-bias-current>' || (s_suppkey + i) || '</laser-bias-current>'
        || '</optics-diagnostics-lane-values></optics-diagnostics></physical-interface>'), '')
        || case when s_suppkey % 7 = 0 then '<physical-interface><name>cut' else '</deep></any></rpc-reply>' end"""
    return view(spark, sf, "t_devices").select(
        "device", F.lit("optics_diagnostics").alias("rpc"), F.expr(reply).alias("xml"))


@query("scan_xml_rows", """
    select device, 'et-0/0/' || i as if_name, cast(s_suppkey + i as double) as tx_bias
    from t_devices, (select unnest(range(4)) as i) where i <= s_suppkey % 4 and s_suppkey % 7 <> 0""")
def scan_xml_rows(spark, sf):
    folder = scratch(spark, "replies")
    A.write_named_files(_named(_device_optics(spark, sf), "raw.xml"), folder)
    rows = A.scan_xml_rows(spark, folder).select("device", F.struct("name", "optics-diagnostics").alias("pi"))
    rows = X.drop_unavailable_optics(rows)
    lanes = rows.select("device", X.first_text(F.col("pi"), "name").alias("if_name"),
                        F.explode("diag.optics-diagnostics-lane-values").alias("l"))
    return lanes.select("device", "if_name", X.parse_numeric_units(
        F.get(F.col("l")["laser-bias-current"], F.lit(0))).alias("tx_bias"))


@query("scan_metrics_json", """
    select 'my_' || s_suppkey as device, 'system_information' as kind, origin_hostname as text, null::bigint as n
    from t_devices
    union all select 'my_' || s_suppkey, 'chassis_inventory', origin_name, 2 from t_devices where s_suppkey % 2 = 0
    union all select 'my_' || s_suppkey, 'optics_diagnostics', null, 1 + s_suppkey % 3 from t_devices
    union all select 'my_' || s_suppkey, 'interface_statistics', 'et-0/0/1', s_suppkey * 10 from t_devices""")
def scan_metrics_json(spark, sf):
    folder = scratch(spark, "metrics")
    devices = view(spark, sf, "t_devices").withColumn("d", F.concat(F.lit("my_"), "s_suppkey"))
    name = F.struct(F.lit("et-0/0/1").alias("if_name"), (F.col("s_suppkey") * 10).alias("fec_ccw"))
    documents = {
        "system_information": F.struct(F.col("d").alias("device"), "origin_hostname", "hardware_model"),
        "chassis_inventory": F.struct("origin_name", F.create_map(
            F.lit("et-0/0/0"), F.struct("origin_name"), F.lit("et-0/0/1"), F.struct("origin_name")).alias("transceivers")),
        "optics_diagnostics": F.struct(F.array_repeat(name, 1 + F.col("s_suppkey").cast("int") % 3).alias("interfaces")),
        "interface_statistics": F.struct(F.array(name).alias("interfaces")),
        "pic_detail": F.struct("origin_name"),
        "system_information_metrics_with_metadata": F.struct("origin_name"),
    }
    files = [
        (devices.where("s_suppkey % 2 = 0") if kind == "chassis_inventory" else devices).select(
            F.concat("d", F.lit(f"_{kind}_metrics.json")).alias("name"), F.to_json(doc).alias("content"))
        for kind, doc in documents.items()
    ]
    A.write_named_files(U.union_devices(*files), folder)
    read = A.scan_metrics_json(spark, folder)
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    values = {
        "system_information": (F.col("origin_hostname"), number),
        "chassis_inventory": (F.col("origin_name"), F.size("transceivers").cast("long")),
        "optics_diagnostics": (text, F.size("interfaces").cast("long")),
        "interface_statistics": (F.get("interfaces.if_name", F.lit(0)),
                                 F.get("interfaces.fec_ccw", F.lit(0)).cast("long")),
    }
    return U.union_devices(*[
        read[kind].select("device", F.lit(kind).alias("kind"), t.alias("text"), n.alias("n"))
        for kind, (t, n) in values.items()
    ])


_FIRST_DAY = f"(select min(dt) from ({LAKE}))"


def _first_day(spark, sf):
    return lake_rows(spark, sf).agg(F.min("dt")).first()[0]


@query("scan_lake_partition", f"""
    select {", ".join(_SHOWN)} from ({LAKE}) where dt >= {_FIRST_DAY} and dt <= '2024-01-20' and hr = '06'""")
def scan_lake_partition(spark, sf):
    root = _written(spark, sf, "lake")
    return K.scan_lake_partition(
        spark, root, "interface_counters", _first_day(spark, sf), "2024-01-20", "06").select(*_SHOWN)


@query("scan_columns_pushdown", f"""
    select device, if_name, fec_nccw from ({LAKE}) where fec_nccw > 0 and dt >= '2024-01-05'""")
def scan_columns_pushdown(spark, sf):
    return K.scan_columns_pushdown(spark, _written(spark, sf, "lake"), "interface_counters",
                                   ["device", "if_name", "fec_nccw"], (F.col("fec_nccw") > 0) & (F.col("dt") >= "2024-01-05"))


@query("load_device_inventory", """
    select device, grp as "group", shard, interface_filter,
           case when shard in ('ASIA', 'EUROPE') then hardware_model end as hardware_model from t_devices""")
def load_device_inventory(spark, sf):
    devices = view(spark, sf, "t_devices").withColumnRenamed("grp", "group").select(
        "device", "group", "shard", "interface_filter", "hardware_model")
    known = F.col("shard").isin("ASIA", "EUROPE")
    return A.load_device_inventory(devices.where(known), devices.where(~known).drop("hardware_model"))


@query("route_docs_by_rpc", """
    select 'system_information' as rpc, device, false as filterable, count(*) as docs from t_devices group by device
    union all select 'chassis_inventory', device, false, count(*) from t_devices group by device
    union all select 'optics_diagnostics', device, true, count(*) from t_lanes group by device
    union all select 'interface_statistics', device, true, count(*) from t_counters group by device""")
def route_docs_by_rpc(spark, sf):
    docs = U.union_devices(V.system_docs(spark, sf), V.chassis_docs(spark, sf).drop("hardware_model"),
                           V.optics_docs(spark, sf), V.stats_docs(spark, sf))
    routed = A.route_docs_by_rpc(docs, default_registry())
    return U.union_devices(*[
        routed[name].groupBy("rpc", "device", "filterable").agg(F.count("*").alias("docs")) for name in C.METRIC_TYPES])


@query("register_rpc_transform", """
    select device, cast(0 as bigint) as run_timestamp, s_suppkey % 4 as slot from t_devices
    where s_suppkey % 7 not in (0, 2, 3, 4)""")
def register_rpc_transform(spark, sf):
    # A toy call: the system reply read by a schema and a select of its own.
    from opticlake.plans.registry import register_rpc_transform as register

    schema = S.reply([["system-information"]], S.leaves("host-name", "os-version"))

    def versions(docs):
        parsed, found = X.found_elements(docs, schema, [["system-information"]])
        rows = parsed.select("device", "run_timestamp", F.explode(found).alias("s"))
        rows = rows.where(X.first_text(F.col("s"), "host-name").isNotNull())
        version = F.substring(X.first_text(F.col("s"), "os-version"), 2, 9)
        return rows.select("device", "run_timestamp", version.cast("long").alias("slot"))

    registry = register(default_registry(), "version_check", schema, versions)
    docs = V.system_docs(spark, sf).withColumn("rpc", F.lit("version_check"))
    return registry.run(docs)["version_check"]


# --- lake writes and maintenance ---------------------------------------------


@query("write_lake_hourly", f"""
    select 'interface_counters' as dataset, dt, hr, device, count(*) as n, cast(sum(fec_ccw) as bigint) as total
    from ({LAKE}) group by all
    union all
    select 'lane_dom', dt, hr, device, count(*), cast(sum(fec_nccw) as bigint) from ({LAKE}) group by all""")
def write_lake_hourly(spark, sf):
    root, rows = scratch(spark, "lake"), lake_rows(spark, sf)
    written = K.write_lake_hourly({
        "interface_counters": rows.drop("fec_nccw"), "lane_dom": rows.drop("fec_ccw"),
        "interface_dom": rows.where(F.lit(False)),
    }, root)
    totals = {"interface_counters": "fec_ccw", "lane_dom": "fec_nccw"}
    return U.union_devices(*[
        spark.read.parquet(f"{root}/{name}").groupBy("dt", "hr", "device").agg(
            F.count("*").alias("n"), F.sum(totals[name]).alias("total")).withColumn("dataset", F.lit(name))
        for name in written
    ])


@query("append_same_file", f"""
    select device, count(*) * 2 as n, cast(sum(fec_ccw) * 2 as bigint) as total from ({LAKE}) group by device""")
def append_same_file(spark, sf):
    path, rows = scratch(spark, "append"), lake_rows(spark, sf)
    K.append_same_file(rows, path)
    K.append_same_file(rows, path)
    return spark.read.parquet(path).groupBy("device").agg(F.count("*").alias("n"), F.sum("fec_ccw").alias("total"))


@query("write_per_device", f"""
    select device, '2024-02-03' as dt, '2024-02-03' as collection_date, '2024-02-03T04:05:06' as collection_timestamp,
           origin_name from t_devices
    union all select device, dt, dt, substr(collection_timestamp, 1, 19), 'row ' || event_id from ({LAKE})""")
def write_per_device(spark, sf):
    by_device, by_day = scratch(spark, "devices"), scratch(spark, "days")
    devices = view(spark, sf, "t_devices").select("device", "origin_name")
    K.write_per_device(devices, by_device, collected_at=F.lit("2024-02-03 04:05:06").cast("timestamp"))
    rows = lake_rows(spark, sf).select("device", "timestamp", F.concat(F.lit("row "), "event_id").alias("origin_name"))
    K.write_per_device(rows, by_day, by_device=False, collected_at=F.timestamp_seconds("timestamp"))
    columns = ["device", "dt", "collection_date", "collection_timestamp", "origin_name"]
    return spark.read.parquet(by_device).select(*columns).unionByName(spark.read.parquet(by_day).select(*columns))


@query("write_options", f"""
    select codec, count(*) as n from ({LAKE}), (select unnest(['gzip', 'none', 'snappy']) as codec) group by codec""")
def write_options(spark, sf):
    rows, root = lake_rows(spark, sf), scratch(spark, "codecs")
    for codec in C.CODECS:
        K.append_same_file(rows, f"{root}/codec={codec}", compression=codec)
    return spark.read.parquet(root).groupBy("codec").agg(F.count("*").alias("n"))


@query("write_exposition", " union all ".join(
    f"""select device as instance, '{m}' as metric, 'interface="' || if_name || '",lane="' || lane || '"' as labels,
               {m} as value from t_lanes""" for m in ("rx_power", "tx_power", "tx_bias")))
def write_exposition(spark, sf):
    folder = scratch(spark, "exposition")
    samples = U.unpivot_exposition_lane(view(spark, sf, "t_lanes"), ["device"], text=True)
    lines = U.exposition_lines(samples, ["device"]).withColumnRenamed("device", "instance")
    K.write_exposition(lines, folder, "optics")
    pattern = r"^([a-z_]+)\{(.*)\} (\S+)$"
    return spark.read.text(folder).where(F.col("job") == "optics").select(
        "instance", F.regexp_extract("value", pattern, 1).alias("metric"),
        F.regexp_extract("value", pattern, 2).alias("labels"),
        F.regexp_extract("value", pattern, 3).cast("double").alias("value"))


@query("write_parsed_json", """
    select 'json' as fmt, 'interfaces' as kind, device, if_name, null::int as lane, null::double as tx_bias from t_series
    union all select 'json', 'lanes', device, if_name, lane, tx_bias from t_lanes
    union all select 'jsonl', 'lanes', device, if_name, lane, tx_bias from t_lanes""")
def write_parsed_json(spark, sf):
    root = scratch(spark, "json")
    interfaces = view(spark, sf, "t_series").select("device", "if_name")
    lanes = view(spark, sf, "t_lanes").select("device", "if_name", "lane", "tx_bias")
    K.write_parsed_json(interfaces, lanes, f"{root}/json")
    K.write_parsed_json(interfaces, lanes, f"{root}/jsonl", "jsonl")
    schema = "device string, if_name string, lane int, tx_bias double"
    parts = [("json", "interfaces", "json/interfaces"), ("json", "lanes", "json/lanes"), ("jsonl", "lanes", "jsonl")]
    return U.union_devices(*[
        spark.read.schema(schema).json(f"{root}/{path}").withColumns({"fmt": F.lit(fmt), "kind": F.lit(kind)})
        for fmt, kind, path in parts
    ])


@query("archive_raw", f"""
    select dt, hr, device, count(*) as docs, count(*) filter (event_id % 12 = 11) as empty from ({LAKE}) group by all""")
def archive_raw(spark, sf):
    root = scratch(spark, "bronze")
    run = F.floor(F.col("run_timestamp") / 21600) * 21600
    K.archive_raw(V.stats_docs(spark, sf).withColumn("run_timestamp", run), root)
    return spark.read.parquet(f"{root}/rpc_docs").groupBy("dt", "hr", "device").agg(
        F.count("*").alias("docs"), F.count_if(F.col("xml") == "").alias("empty"))


@query("publish_partition", f"select {', '.join(_SHOWN)} from ({LAKE}) where dt = {_FIRST_DAY} and hr = '06'")
def publish_partition(spark, sf):
    source, target = _written(spark, sf, "lake"), scratch(spark, "published")
    for _ in range(2):
        K.publish_partition(spark, f"{source}/interface_counters", target, _first_day(spark, sf), "06")
    return spark.read.parquet(target).select(*_SHOWN)


def _registered(spark, sf):
    """A registered lake in a database of its own; (table name, root)."""
    root = _written(spark, sf, "lake")
    database = f"lake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/_database'")
    schema = lake_rows(spark, sf).schema
    return K.register_tables(spark, root, {"interface_counters": schema}, database)[0], root


@query("register_tables", f"""
    select dt, hr, count(*) as n, cast(sum(fec_ccw) as bigint) as total from ({LAKE}) group by dt, hr""")
def register_tables(spark, sf):
    name, _ = _registered(spark, sf)
    return spark.table(name).groupBy("dt", "hr").agg(F.count("*").alias("n"), F.sum("fec_ccw").alias("total"))


@query("retention_plan", f"""
    select 'dt=' || dt || '/hr=' || hr as partition, dt, cast(date '2024-02-10' - cast(dt as date) as int) as age_days,
           case when date '2024-02-10' - cast(dt as date) > 20 then 'expire' else 'keep' end as action
    from (select distinct dt, hr from ({LAKE}))""")
def retention_plan(spark, sf):
    name, _ = _registered(spark, sf)
    return K.retention_plan(spark, name, 20, "2024-02-10")


_CHECKED = T.StructType([
    T.StructField("device", T.StringType()), T.StructField("lane", T.IntegerType()),
    T.StructField("fec_nccw", T.LongType()), T.StructField("value", T.DoubleType()),
    T.StructField("vendor", T.StringType()),
])


@query("validate_lake", """
    with r as (select device, if_name, ts, cast(event_id % 10 as int) as lane,
                      case when event_id % 97 = 0 then -1 else fec_nccw end as fec_nccw,
                      case event_id % 50 when 0 then 'inf'::double when 1 then 'nan'::double when 2 then null else value end
                        as value from t_series
               union all select device, if_name, ts, cast(event_id % 10 as int), fec_nccw, value from t_series
               where event_id % 100 = 0)
    select 'null:device' as rule, count(*) as checked, count(*) filter (device is null) as failed from r
    union all select 'null:lane', count(*), count(*) filter (lane is null) from r
    union all select 'range:lane', count(*), count(*) filter (lane > 7) from r
    union all select 'null:fec_nccw', count(*), count(*) filter (fec_nccw is null) from r
    union all select 'negative:fec_nccw', count(*), count(*) filter (fec_nccw < 0) from r
    union all select 'null:value', count(*), count(*) filter (value is null) from r
    union all select 'finite:value', count(*), count(*) filter (isinf(value) or isnan(value)) from r
    union all select 'schema:vendor', count(*), 1 from r
    union all select 'duplicate:device+if_name+ts', cast(sum(n) as bigint), cast(sum(n - 1) as bigint)
    from (select count(*) as n from r group by device, if_name, ts)""")
def validate_lake(spark, sf):
    series = view(spark, sf, "t_series")
    lane = (F.col("event_id") % 10).cast("int").alias("lane")
    bad = F.expr("""case event_id % 50 when 0 then double('inf') when 1 then double('nan') when 2 then null
                    else value end""").alias("value")
    counter = F.when(F.col("event_id") % 97 == 0, -1).otherwise(F.col("fec_nccw")).alias("fec_nccw")
    rows = series.select("device", "if_name", "ts", lane, counter, bad)
    again = series.where("event_id % 100 = 0").select("device", "if_name", "ts", lane, "fec_nccw", "value")
    return K.validate_lake(rows.unionByName(again), _CHECKED, ["device", "if_name", "ts"], ["fec_nccw"], (0, 7))


@query("compact_partition", f"""
    select {', '.join(_SHOWN)}, dt = {_FIRST_DAY} and hr = '06' as merged from ({LAKE})""")
def compact_partition(spark, sf):
    root, rows = scratch(spark, "small"), lake_rows(spark, sf)
    # Two writes without rebalancing leave several small files per hour.
    for part in (rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")):
        part.repartition(3).write.mode("append").partitionBy("dt", "hr").parquet(root)
    day = _first_day(spark, sf)
    K.compact_partition(spark, root, day, "06", 1, scratch(spark, "staging"))
    read = spark.read.parquet(root).select(*_SHOWN, F.col("_metadata.file_path").alias("file"))
    files = read.groupBy("dt", "hr").agg(F.count_distinct("file").alias("files"))
    hour = (F.col("dt") == day) & (F.col("hr") == "06")
    return read.drop("file").join(files, ["dt", "hr"]).withColumn("merged", hour & (F.col("files") == 1)).drop("files")
