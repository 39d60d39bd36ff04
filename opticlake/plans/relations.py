"""Queries over filters, projections, joins, aggregates and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake import constants as C
from opticlake import schemas as S
from opticlake.functions import device_profile
from opticlake.operators import aggregate as G
from opticlake.operators import enrich as J
from opticlake.operators import exposition as U
from opticlake.operators import extract as X
from opticlake.operators import filters as P
from opticlake.plans import views as V
from opticlake.plans.catalog import query
from opticlake.plans.views import view
from opticlake.session import materialize
from opticlake.sources.lake import latest_errors_topk as newest_errors

_BASE = "'et-' || substr(split_part(if_name, ':', 1), 4)"


# --- filters and validity ----------------------------------------------------


@query("filter_interfaces", """
    select device, if_name, lane, order_key from t_lanes
    where if_name in (select if_name from t_xcvr where wavelength_nm = 850)""")
def filter_interfaces(spark, sf):
    wanted = view(spark, sf, "t_xcvr").where("wavelength_nm = 850")
    rows = P.filter_interfaces(view(spark, sf, "t_lanes"), wanted)
    return P.filter_interfaces(rows, "").select("device", "if_name", "lane", "order_key")


_GLOBAL = "et-0/3/3, et-0/1/5"


@query("resolve_filter_precedence", f"""
    select l.device, l.if_name, l.order_key from t_lanes l left join t_devices d on l.device = d.device
    where coalesce(d.interface_filter, '{_GLOBAL}') = ''
       or list_contains(list_transform(string_split(coalesce(d.interface_filter, '{_GLOBAL}'), ','), lambda x: trim(x)),
                        l.if_name)""")
def resolve_filter_precedence(spark, sf):
    rows = P.resolve_filter_precedence(view(spark, sf, "t_lanes"), view(spark, sf, "t_devices"), _GLOBAL)
    return rows.select("device", "if_name", "order_key")


_GAPS = """
    select device, case when order_key % 13 = 0 then '' else if_name end as if_name,
           case when order_key % 11 <> 0 then lane end as lane, case when order_key % 7 <> 0 then tx_bias end as tx_bias,
           tx_power, case when order_key % 5 <> 0 then rx_power end as rx_power, order_key, ts
    from t_lanes"""


def _gaps(spark, sf):
    return spark.sql(_GAPS.replace("from t_lanes", "from {t_lanes}"), t_lanes=view(spark, sf, "t_lanes"))


@query("split_valid_lanes", f"""
    select device, if_name, lane, tx_bias, tx_power, rx_power, order_key, ts,
           case when why <> '' then 'missing ' || why end as reason
    from (select *, concat_ws(',', case when if_name = '' then 'if_name' end, case when lane is null then 'lane' end,
                 case when tx_bias is null then 'tx_bias' end, case when rx_power is null then 'rx_power' end) as why
          from ({_GAPS}))""")
def split_valid_lanes(spark, sf):
    valid, rejects = P.split_valid_lanes(_gaps(spark, sf))
    return valid.unionByName(rejects, allowMissingColumns=True)


_NAMELESS = "order_key % 1009 = 0"


@query("fail_device_on_missing_name", f"""
    with bad as (select distinct device from t_lanes where {_NAMELESS}),
    kept as (select device, 'interfaces' as dataset, count(*) as n from t_lanes group by device
             union all select device, 'lanes', count(*) from t_lanes group by device
             union all select device, 'stats', count(*) from t_counters group by device)
    select * from kept where device not in (select device from bad)
    union all select device, 'interface name missing', 0 from bad""")
def fail_device_on_missing_name(spark, sf):
    lanes = view(spark, sf, "t_lanes")
    named = lanes.withColumn("if_name", F.when(~F.expr(_NAMELESS), F.col("if_name")))
    kept, failed = P.fail_device_on_missing_name(
        {"interfaces": named, "lanes": lanes, "stats": view(spark, sf, "t_counters")})
    parts = [df.groupBy("device").agg(F.count("*").alias("n")).withColumn("dataset", F.lit(name))
             for name, df in kept.items()]
    bad = failed.select("device", F.lit(0).cast("long").alias("n"), F.col("error").alias("dataset"))
    return U.union_devices(*parts, bad)


# --- lake projections --------------------------------------------------------

_DEVICE_FACTS = """
    select device, case when s_suppkey % 4 = 0 then device else origin_hostname end as origin_hostname, origin_name,
           device as inventory_instance, 'JUNIPER_' || upper(hardware_model) as device_profile
    from t_devices"""
_STAMP = """ts as timestamp, strftime(make_timestamp(ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') as collection_timestamp"""


def _devices(spark, sf):
    rows = view(spark, sf, "t_devices")
    return rows.select(
        "device", F.when(F.col("s_suppkey") % 4 == 0, F.col("device")).otherwise(F.col("origin_hostname"))
        .alias("origin_hostname"), "origin_name", F.col("device").alias("inventory_instance"),
        device_profile("hardware_model").alias("device_profile"))


_INTERFACES = f"""
    select l.*, {_BASE} as base, lane * 1.0::double as temperature, tx_bias / 8 as voltage,
           case when part_key % 2 = 0 then 'V' || part_key end as vendor, cast(null as varchar) as media_type,
           'FIBER' as fiber_type, case when part_key % 4 = 0 then 'IP' || part_key end as part_number
    from t_lanes l"""


def _interfaces(spark, sf):
    return view(spark, sf, "t_lanes").selectExpr(
        "*", "cast(lane as double) as temperature", "tx_bias / 8 as voltage",
        "case when part_key % 2 = 0 then 'V' || part_key end as vendor", "cast(null as string) as media_type",
        "'FIBER' as fiber_type", "case when part_key % 4 = 0 then 'IP' || part_key end as part_number")


@query("project_interface_dom", f"""
    select coalesce(origin_hostname, '') as origin_hostname, coalesce(origin_name, '') as origin_name,
           coalesce(inventory_instance, '') as inventory_instance, {_STAMP}, device_profile,
           coalesce(vendor, '') as vendor, '' as media_type, fiber_type, i.if_name, temperature, voltage,
           coalesce(c.part_number, i.part_number, '') as part_number, coalesce(c.serial_number, '') as serial_number
    from ({_INTERFACES}) i left join ({_DEVICE_FACTS}) d on i.device = d.device
    left join t_chassis c on i.device = c.device and i.base = c.if_name""")
def project_interface_dom(spark, sf):
    return P.project_interface_dom(_interfaces(spark, sf), _devices(spark, sf), view(spark, sf, "t_chassis"), F.col("ts"))


@query("project_lane_dom", f"""
    select coalesce(origin_hostname, '') as origin_hostname, coalesce(origin_name, '') as origin_name,
           coalesce(inventory_instance, '') as inventory_instance, {_STAMP}, if_name, lane, tx_bias, tx_power, rx_power
    from t_lanes l left join ({_DEVICE_FACTS}) d on l.device = d.device
    where order_key % 13 <> 0 and order_key % 11 <> 0 and order_key % 7 <> 0 and order_key % 5 <> 0""")
def project_lane_dom(spark, sf):
    return P.project_lane_dom(_gaps(spark, sf), _devices(spark, sf), F.col("ts"))


@query("project_interface_counters", f"""
    select coalesce(origin_hostname, '') as origin_hostname, coalesce(origin_name, '') as origin_name,
           coalesce(inventory_instance, '') as inventory_instance, {_STAMP.replace("ts as", "run_timestamp as").replace(
               "make_timestamp(ts", "make_timestamp(run_timestamp")},
           if_name, admin_status, coalesce(oper_status, '') as oper_status, speed_bps, input_bps, input_pps, output_bps,
           output_pps, fec_ccw, fec_nccw, fec_ccw_error_rate, fec_nccw_error_rate, pre_fec_ber
    from ({V.STATS_EXPECTED}) s left join ({_DEVICE_FACTS}) d on s.device = d.device where event_id % 12 <> 2""")
def project_interface_counters(spark, sf):
    stats = X.extract_interface_stats(V.stats_docs(spark, sf))
    return P.project_interface_counters(stats, _devices(spark, sf), F.col("run_timestamp"))


@query("string_hardening", """
    select cast(order_key as varchar) as origin_name, if_name, cast(lane as varchar) as part_number, tx_bias as voltage,
           cast(null as varchar) as vendor, ts as timestamp from t_lanes""")
def string_hardening(spark, sf):
    rows = view(spark, sf, "t_lanes").select(F.col("order_key").alias("origin_name"), "if_name",
                                             F.col("lane").alias("part_number"), F.col("tx_bias").alias("voltage"),
                                             F.col("ts").alias("timestamp"))
    text, number = T.StringType(), T.DoubleType()
    return P.string_hardening(rows, T.StructType([
        T.StructField("origin_name", text), T.StructField("if_name", text), T.StructField("part_number", text),
        T.StructField("voltage", number), T.StructField("vendor", text), T.StructField("timestamp", T.LongType())]))


# --- joins -------------------------------------------------------------------


@query("enrich_device_metadata", """
    select order_key, lane, l.device, if_name,
           case when d.device is null then 'old' else coalesce(nullif(case when s_suppkey % 3 = 0 then ''
             else d.origin_hostname end, ''), 'old') end as origin_hostname,
           'JUNIPER_' || upper(hardware_model) as device_profile, d.origin_name, d.device as inventory_instance
    from t_lanes l left join t_devices d on l.device = d.device""")
def enrich_device_metadata(spark, sf):
    devices = view(spark, sf, "t_devices")
    system = devices.select(
        "device", F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.col("origin_hostname")).alias("origin_hostname"),
        device_profile("hardware_model").alias("device_profile"))
    lanes = view(spark, sf, "t_lanes").select("order_key", "lane", "device", "if_name",
                                              F.lit("old").alias("origin_hostname"))
    return J.enrich_device_metadata(lanes, system, devices.select("device", "origin_name"))


_WITH_PORT = f"from t_lanes l left join t_ports p on l.device = p.device and p.if_name = 'et-' || " \
             f"substr(split_part(l.if_name, ':', 1), 4)"


@query("enrich_transceiver", f"""
    select order_key, lane, l.device, l.if_name, coalesce(p.vendor, 'old') as vendor, part_number, serial_number,
           cable_type, media_type, wavelength, fiber_type, firmware_version {_WITH_PORT}""")
def enrich_transceiver(spark, sf):
    lanes = view(spark, sf, "t_lanes").select("order_key", "lane", "device", "if_name", F.lit("old").alias("vendor"))
    return J.enrich_transceiver(lanes, view(spark, sf, "t_ports"))


@query("serial_precedence", f"""
    select order_key, lane, l.device, l.if_name, coalesce(p.serial_number, c.serial_number) as serial_number
    {_WITH_PORT} left join t_chassis c on l.device = c.device
      and c.if_name = 'et-' || substr(split_part(l.if_name, ':', 1), 4)""")
def serial_precedence(spark, sf):
    lanes = view(spark, sf, "t_lanes").select("order_key", "lane", "device", "if_name")
    rows = J.enrich_transceiver(lanes, view(spark, sf, "t_ports"))
    return J.serial_precedence(rows, view(spark, sf, "t_chassis")).select(*lanes.columns, "serial_number")


@query("channel_fanout", """
    select l.order_key, l.device, l.if_name, x.vendor, x.wavelength_nm
    from t_lanes l left join t_xcvr x on x.if_name = 'et-' || substr(split_part(l.if_name, ':', 1), 4)""")
def channel_fanout(spark, sf):
    # The right side is given twice: it must still not multiply the lanes.
    xcvr = view(spark, sf, "t_xcvr").select("if_name", "vendor", "wavelength_nm")
    return J.channel_fanout(view(spark, sf, "t_lanes").select("order_key", "device", "if_name"),
                            xcvr.unionByName(xcvr), on=[])


@query("enrich_lake_chassis", f"""
    select order_key, i.device, i.if_name, coalesce(c.part_number, i.part_number, '') as part_number,
           coalesce(c.serial_number, '') as serial_number
    from ({_INTERFACES}) i left join t_chassis c on i.device = c.device and i.base = c.if_name""")
def enrich_lake_chassis(spark, sf):
    rows = J.enrich_lake_chassis(_interfaces(spark, sf), view(spark, sf, "t_chassis"))
    return rows.select("order_key", "device", "if_name", "part_number", "serial_number")


@query("assemble_device_bundle", """
    with s as (select device, case when s_suppkey % 4 <> 0 then origin_hostname end as h,
                      'JUNIPER_' || upper(hardware_model) as p from t_devices where s_suppkey % 5 <> 0),
    c as (select device, case when s_suppkey % 3 <> 0 then origin_name end as n from t_devices where s_suppkey % 2 = 0),
    o as (select distinct device from t_lanes), e as (select distinct device from t_counters),
    a as (select device from s union select device from c union select device from o union select device from e)
    select a.device, coalesce(h, a.device) as origin_hostname,
           case when c.device is null then a.device else n end as origin_name, s.device as inventory_instance,
           p as device_profile, s.device is not null as has_system, c.device is not null as has_chassis,
           o.device is not null as has_optics, e.device is not null as has_stats
    from a left join s on a.device = s.device left join c on a.device = c.device left join o on a.device = o.device
    left join e on a.device = e.device""")
def assemble_device_bundle(spark, sf):
    devices = view(spark, sf, "t_devices")
    system = devices.where("s_suppkey % 5 <> 0").select(
        "device", F.when(F.col("s_suppkey") % 4 != 0, F.col("origin_hostname")).alias("origin_hostname"),
        device_profile("hardware_model").alias("device_profile"))
    chassis = devices.where("s_suppkey % 2 = 0").select(
        "device", F.when(F.col("s_suppkey") % 3 != 0, F.col("origin_name")).alias("origin_name"))
    return J.assemble_device_bundle(system, chassis, view(spark, sf, "t_lanes"), view(spark, sf, "t_counters"))


_COUNTERS = """
    select device, if_name, ts as timestamp, min(order_key) as fec_ccw, max(part_key) as fec_nccw
    from t_lanes where lane % 2 = 1 group by device, if_name, ts"""
_DT_HR = "strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') as dt, strftime(make_timestamp(timestamp * 1000000), '%H') as hr"


def _counters(spark, sf):
    return view(spark, sf, "t_lanes").where("lane % 2 = 1").groupBy("device", "if_name", F.col("ts").alias("timestamp")).agg(
        F.min("order_key").alias("fec_ccw"), F.max("part_key").alias("fec_nccw"))


def _dt_hr(df):
    at = F.timestamp_seconds("timestamp")
    return df.withColumns({"dt": F.date_format(at, "yyyy-MM-dd"), "hr": F.date_format(at, "HH")})


@query("join_counters_lanes", f"""
    select c.device, c.if_name, c.timestamp, {_DT_HR.replace("timestamp(timestamp", "timestamp(c.timestamp")}, fec_ccw,
           fec_nccw, lane, tx_bias, rx_power
    from ({_COUNTERS}) c join t_lanes l on c.device = l.device and c.if_name = l.if_name and c.timestamp = l.ts""")
def join_counters_lanes(spark, sf):
    lanes = view(spark, sf, "t_lanes").select("device", "if_name", F.col("ts").alias("timestamp"), "lane", "tx_bias",
                                              "rx_power")
    return J.join_counters_lanes(_dt_hr(_counters(spark, sf)), _dt_hr(lanes))


@query("training_frame", f"""
    with i as (select distinct device, if_name, ts as timestamp from t_lanes),
    l as (select device, if_name, ts as timestamp, count(*) as lane_count,
                 {", ".join(f"min({m}) as {m}_min, round(avg({m}), 6) as {m}_avg, max({m}) as {m}_max"
                            for m in ("rx_power", "tx_power", "tx_bias"))}
          from t_lanes group by device, if_name, ts)
    select i.device, i.if_name, i.timestamp, fec_ccw, fec_nccw, lane_count,
           {", ".join(f"{m}_{k}" for m in ("rx_power", "tx_power", "tx_bias") for k in ("min", "avg", "max"))}
    from i left join ({_COUNTERS}) c on i.device = c.device and i.if_name = c.if_name and i.timestamp = c.timestamp
    left join l on i.device = l.device and i.if_name = l.if_name and i.timestamp = l.timestamp""")
def training_frame(spark, sf):
    lanes = view(spark, sf, "t_lanes").withColumnRenamed("ts", "timestamp")
    interfaces = lanes.select("device", "if_name", "timestamp").distinct()
    frame = J.training_frame(interfaces, lanes, _counters(spark, sf))
    return frame.withColumns({f"{m}_avg": F.round(f"{m}_avg", 6) for m in ("rx_power", "tx_power", "tx_bias")})


# --- aggregates --------------------------------------------------------------


@query("run_summary", """
    with n as (select device, count(*) as lanes, 0 as counters, 0 as failed from t_lanes group by device
               union all select device, 0, count(*), 0 from t_counters group by device
               union all select device, 0, 0, 1 from t_devices where interface_filter is null),
    d as (select device, sum(lanes) as lanes, sum(counters) as counters, max(failed) as failed from n group by device)
    select device, cast(lanes as bigint) as lanes, cast(counters as bigint) as counters, cast(1 as bigint) as devices,
           cast(failed as bigint) as failed_devices, cast(failed > 0 as int) as exit_status from d
    union all
    select null, cast(sum(lanes) as bigint), cast(sum(counters) as bigint), count(*), cast(sum(failed) as bigint),
           cast(sum(failed) > 0 as int) from d""")
def run_summary(spark, sf):
    failed = view(spark, sf, "t_devices").where("interface_filter is null").select("device")
    return G.run_summary({"lanes": view(spark, sf, "t_lanes"), "counters": view(spark, sf, "t_counters")}, failed)


@query("doc_metric_counts", f"""
    with d as (select distinct device, ts as run_timestamp from t_lanes),
    n as (select device, run_timestamp, count(*) as n from ({V.OPTICS_EXPECTED}) group by all)
    select d.device, d.run_timestamp, 'optics_diagnostics' as rpc, coalesce(n, 0) as interfaces_count,
           coalesce(n, 0) as lanes_count, n is null as empty
    from d left join n on d.device = n.device and d.run_timestamp = n.run_timestamp""")
def doc_metric_counts(spark, sf):
    docs = V.optics_docs(spark, sf)
    rows = materialize(X.optics_elements(docs, schema=S.OPTICS_LANE_REPLY), "optics")
    return G.doc_metric_counts(docs, interfaces=rows, lanes=X.optics_lanes(rows))


@query("metric_coverage", f"""
    select device, max(fec_ccw is not null) as has_corrected, max(fec_nccw is not null) as has_uncorrected,
           max(fec_ccw_error_rate is not null) as has_rates, max(pre_fec_ber is not null) as has_ber,
           cast(4 as bigint) as bins
    from ({V.STATS_EXPECTED}) where event_id % 12 <> 2 group by device""")
def metric_coverage(spark, sf):
    rows = materialize(X.stats_elements(V.stats_docs(spark, sf)), "stats")
    return G.metric_coverage(X.stats_rows(rows), X.histogram_rows(rows))


def _rollup_sql(level: str, seconds: int) -> str:
    parts = ", ".join(
        f"count({m}) as {m}_count, min({m}) as {m}_min, round(avg({m}), 6) as {m}_avg, max({m}) as {m}_max, "
        f"arg_max({m}, ts_us) filter ({m} is not null) as {m}_last" for m in ("value", "fec_nccw"))
    return f"""select device, if_name, '{level}' as level, ts // {seconds} * {seconds} as start, {parts}
               from t_series group by device, if_name, ts // {seconds}"""


@query("rollup_hourly_daily", _rollup_sql("hour", 3600) + " union all " + _rollup_sql("day", 86400))
def rollup_hourly_daily(spark, sf):
    rows = G.rollup_hourly_daily(view(spark, sf, "t_series"), ["value", "fec_nccw"], order="ts_us")
    return rows.withColumns({f"{m}_avg": F.round(f"{m}_avg", 6) for m in ("value", "fec_nccw")})


@query("correlate_fec_optics", """
    select vendor, count(*) filter (x is not null) as fec_ccw__tx_bias_points, round(corr(y, x), 6) as fec_ccw__tx_bias_corr,
           round(covar_samp(y, x) / 1000, 4) as fec_ccw__tx_bias_covar, round(regr_slope(y, x), 4) as fec_ccw__tx_bias_slope
    from (select p.vendor, cast(l.order_key % 5000 as double) as y, l.tx_bias as x
          from t_lanes l left join t_ports p on l.device = p.device
            and p.if_name = 'et-' || substr(split_part(l.if_name, ':', 1), 4)) group by vendor""")
def correlate_fec_optics(spark, sf):
    frame = J.enrich_transceiver(view(spark, sf, "t_lanes"), view(spark, sf, "t_ports")).withColumn(
        "fec_ccw", F.col("order_key") % 5000)
    rows = G.correlate_fec_optics(frame, ["vendor"], [("fec_ccw", "tx_bias")])
    name = "fec_ccw__tx_bias"
    return rows.withColumns({
        f"{name}_corr": F.round(f"{name}_corr", 6), f"{name}_covar": F.round(F.col(f"{name}_covar") / 1000, 4),
        f"{name}_slope": F.round(f"{name}_slope", 4)})


_RMA = "757382400 + s_suppkey % 50 * 864000"


@query("rma_comparison", "select device, " + ", ".join(
    f"""nullif(count(*) filter ({test}), 0) as {phase}_tx_bias_count,
        round(avg(tx_bias) filter ({test}), 6) as {phase}_tx_bias_mean,
        round(quantile_cont(tx_bias, 0.5) filter ({test}), 6) as {phase}_tx_bias_p50,
        round(quantile_cont(tx_bias, 0.95) filter ({test}), 6) as {phase}_tx_bias_p95"""
    for phase, test in (("before", "ts < event_time"), ("after", "ts >= event_time"))
) + f""", round(avg(tx_bias) filter (ts >= event_time) - avg(tx_bias) filter (ts < event_time), 6) as tx_bias_change
    from t_lanes join (select device, {_RMA} as event_time from t_devices) using (device) group by device""")
def rma_comparison(spark, sf):
    events = view(spark, sf, "t_devices").select("device", F.expr(_RMA).alias("event_time"))
    rows = G.rma_comparison(view(spark, sf, "t_lanes"), events, ["tx_bias"])
    return rows.withColumns({c: F.round(c, 6) for c, kind in rows.dtypes if kind == "double"})


@query("vendor_fleet_stats", """
    select vendor, fiber_type, count(*) as rows, count(distinct device || '/' || l.if_name) as interfaces,
           round(avg(rx_power), 6) as rx_power_mean, round(quantile_cont(rx_power, 0.5), 6) as rx_power_p50,
           round(quantile_cont(rx_power, 0.95), 6) as rx_power_p95
    from (select l.*, p.vendor, p.fiber_type
          from t_lanes l left join t_ports p on l.device = p.device
            and p.if_name = 'et-' || substr(split_part(l.if_name, ':', 1), 4)) l group by vendor, fiber_type""")
def vendor_fleet_stats(spark, sf):
    frame = J.enrich_transceiver(view(spark, sf, "t_lanes"), view(spark, sf, "t_ports"))
    rows = G.vendor_fleet_stats(frame, ["rx_power"], ["vendor", "fiber_type"])
    return rows.withColumns({c: F.round(c, 6) for c, kind in rows.dtypes if kind == "double"})


# --- reshaping, reports ------------------------------------------------------


@query("latest_errors_topk", """
    select if_name, fec_ccw, fec_nccw, timestamp, collection_timestamp, dt, device
    from (select if_name, fec_ccw, fec_nccw, ts as timestamp, device,
                 strftime(make_timestamp(ts * 1000000), '%Y-%m-%dT%H:%M:%SZ') as collection_timestamp,
                 strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') as dt from t_series)
    where device = (select min(device) from t_series) and dt = (select max(strftime(make_timestamp(ts * 1000000),
        '%Y-%m-%d')) from t_series where device = (select min(device) from t_series))
    order by collection_timestamp desc, if_name, timestamp, fec_ccw, fec_nccw nulls first limit 100""")
def latest_errors_topk(spark, sf):
    rows = P.run_time_columns(view(spark, sf, "t_series").withColumnRenamed("ts", "timestamp"))
    rows = rows.select("if_name", "fec_ccw", "fec_nccw", "timestamp", "collection_timestamp", "dt", "device")
    device = rows.agg(F.min("device")).first()[0]
    day = rows.where(F.col("device") == device).agg(F.max("dt")).first()[0]
    return newest_errors(rows, day, device)


@query("flatten_optical", f"""
    select device, if_name, 'interface' as metric_type, cast(null as int) as lane, temperature, cast(null as double) as tx_bias
    from ({_INTERFACES})
    union all select device, if_name, 'lane', lane, null, tx_bias from t_lanes""")
def flatten_optical(spark, sf):
    return U.flatten_optical(_interfaces(spark, sf).select("device", "if_name", "temperature"),
                             view(spark, sf, "t_lanes").select("device", "if_name", "lane", "tx_bias"))


@query("flatten_stats", "select device, if_name, fec_ccw, fec_nccw from t_series")
def flatten_stats(spark, sf):
    # Documents of one interface each, opened again.
    rows = view(spark, sf, "t_series")
    docs = rows.select(F.array(F.struct("device", "if_name", "fec_ccw", "fec_nccw")).alias("interfaces"))
    return U.flatten_stats(docs)


@query("flatten_transceivers", """
    select device, if_name, vendor, part_number, serial_number from t_ports""")
def flatten_transceivers(spark, sf):
    # One map of one port per document, as each slot reply gives.
    ports = view(spark, sf, "t_ports")
    docs = ports.select("device", F.create_map(
        "if_name", F.struct("vendor", "part_number", "serial_number")).alias("transceivers"))
    return U.flatten_transceivers(docs)


@query("union_devices", """
    select device, if_name, lane, cast(null as bigint) as fec_ccw from t_lanes
    union all select device, if_name, null, fec_ccw from t_series""")
def union_devices(spark, sf):
    return U.union_devices(view(spark, sf, "t_lanes").select("device", "if_name", "lane"),
                           view(spark, sf, "t_series").select("device", "if_name", "fec_ccw"))


_GAUGES = ["admin_status", "oper_status"]


def _samples_sql(columns: dict[str, str], source: str, label: str) -> str:
    return " union all ".join(
        f"select {label} as labels, '{metric}' as metric, cast({value} as double) as value from ({source}) "
        f"where ({value}) is not null" for metric, value in columns.items())


_IF_LABEL = "'interface=\"' || if_name || '\",vendor=\"dev' || '\"'"
_OPTICS_SAMPLES = _samples_sql(
    {**{f: f"q + {i}" for i, f in enumerate(C.THRESHOLD_TAGS)}, "temperature": "q + 0.5", "voltage": "q / 8",
     "tx_bias": "q", "tx_power_mw": "q * 2", "tx_power": "tx_power", "rx_power_mw": "q * 3", "rx_power": "rx_power"},
    V.OPTICS_EXPECTED, _IF_LABEL)
_STATS_SAMPLES = _samples_sql(
    {**{f"interface_{c}": f"case when {c} = 'up' then 1 when {c} is not null then 0 end" for c in _GAUGES},
     **{f"interface_{c}": c for c in C.PREFIXED_MEASURES}},
    f"select * from ({V.STATS_EXPECTED}) where event_id % 12 <> 2", _IF_LABEL)


@query("unpivot_exposition_interface", f"{_OPTICS_SAMPLES} union all {_STATS_SAMPLES}")
def unpivot_exposition_interface(spark, sf):
    optics = X.extract_optics_interface(V.optics_docs(spark, sf), {"vendor": "dev"})
    stats = X.inject_metadata(X.extract_interface_stats(V.stats_docs(spark, sf)), {"vendor": "dev"})
    return U.union_devices(*[U.unpivot_exposition_interface(df, text=True) for df in (optics, stats)])


@query("unpivot_exposition_lane", _samples_sql(
    {"rx_power_mw": "q * 3", "rx_power": "lane_rx", "tx_power_mw": "q * 2", "tx_power": "tx_power",
     "tx_bias": "lane_bias"}, V.OPTICS_EXPECTED, "'interface=\"' || if_name || '\",lane=\"' || lane || '\"'"))
def unpivot_exposition_lane(spark, sf):
    return U.unpivot_exposition_lane(X.extract_optics_lanes(V.optics_docs(spark, sf)), text=True)
