"""Whole runs: replies to enriched rows, to the hourly lake, and to exposition text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.operators import enrich as J
from opticlake.operators import exposition as E
from opticlake.operators import extract as X
from opticlake.operators import filters as P
from opticlake.operators.as_of import changes
from opticlake.operators.joins import join_per_key
from opticlake.plans import views as V
from opticlake.plans.catalog import query
from opticlake.plans.extraction import _SYSTEM
from opticlake.session import materialize


def collect_run(system_docs: DataFrame, chassis_docs: DataFrame, optics_docs: DataFrame, stats_docs: DataFrame,
                ports: DataFrame, devices: DataFrame, global_filter: str | None = None) -> dict[str, DataFrame]:
    """Parse the replies, apply the interface filters and merge metadata into the optics rows.

    `ports` are port details, or the replies per slot that hold them (with fpc and pic); the later slot counts.
    """
    if "xml" in ports.columns:
        ports = X.merge_pic_slots(X.extract_pic_ports(ports))
    # Both are joined more than once. Written, their size is known, and rows meet a small one without an exchange.
    devices = materialize(devices.select("device", "interface_filter"), "filters")
    if "run_timestamp" not in ports.columns or "run_timestamp" in optics_docs.columns:
        run = [c for c in ("run_timestamp",) if c in ports.columns]
        ports = changes(ports.select("device", "if_name", *run, *C.TRANSCEIVER_COLUMNS), ["device", "if_name"])
    system = X.extract_system_info(system_docs)
    # Both optics tables come from the same replies: these are parsed once.
    interfaces, lanes = X.optics_tables(optics_docs)
    serials, chassis = X.extract_chassis_inventory(chassis_docs)
    # Counters and the bins beside them also share their replies.
    counted = materialize(X.stats_elements(stats_docs), "stats")
    bins = X.pivot_fec_histogram(X.histogram_rows(counted))
    keys = [c for c in counted.columns if c != "pi"]
    stats = join_per_key(X.stats_rows(counted), bins, keys, nulls_match=True)
    stats = P.resolve_filter_precedence(stats, devices, global_filter)
    merged = {"stats_seen": _runs(P.resolve_filter_precedence(counted.select(*keys), devices, global_filter))}
    for name, rows in (("interfaces", interfaces), ("lanes", lanes)):
        rows = P.resolve_filter_precedence(rows, devices, global_filter)
        if name == "interfaces":
            merged["interfaces_seen"] = _runs(rows)
        rows = J.enrich_device_metadata(rows, system, serials)
        merged[name] = J.enrich_ports(rows, ports, chassis)
    return {"system": system, "serials": serials, "chassis": chassis, "stats": stats, **merged}


def _runs(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in X.DOC_KEYS if c in rows.columns])


def hourly_datasets(bundle: dict[str, DataFrame], run_timestamp, keep: list[str] = ()) -> tuple[dict[str, DataFrame], DataFrame]:
    """The three lake datasets of a run, with the columns of `keep` beside theirs, and the devices that failed."""
    rows, failed = P.fail_device_on_missing_name({k: bundle[k] for k in ("interfaces", "lanes", "stats")})
    # Who reported when, without what was joined to it; and the few runs at which a device changed, for all three datasets.
    seen = {k: bundle.get(f"{k}_seen", bundle[k]) for k in ("interfaces", "stats")}
    devices = P.device_changes(J.assemble_device_bundle(bundle["system"], bundle["serials"], seen["interfaces"], seen["stats"]))
    return {
        "interface_dom": P.project_interface_dom(rows["interfaces"], devices, bundle["chassis"], run_timestamp, keep),
        "lane_dom": P.project_lane_dom(rows["lanes"], devices, run_timestamp, keep),
        "interface_counters": P.project_interface_counters(rows["stats"], devices, run_timestamp, keep),
    }, failed


def exposition_text(bundle: dict[str, DataFrame]) -> DataFrame:
    """Lines of a run with the instance they belong to."""
    parts = [
        E.unpivot_exposition_interface(bundle["interfaces"], ["device"], text=True),
        E.unpivot_exposition_interface(bundle["stats"], ["device"], text=True),
        E.unpivot_exposition_lane(bundle["lanes"], ["device"], text=True),
    ]
    return E.exposition_lines(E.union_devices(*parts), ["device"]).withColumnRenamed("device", "instance")


@query("lane_summary", f"""
    select device, count(*) as lanes, sum(cast(q as bigint)) as bias, min(lane_rx) as rx_min, max(lane_rx) as rx_max
    from ({V.OPTICS_EXPECTED}) where lane_bias is not null and lane_rx is not null group by device""".replace(
        "sum(cast(q as bigint))", "cast(sum(cast(q as bigint)) as bigint)"))
def lane_summary(spark, sf):
    valid, _ = P.split_valid_lanes(X.extract_optics_lanes(V.optics_docs(spark, sf)))
    return valid.groupBy("device").agg(
        F.count("*").alias("lanes"), F.sum(F.col("tx_bias").cast("long")).alias("bias"),
        F.min("rx_power").alias("rx_min"), F.max("rx_power").alias("rx_max"),
    )


_FACTS = f"""
    select a.device, coalesce(s.origin_hostname, a.device) as origin_hostname,
           case when s.device is null then a.device
                when s.s_suppkey % 13 not in (0, 11) and s.s_suppkey % 5 <> 0 then s.origin_name else '' end as origin_name,
           coalesce(s.device, '') as inventory_instance
    from (select device from t_lanes union select device from t_counters union select device from t_devices) a
    left join (select d.device, s_suppkey, d.origin_name, y.origin_hostname
               from t_devices d join ({_SYSTEM}) y on d.device = y.device) s on a.device = s.device"""


def _run_bundle(spark, sf):
    """All four kinds of replies of the views, every interface wanted."""
    devices = V.view(spark, sf, "t_devices").select("device", F.lit("").alias("interface_filter"))
    return collect_run(V.system_docs(spark, sf), V.chassis_docs(spark, sf), V.optics_docs(spark, sf),
                       V.stats_docs(spark, sf), V.view(spark, sf, "t_ports"), devices)


@query("collect_hourly_datasets", f"""
    with f as ({_FACTS}), i as ({V.OPTICS_EXPECTED}), rows as (
        select 'interface_dom' as dataset, device, run_timestamp from i
        union all select 'lane_dom', device, run_timestamp from i where lane_bias is not null and lane_rx is not null
        union all select 'interface_counters', device, run_timestamp from ({V.STATS_EXPECTED}) where event_id % 12 <> 2)
    select dataset, origin_hostname, origin_name, inventory_instance, count(*) as n,
           cast(sum(run_timestamp) as bigint) as stamps
    from rows join f on rows.device = f.device group by all""")
def collect_hourly_datasets(spark, sf):
    datasets, _ = hourly_datasets(_run_bundle(spark, sf), F.col("run_timestamp"))
    parts = [
        df.groupBy("origin_hostname", "origin_name", "inventory_instance").agg(
            F.count("*").alias("n"), F.sum("timestamp").alias("stamps")).withColumn("dataset", F.lit(name))
        for name, df in datasets.items()
    ]
    return E.union_devices(*parts)


@query("collect_exposition", f"""
    with i as ({V.OPTICS_EXPECTED}), s as (select * from ({V.STATS_EXPECTED}) where event_id % 12 <> 2),
    v as (select device as instance, 'temperature' as metric, count(*) as n from i group by device
          union all select device, 'rx_power', count(rx_power) + count(lane_rx) from i group by device
          union all select device, 'tx_bias', count(*) + count(lane_bias) from i group by device
          union all select device, 'interface_fec_ccw', count(fec_ccw) from s group by device
          union all select device, 'interface_oper_status', count(oper_status) from s group by device)
    select * from v where n > 0""")
def collect_exposition(spark, sf):
    lines = exposition_text(_run_bundle(spark, sf))
    metric = F.substring_index("value", "{", 1)
    shown = ["temperature", "rx_power", "tx_bias", "interface_fec_ccw", "interface_oper_status"]
    return lines.select("instance", metric.alias("metric")).where(F.col("metric").isin(shown)).groupBy(
        "instance", "metric").agg(F.count("*").alias("n"))
