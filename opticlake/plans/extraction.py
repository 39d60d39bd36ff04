"""Queries over raw replies. The SQL side never sees XML."""

from __future__ import annotations

from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake import schemas as S
from opticlake.operators import extract as X
from opticlake.plans import views as V
from opticlake.plans.catalog import query

_LANES = f"""
    select device, run_timestamp, if_name, lane, q * 3 as rx_power_mw, lane_rx as rx_power, q * 2 as tx_power_mw,
           tx_power, lane_bias as tx_bias
    from ({V.OPTICS_EXPECTED})"""
_INTERFACES = f"""
    select device, run_timestamp, if_name,
           {", ".join(f"q + {i} as {f}" for i, f in enumerate(C.THRESHOLD_TAGS))},
           q + 0.5 as temperature, q / 8 as voltage, q as tx_bias, q * 2 as tx_power_mw, tx_power,
           q * 3 as rx_power_mw, rx_power
    from ({V.OPTICS_EXPECTED})"""
_STATS_COLUMNS = ", ".join(["device", "run_timestamp", "if_name", *C.STATUS_MEASURES, *C.PREFIXED_MEASURES])
_FEC_STATS = f"select {_STATS_COLUMNS} from ({V.STATS_EXPECTED}) where event_id % 12 <> 2"


@query("extract_optics_interface", _INTERFACES)
def extract_optics_interface(spark, sf):
    return X.extract_optics_interface(V.optics_docs(spark, sf))


@query("extract_optics_lanes", _LANES)
def extract_optics_lanes(spark, sf):
    return X.extract_optics_lanes(V.optics_docs(spark, sf))


@query("drop_unavailable_optics", """
    select device, count(*) as available, count(*) filter (order_key % 16 = 8) as unnamed
    from t_lanes where order_key % 16 not in (0, 3, 4, 11) group by device""")
def drop_unavailable_optics(spark, sf):
    rows = X.interface_elements(V.optics_docs(spark, sf), S.OPTICS_LANE_REPLY, unnamed=C.UNNAMED_INTERFACE)
    return X.drop_unavailable_optics(rows).groupBy("device").agg(
        F.count("*").alias("available"), F.count_if(F.col("if_name") == C.UNNAMED_INTERFACE).alias("unnamed")
    )


@query("extract_temperature_attr", f"""
    select device, run_timestamp, q + 0.5 as temperature from ({V.OPTICS_EXPECTED})""")
def extract_temperature_attr(spark, sf):
    rows = X.drop_unavailable_optics(X.interface_elements(
        V.optics_docs(spark, sf), S.OPTICS_TEMPERATURE_REPLY, unnamed=C.UNNAMED_INTERFACE))
    return rows.select("device", "run_timestamp",
                       X.extract_temperature_attr(F.col("diag")["module-temperature"]).alias("temperature"))


@query("coalesce_rx_power", f"""
    select device, run_timestamp, if_name, rx_power from ({V.OPTICS_EXPECTED})""")
def coalesce_rx_power(spark, sf):
    rows = X.drop_unavailable_optics(X.interface_elements(
        V.optics_docs(spark, sf), S.OPTICS_RX_POWER_REPLY, unnamed=C.UNNAMED_INTERFACE))
    first, second = (F.get(F.col("diag")[tags["rx_power"]], F.lit(0)) for tags in (C.MEASURED_TAGS, C.FALLBACK_TAGS))
    return rows.select("device", "run_timestamp", "if_name", X.coalesce_rx_power(first, second).alias("rx_power"))


@query("inject_metadata", f"""
    select l.device, run_timestamp, if_name, lane, 'HW' as blueprint_label, q * 3 as rx_power_mw,
           case when d.device is null then lane_rx end as rx_power, d.grp as stage_name
    from ({V.OPTICS_EXPECTED}) l left join t_devices d on l.device = d.device""")
def inject_metadata(spark, sf):
    meta = V.view(spark, sf, "t_devices").select(
        "device", F.col("grp").alias("stage_name"), F.lit(None).cast("double").alias("rx_power"))
    lanes = X.inject_metadata(X.extract_optics_lanes(V.optics_docs(spark, sf), {"blueprint_label": "HW"}), meta)
    return lanes.select("device", "run_timestamp", "if_name", "lane", "blueprint_label", "rx_power_mw", "rx_power",
                        "stage_name")


@query("extract_interface_stats", f"select {_STATS_COLUMNS} from ({V.STATS_EXPECTED})")
def extract_interface_stats(spark, sf):
    return X.extract_interface_stats(V.stats_docs(spark, sf), fec_only=False)


@query("keep_fec_interfaces", _FEC_STATS)
def keep_fec_interfaces(spark, sf):
    return X.extract_interface_stats(V.stats_docs(spark, sf))


_BINS = f"""
    with e as (select * from ({V.STATS_EXPECTED}) where event_id % 12 <> 2),
    bins as (
        select device, run_timestamp, if_name, event_id, 0 as bin, cast(counter % 7 as double) as live,
               cast(counter % 5 as double) as harvest from e
        union all
        select device, run_timestamp, if_name, event_id, 1,
               case when event_id % 3 = 0 then cast(counter % 13 as double) else 0 end,
               case when event_id % 3 = 0 then 0 else cast(counter % 11 as double) end from e
        union all select device, run_timestamp, if_name, event_id, 3, cast(counter % 17 as double), 0 from e
        union all select device, run_timestamp, if_name, event_id, 17, 1, 2 from e)
    """


@query("extract_fec_histogram", _BINS + """
    select device, run_timestamp, if_name, bin, live, harvest, live + harvest as total from bins""")
def extract_fec_histogram(spark, sf):
    return X.extract_fec_histogram(V.stats_docs(spark, sf))


@query("pivot_fec_histogram", _BINS + "select device, run_timestamp, if_name, " + ", ".join(
    f"max(live + harvest) filter (bin = {i}) as histogram_bin_{i}, max(live) filter (bin = {i}) as histogram_bin_{i}"
    f"_live, max(harvest) filter (bin = {i}) as histogram_bin_{i}_harvest" for i in range(C.HISTOGRAM_BINS)
) + " from bins group by device, run_timestamp, if_name")
def pivot_fec_histogram(spark, sf):
    return X.pivot_fec_histogram(X.extract_fec_histogram(V.stats_docs(spark, sf)))


_SYSTEM = """
    select device, cast(0 as bigint) as run_timestamp,
           case when ok then case when s_suppkey % 7 = 2 then device else origin_hostname end end as origin_hostname,
           case when ok then hardware_model end as hardware_model, case when ok then 'os' end as os_name,
           case when ok then 'v' || cast(s_suppkey % 4 as varchar) end as os_version,
           case when ok then 'JUNIPER_' || upper(hardware_model) end as device_profile
    from (select *, s_suppkey % 7 not in (0, 4) as ok from t_devices)"""


@query("extract_system_info", _SYSTEM)
def extract_system_info(spark, sf):
    return X.extract_system_info(V.system_docs(spark, sf))


_PREFIX = """case when hardware_model like 'qfx5110%' or hardware_model like 'ex%' then 'xe' else 'et' end"""
_SLOTS = """
    (select * from t_devices where s_suppkey % 13 not in (0, 11)) d,
    (select unnest(range(2)) as f) fs, (select unnest(range(2)) as p) ps"""


@query("extract_chassis_inventory", f"""
    select device, cast(0 as bigint) as run_timestamp, case when s_suppkey % 5 <> 0 then origin_name end as origin_name,
           {_PREFIX} || '-' || f || '/' || p || '/' || x as if_name,
           case when (f + p + x + s_suppkey) % 4 > 1 then 'XS' || f || p || x end as serial_number
    from {_SLOTS}, (select unnest(range(4)) as x) xs where f <= s_suppkey % 2 and x <= s_suppkey % 4""")
def extract_chassis_inventory(spark, sf):
    serials, transceivers = X.extract_chassis_inventory(V.chassis_docs(spark, sf), F.col("hardware_model"))
    return serials.join(transceivers, ["device", "run_timestamp"])


@query("discover_slots", f"""
    select device, cast(0 as bigint) as run_timestamp, cast(f as int) as fpc, cast(p as int) as pic
    from {_SLOTS} where f <= s_suppkey % 2""")
def discover_slots(spark, sf):
    return X.discover_slots(V.chassis_docs(spark, sf))


_PORTS = """
    select 'dev-' || cast(p_partkey % 97 as varchar) as device, cast(0 as bigint) as run_timestamp, 0 as fpc,
           cast(p_partkey % 4 as int) as pic, if_name, vendor,
           case when p_partkey % 3 <> 0 then 'PN' || cast(p_partkey as varchar) end as part_number,
           case when p_partkey % 5 <> 0 then serial_number end as serial_number,
           nullif(media_type, 'N/A') as cable_type, nullif(media_type, 'N/A') as media_type,
           cast(wavelength_nm as varchar) || 'nm' as wavelength,
           case p_partkey % 4 when 0 then 'FIBER_TYPE_MULTI_MODE' when 1 then 'FIBER_TYPE_SINGLE_MODE' end as fiber_type,
           case when p_partkey % 2 <> 0 then '1.' || cast(p_partkey as varchar) end as firmware_version,
           cast(null as varchar) as juniper_version
    from t_xcvr where p_partkey % 13 not in (0, 11)"""


@query("extract_pic_ports", _PORTS)
def extract_pic_ports(spark, sf):
    return X.extract_pic_ports(V.pic_docs(spark, sf))


_PORT_VALUES = [*C.TRANSCEIVER_COLUMNS, "juniper_version"]


@query("merge_pic_slots", f"""
    select device, run_timestamp, 'port-' || cast(pic % 2 as varchar) as if_name,
           {", ".join(f"arg_max(s.{c}, slot) as {c}" for c in ["vendor", "if_name_of"])},
           max(pic) as pic
    from (select *, if_name as if_name_of, pic * 10000000 + part as slot
          from (select *, cast(split_part(if_name, '/', 3) as int) as part from ({_PORTS}))) s
    group by device, run_timestamp, pic % 2""")
def merge_pic_slots(spark, sf):
    # Slots of one device are made to offer the same interface, so that the later one must win.
    ports = X.extract_pic_ports(V.pic_docs(spark, sf))
    shared = ports.select(
        "device", "run_timestamp", F.concat(F.lit("port-"), (F.col("pic") % 2).cast("string")).alias("if_name"),
        "vendor", F.col("if_name").alias("if_name_of"), F.col("pic").alias("fpc"),
        F.split_part("if_name", F.lit("/"), F.lit(3)).cast("int").alias("pic"),
    )
    merged = X.merge_pic_slots(shared)
    return merged.select("device", "run_timestamp", "if_name", "vendor", "if_name_of", F.col("fpc").alias("pic"))


# --- Fixed values: `path:field` lines as the mapping files write them ---------
_HEAD = "rpc-reply/interface-information/physical-interface"
_THRESHOLD_LINES = [f for f in C.THRESHOLD_TAGS if f != "tx_bias_low_warn"]
INTERFACE_MAPPING = (
    [f"{_HEAD}/name:if_name"]
    + [f"{_HEAD}/optics-diagnostics/{C.THRESHOLD_TAGS[f]}:{f}" for f in _THRESHOLD_LINES]
    + [f"{_HEAD}/optics-diagnostics/module-temperature:temperature"]
    + [f"{_HEAD}/optics-diagnostics/{tag}:{f}" for f, tag in C.MEASURED_TAGS.items()]
)
_LANE_HEAD = "physical-interface/optics-diagnostics/optics-diagnostics-lane-values"
LANE_MAPPING = ["physical-interface/name:if_name", f"{_LANE_HEAD}/lane-index:lane"] + [
    f"{_LANE_HEAD}/{tag}:{f}" for f, tag in C.LANE_TAGS.items()
]


@query("extract_by_mapping", f"""
    with i as (
        select device, run_timestamp, if_name, {", ".join(f"q + {i} as {f}" for i, f in enumerate(C.THRESHOLD_TAGS))},
               q + 0.5 as temperature, q / 8 as voltage, q as tx_bias, q * 2 as tx_power_mw, tx_power,
               case when order_key % 16 not in (5, 10) then q * 3 end as rx_power_mw,
               case when order_key % 16 not in (5, 10) then rx_power end as rx_power
        from ({V.OPTICS_EXPECTED})), l as ({_LANES})
    select device, run_timestamp, if_name, cast(null as int) as lane, {", ".join(_THRESHOLD_LINES)}, temperature,
           voltage, tx_bias, tx_power_mw, tx_power, rx_power_mw, rx_power from i
    union all
    select device, run_timestamp, if_name, lane, {", ".join("null" for _ in _THRESHOLD_LINES)}, null, null, tx_bias,
           tx_power_mw, tx_power, rx_power_mw, rx_power from l""")
def extract_by_mapping(spark, sf):
    docs = V.optics_docs(spark, sf)
    interfaces = X.extract_by_mapping(docs, INTERFACE_MAPPING, "physical-interface")
    lanes = X.extract_by_mapping(docs, LANE_MAPPING, _LANE_HEAD)
    return interfaces.unionByName(lanes, allowMissingColumns=True)


@query("quarantine_malformed", """
    select device, 'optics_diagnostics' as rpc, case when order_key % 16 = 0 then 'malformed'
             when order_key % 16 = 11 then 'empty' else 'parsed' end as outcome, count(*) as docs
    from t_lanes group by all""")
def quarantine_malformed(spark, sf):
    good, rejects = X.quarantine_malformed(V.optics_docs(spark, sf), S.OPTICS_LANE_REPLY, keep=["device", "rpc"])
    outcome = good.select("device", "rpc", F.lit("parsed").alias("outcome")).unionByName(
        rejects.select("device", "rpc", F.col("reason").alias("outcome")))
    return outcome.groupBy("device", "rpc", "outcome").agg(F.count("*").alias("docs"))


@query("namespace_agnostic_tags", """
    select device, order_key % 16 = 1 as prefixed, cast(sum(case when order_key % 16 in (0, 11) then 0 else 2 end)
             as bigint) as interfaces, count(*) as replies
    from t_lanes group by all""")
def namespace_agnostic_tags(spark, sf):
    # Replies with and without prefixes, read through the same schema.
    parsed = X.namespace_agnostic_tags(V.optics_docs(spark, sf), S.OPTICS_LANE_REPLY)
    found = X.find_elements(F.col("reply"), S.OPTICS_LANE_REPLY, S.INTERFACE_PATHS)
    return parsed.groupBy("device", F.startswith("xml", F.lit("<p:")).alias("prefixed")).agg(
        F.sum(F.coalesce(F.size(found), F.lit(0))).alias("interfaces"), F.count("*").alias("replies"))
