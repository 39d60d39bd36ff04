"""Queries over the column functions. Their texts are built from the tables' own columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from opticlake import functions as fn
from opticlake.operators import exposition as E
from opticlake.plans.catalog import query
from opticlake.plans.views import view

# Variants of one number by row, as SQL that both engines run.
_MESSY = """
    select l_orderkey, l_linenumber, l_partkey, l_quantity, case l_orderkey % 9
        when 0 then cast(l_quantity as string) || ' mA' when 1 then '- Inf' when 2 then 'Off' when 3 then ''
        when 4 then cast(l_partkey as string) || 'f' when 5 then '1_' || cast(l_partkey as string)
        when 6 then '  ' || cast(l_extendedprice as string) when 7 then cast(l_partkey as string) || 'e-3 x'
        else cast(l_quantity as string) || '%' end as text
    from lineitem"""


def _messy(spark, sf):
    return spark.sql(_MESSY.replace("from lineitem", "from {lineitem}"), lineitem=view(spark, sf, "lineitem"))


@query("parse_numeric_units", f"""
    select l_orderkey, l_linenumber, text, case l_orderkey % 9 when 0 then l_quantity
        when 5 then cast('1' || cast(l_partkey as varchar) as double) when 6 then cast(trim(text) as double)
        when 7 then cast(cast(l_partkey as varchar) || 'e-3' as double) end as number,
        case l_orderkey % 9 when 0 then l_quantity
        when 5 then cast('1' || cast(l_partkey as varchar) as double) when 6 then cast(trim(text) as double)
        when 7 then cast(cast(l_partkey as varchar) || 'e-3' as double) else -1 end as number_or_default
    from ({_MESSY})""")
def parse_numeric_units(spark, sf):
    return _messy(spark, sf).select(
        "l_orderkey", "l_linenumber", "text", fn.parse_numeric_units("text").alias("number"),
        fn.parse_numeric_units("text", -1.0).alias("number_or_default"))


_COMMAS = """
    select l_orderkey, l_linenumber, l_partkey, case l_orderkey % 6
        when 0 then '1,' || lpad(cast(l_partkey % 1000 as string), 3, '0') when 1 then cast(l_partkey as string) || ' pps'
        when 2 then ' ' || cast(l_quantity as string) || ' ' when 3 then cast(l_partkey as string) || 'd'
        when 4 then ',' else cast(l_partkey as string) || 'e2' end as text, l_quantity
    from lineitem"""


@query("parse_numeric_commas", f"""
    select l_orderkey, l_linenumber, text, case l_orderkey % 6 when 0 then cast(1000 + l_partkey % 1000 as double)
        when 2 then l_quantity when 5 then cast(l_partkey as double) * 100 end as number
    from ({_COMMAS})""")
def parse_numeric_commas(spark, sf):
    rows = spark.sql(_COMMAS.replace("from lineitem", "from {lineitem}"), lineitem=view(spark, sf, "lineitem"))
    return rows.select("l_orderkey", "l_linenumber", "text", fn.parse_numeric_commas("text").alias("number"))


_SPEED = """
    select p_partkey, case p_partkey % 7 when 0 then cast(p_size as string) || 'Gbps'
        when 1 then cast(p_size as string) || '.5Gbps' when 2 then 'Auto'
        when 3 then ' ' || cast(p_size as string) || ' MBPS' when 4 then cast(p_size as string) || 'kbps'
        when 5 then cast(p_size as string) || 'bps' else 'xbps' end as text, p_size
    from part"""


@query("parse_speed_bps", f"""
    select p_partkey, text, cast(case p_partkey % 7 when 0 then p_size * 1000000000::bigint
        when 1 then p_size * 1000000000::bigint + 500000000 when 3 then p_size * 1000000::bigint
        when 4 then p_size * 1000::bigint when 5 then p_size end as bigint) as bps
    from ({_SPEED})""")
def parse_speed_bps(spark, sf):
    rows = spark.sql(_SPEED.replace("from part", "from {part}"), part=view(spark, sf, "part"))
    return rows.select("p_partkey", "text", fn.parse_speed_bps("text").alias("bps"))


@query("normalize_if_name", """
    select order_key, if_name, 'et-' || substr(split_part(if_name, ':', 1), 4) as base from t_lanes""")
def normalize_if_name(spark, sf):
    return view(spark, sf, "t_lanes").select("order_key", "if_name", fn.normalize_if_name("if_name").alias("base"))


_CHANNELS = """case when order_key % 5 = 0 then if_name || ':x' when order_key % 5 = 1
    then replace(if_name, ':', ':c') else if_name end"""


@query("extract_channel", f"""
    select order_key, name, try_cast(nullif(split_part(name, ':', 2), '') as int) as channel
    from (select order_key, {_CHANNELS} as name from t_lanes)""")
def extract_channel(spark, sf):
    rows = view(spark, sf, "t_lanes").select("order_key", F.expr(_CHANNELS).alias("name"))
    return rows.select("order_key", "name", fn.extract_channel("name").alias("channel"))


_MODULES = """case p_partkey % 6 when 0 then 'FPC ' when 1 then 'pic  ' when 2 then 'Xcvr ' when 3 then 'FPC'
    when 4 then 'PIC 1 on FPC ' else 'Fan ' end || cast(p_size as string)"""


@query("parse_module_slot", f"""
    select p_partkey, {_MODULES} as name,
           case p_partkey % 6 when 0 then 'fpc' when 1 then 'pic' when 2 then 'port' when 4 then 'fpc' end as kind,
           case when p_partkey % 6 in (0, 1, 2, 4) then cast(p_size as varchar) end as number
    from part""")
def parse_module_slot(spark, sf):
    rows = view(spark, sf, "part").select("p_partkey", F.expr(_MODULES).alias("name"))
    slot = fn.parse_module_slot("name")
    return rows.select("p_partkey", "name", slot["type"].alias("kind"), slot["number"].alias("number"))


_PLATFORM = """case s_suppkey % 8 when 5 then 'EX4600-48' when 6 then 'ptx10k' when 7 then 'QFX5100-x' else hardware_model end"""


@query("build_if_name", f"""
    select device, platform, case when lower(platform) like '%qfx5110%' or lower(platform) like '%qfx5100%'
        or lower(platform) like '%ex%' then 'xe' else 'et' end || '-0/' || s_suppkey % 4 || '/' || s_suppkey as if_name
    from (select *, {_PLATFORM} as platform from t_devices)""")
def build_if_name(spark, sf):
    rows = view(spark, sf, "t_devices").withColumn("platform", F.expr(_PLATFORM))
    return rows.select("device", "platform", fn.build_if_name(
        F.lit(0), F.col("s_suppkey") % 4, "s_suppkey", "platform").alias("if_name"))


_MODES = """case p_partkey % 7 when 0 then 'Multi Mode' when 1 then 'OM3 mm' when 2 then 'SM' when 3 then 'single-mode'
    when 4 then 'N/A' when 5 then '' else p_type end"""


@query("map_fiber_mode", f"""
    select p_partkey, mode, case when lower(mode) in ('n/a', 'na', 'none', '') then null
        when lower(mode) like '%multi%' or lower(mode) like '%mm%' then 'FIBER_TYPE_MULTI_MODE'
        when lower(mode) like '%single%' or lower(mode) like '%sm%' then 'FIBER_TYPE_SINGLE_MODE' end as fiber_type
    from (select p_partkey, {_MODES} as mode from part)""")
def map_fiber_mode(spark, sf):
    rows = view(spark, sf, "part").select("p_partkey", F.expr(_MODES).alias("mode"))
    return rows.select("p_partkey", "mode", fn.map_fiber_mode("mode").alias("fiber_type"))


_HOLES = """case p_partkey % 7 when 0 then 'N/A' when 1 then 'na' when 2 then 'None' when 3 then '' when 4 then '0.0'
    when 5 then ' n/a' else p_brand end"""


@query("cleanse_placeholders", f"""
    select p_partkey, case when lower(text) not in ('n/a', 'na', 'none', '') then text end as value,
           case when lower(text) not in ('n/a', 'na', 'none', '', '0.0') then text end as firmware
    from (select p_partkey, {_HOLES} as text from part)""")
def cleanse_placeholders(spark, sf):
    rows = view(spark, sf, "part").select("p_partkey", F.expr(_HOLES).alias("text"))
    return rows.select("p_partkey", fn.cleanse_placeholders("text").alias("value"),
                       fn.cleanse_placeholders("text", ["0.0"]).alias("firmware"))


@query("device_profile", """
    select device, case when hardware_model <> '' then 'JUNIPER_' || upper(hardware_model) end as device_profile
    from t_devices""")
def device_profile(spark, sf):
    return view(spark, sf, "t_devices").select("device", fn.device_profile("hardware_model").alias("device_profile"))


_FIBER = """
    select p_partkey, case when p_partkey % 2 = 0 then wavelength_nm - p_partkey % 3 * 300 end as wavelength,
           case p_partkey % 5 when 0 then '100GBASE-SR4' when 1 then '10GBASE-LR' when 2 then media_type
                when 3 then 'c w d m' end as media,
           case p_partkey % 3 when 0 then 'Short reach' when 1 then 'Extended' else vendor end as description
    from t_xcvr"""
_MULTI, _SINGLE = "SR|SX|VCSEL|850NM|MMF|MULTIMODE", "LR|ER|ZR|LX|EX|ZX|1310NM|1550NM|CWDM|DWDM|SMF|SINGLEMODE"


@query("classify_fiber_type", f"""
    select p_partkey, case when wavelength = 850 then 'FIBER_TYPE_MULTI_MODE'
        when wavelength between 1270 and 1610 then 'FIBER_TYPE_SINGLE_MODE'
        when regexp_matches(m, '{_MULTI}') then 'FIBER_TYPE_MULTI_MODE'
        when regexp_matches(m, '{_SINGLE}') then 'FIBER_TYPE_SINGLE_MODE'
        when regexp_matches(d, '{_MULTI}|SHORT') then 'FIBER_TYPE_MULTI_MODE'
        when regexp_matches(d, '{_SINGLE}|LONG|EXTENDED') then 'FIBER_TYPE_SINGLE_MODE' end as fiber_type
    from (select *, replace(replace(upper(media), '-', ''), ' ', '') as m,
                 replace(replace(upper(description), '-', ''), ' ', '') as d from ({_FIBER}))""")
def classify_fiber_type(spark, sf):
    rows = spark.sql(_FIBER.replace("from t_xcvr", "from {t_xcvr}"), t_xcvr=view(spark, sf, "t_xcvr"))
    return rows.select("p_partkey", fn.classify_fiber_type("media", "description", "wavelength").alias("fiber_type"))


_STATUS = "case event_id % 4 when 0 then 'up' when 1 then 'Up' when 2 then 'down' end"


@query("status_to_gauge", f"""
    select event_id, case when s = 'up' then 1 when s is not null then 0 end as gauge
    from (select event_id, {_STATUS} as s from events)""")
def status_to_gauge(spark, sf):
    rows = view(spark, sf, "events").select("event_id", F.expr(_STATUS).alias("s"))
    return rows.select("event_id", fn.status_to_gauge("s").alias("gauge"))


@query("run_time_columns", """
    select event_id, ts as timestamp, strftime(make_timestamp(ts * 1000000), '%Y-%m-%dT%H:%M:%SZ')
        as collection_timestamp, strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') as dt,
        strftime(make_timestamp(ts * 1000000), '%H') as hr
    from t_counters""")
def run_time_columns(spark, sf):
    rows = view(spark, sf, "t_counters").select("event_id", F.col("ts").alias("timestamp"))
    return fn.run_time_columns(rows)


@query("exposition_labels", """
    select order_key, 'interface="' || if_name || '",lane="' || lane || '"'
        || coalesce(',vendor="' || vendor || '"', '')
        || coalesce(',part_number="' || part_number || '"', '') || coalesce(',serial_number="' || serial_number || '"', '')
        || coalesce(',media_type="' || nullif(media_type, '') || '"', '') as labels
    from (select l.*, p.vendor, p.part_number, p.serial_number,
                 case when l.part_key % 3 <> 0 then p.media_type else '' end as media_type
          from t_lanes l left join t_ports p
            on l.device = p.device and p.if_name = 'et-' || substr(split_part(l.if_name, ':', 1), 4))""")
def exposition_labels(spark, sf):
    ports = view(spark, sf, "t_ports").select("device", F.col("if_name").alias("base"), "vendor", "part_number",
                                              "serial_number", "media_type")
    lanes = view(spark, sf, "t_lanes").withColumn("base", fn.normalize_if_name("if_name"))
    rows = lanes.join(ports, ["device", "base"], "left").withColumn(
        "media_type", F.when(F.col("part_key") % 3 != 0, F.col("media_type")).otherwise(""))
    return rows.select("order_key", E.label_text(E.exposition_labels(rows, lane=True)).alias("labels"))
