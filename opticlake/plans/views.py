"""Interface and lane views over the given tables, in SQL that Spark and DuckDB both run.

`EPOCH_US(x)` is the one spelling that differs. Raw replies are rendered from
the same views in Spark, one bounded reply per source row, so their number and
the work on them grow with the tables and no key is gathered into one reply.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake import constants as C
from opticlake.session import configure, spread

VIEWS = {
    "t_devices": """
        select 'dev-' || cast(s_suppkey as string) as device, n_name as grp, r_name as shard, s_suppkey,
               'SN' || cast(s_suppkey as string) as origin_name, s_name as origin_hostname,
               case s_suppkey % 5 when 0 then 'qfx5240' when 1 then 'qfx5110' when 2 then 'mx960'
                    when 3 then 'ex4300' end as hardware_model,
               case s_suppkey % 3 when 1 then '' when 2 then 'et-0/1/1, et-0/2/2' end as interface_filter
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "t_lanes": """
        select 'dev-' || cast(l_suppkey as string) as device,
               (case when l_returnflag = 'R' then 'xe-' else 'et-' end) || '0/' || cast(l_partkey % 4 as string)
                 || '/' || cast(l_partkey as string)
                 || (case when l_linestatus = 'O' then ':' || cast(l_linenumber as string) else '' end) as if_name,
               cast(l_linenumber as int) as lane, l_quantity as tx_bias, 0 - 100 * l_discount as tx_power,
               0 - 100 * l_tax as rx_power, l_orderkey as order_key, l_partkey as part_key,
               cast(floor(EPOCH_US(l_shipdate) / 1000000) as bigint) as ts
        from lineitem""",
    "t_counters": """
        select event_id, 'dev-' || cast(user_id as string) as device, event_type as if_name, EPOCH_US(ts) as ts_us,
               cast(floor(EPOCH_US(ts) / 1000000) as bigint) as ts, value,
               cast(round(value * 100) as bigint) as counter
        from events""",
    "t_xcvr": """
        select p_partkey, 'et-0/' || cast(p_partkey % 4 as string) || '/' || cast(p_partkey as string) as if_name,
               p_brand as vendor, case when p_size % 7 = 0 then 'N/A' else p_type end as media_type,
               case p_size % 4 when 0 then 850 when 1 then 1310 when 2 then 1550 else 1290 end as wavelength_nm,
               'XS' || cast(p_partkey as string) as serial_number
        from part""",
    # One transceiver per device and base interface; every fifth part has none.
    "t_ports": """
        select 'dev-' || cast(l_suppkey as string) as device, x.if_name, x.vendor,
               case when x.p_partkey % 6 = 0 then null else 'PN' || cast(x.p_partkey as string) end as part_number,
               case when x.p_partkey % 4 = 0 then null else x.serial_number end as serial_number,
               x.media_type as cable_type, x.media_type, cast(x.wavelength_nm as string) || 'nm' as wavelength,
               case when x.wavelength_nm = 850 then 'FIBER_TYPE_MULTI_MODE' else 'FIBER_TYPE_SINGLE_MODE' end
                 as fiber_type,
               'fw' || cast(x.p_partkey % 3 as string) as firmware_version
        from (select distinct l_suppkey, l_partkey from lineitem where l_partkey % 5 <> 0) p
        join t_xcvr x on p.l_partkey = x.p_partkey""",
    # Serials as the chassis lists them; every third part has none.
    "t_chassis": """
        select 'dev-' || cast(l_suppkey as string) as device, x.if_name,
               case when x.p_partkey % 7 = 0 then 'CP' || cast(x.p_partkey as string) end as part_number,
               'CS' || cast(x.p_partkey as string) as serial_number
        from (select distinct l_suppkey, l_partkey from lineitem where l_partkey % 3 <> 0) p
        join t_xcvr x on p.l_partkey = x.p_partkey""",
    # Counters with gaps: the uncorrected counter is missing now and then.
    "t_series": """
        select device, if_name, event_id, ts_us, ts, value, counter as fec_ccw,
               case when event_id % 7 <> 0 then counter % 50 end as fec_nccw
        from t_counters""",
}
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
_NAMES = re.compile(r"\b(" + "|".join([*VIEWS, *TABLES]) + r")\b(?=\s|\)|$)")
_SOURCE = re.compile(r"((?:from|join)\s+)(" + "|".join([*VIEWS, *TABLES]) + r")\b")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A view of the tables as a DataFrame."""
    configure(spark)
    if name in TABLES:
        return table(spark, sf, name)
    text = VIEWS[name]
    sources = {source: view(spark, sf, source) for _, source in _SOURCE.findall(text)}
    text = _SOURCE.sub(r"\1{\2}", text)
    return spark.sql(re.sub(r"EPOCH_US\((\w+)\)", r"unix_micros(cast(\1 as timestamp))", text), **sources)


def oracle(sql: str) -> str:
    """The SQL with the views it names put in front, for DuckDB."""
    needed: list[str] = []

    def need(text: str) -> None:
        for _, source in _SOURCE.findall(text):
            if source in VIEWS and source not in needed:
                need(VIEWS[source])
                needed.append(source)

    need(sql)
    if not needed:
        return sql
    heads = ", ".join(f"{name} as ({VIEWS[name].replace('EPOCH_US', 'epoch_us')})" for name in needed)
    body = sql.lstrip()
    if body.startswith("with "):
        return f"with {heads}, {body[5:]}"
    return f"with {heads} {body}"


# --- raw replies -------------------------------------------------------------


def _tag(name: str, text: str, attributes: str = "") -> str:
    """SQL text expression for one element; `text` is a SQL expression."""
    return f"'<{name}{attributes}>' || {text} || '</{name}>'"


def _finish(reply: str, kind: str) -> str:
    """Break, prefix or empty a slice of the replies; `kind` is a SQL integer."""
    return f"""case {kind}
        when 0 then substring({reply}, 1, length({reply}) - 12)
        when 1 then replace(regexp_replace({reply}, '<(/?)', '<$1p:'), '<p:rpc-reply', '<p:rpc-reply xmlns:p="urn:p"')
        when 11 then '' else {reply} end"""


def optics_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One optics reply per lane row: its interface with one lane, and an interface without optics."""
    thresholds = " || ".join(
        _tag(tag, f"cast(tx_bias + {i} as string) || '{' degrees C / 1 degrees F' if i < 4 else ''}'")
        for i, tag in enumerate(C.THRESHOLD_TAGS.values())
    )
    rx = "case when order_key % 16 in (2, 10) then '- Inf' else cast(rx_power as string) || ' dBm' end"
    lane = " || ".join([
        "'<optics-diagnostics-lane-values>'",
        f"case when order_key % 16 = 6 then '' else {_tag('lane-index', 'cast(lane as string)')} end",
        f"case when order_key % 16 = 9 then '<laser-bias-current/>' else '' end",
        _tag("laser-bias-current", "cast(tx_bias as string) || ' mA'"),
        f"case when order_key % 16 = 7 then {_tag('laser-bias-current', chr(39) + '1' + chr(39))} else '' end",
        _tag("laser-output-power-dbm", "cast(tx_power as string)"),
        _tag("laser-output-power", "cast(tx_bias * 2 as string)"),
        _tag("laser-rx-optical-power", "cast(tx_bias * 3 as string)"),
        _tag("laser-rx-optical-power-dbm", rx),
        "'</optics-diagnostics-lane-values>'",
    ])
    second = "case when order_key % 16 in (5, 10) then 'rx-signal-avg-optical-power' else 'laser-rx-optical-power' end"
    measured = " || ".join([
        _tag("module-temperature", "'99 degrees C'", """ u:celsius="' || cast(tx_bias + 0.5 as string) || '" """.rstrip()),
        _tag("module-voltage", "cast(tx_bias / 8 as string) || ' V'"),
        _tag("laser-bias-current", "cast(tx_bias as string)"),
        _tag("laser-output-power", "cast(tx_bias * 2 as string)"),
        _tag("laser-output-power-dbm", "cast(tx_power as string)"),
        "case when order_key % 16 = 10 then '<laser-rx-optical-power-dbm>- Inf</laser-rx-optical-power-dbm>' "
        "else '' end",
        f"'<' || {second} || '>' || cast(tx_bias * 3 as string) || '</' || {second} || '>'",
        f"'<' || {second} || '-dbm>' || cast(rx_power as string) || '</' || {second} || '-dbm>'",
    ])
    diagnostics = f"""case order_key % 16
        when 3 then '<optics-diagnostics><optic-diagnostics-not-available/></optics-diagnostics>'
        when 4 then ''
        else '<optics-diagnostics>' || {measured} || {thresholds} || {lane} || '</optics-diagnostics>' end"""
    reply = f"""'<rpc-reply xmlns="urn:a" xmlns:u="urn:u"><interface-information u:style="normal"><physical-interface>'
        || case when order_key % 16 = 8 then '' else {_tag('name', 'if_name')} end || {diagnostics}
        || '</physical-interface><physical-interface><name>dark</name><optics-diagnostics>'
        || '<optic-diagnostics-not-available>Not supported</optic-diagnostics-not-available></optics-diagnostics>'
        || '</physical-interface></interface-information></rpc-reply>'"""
    rows = spread(view(spark, sf, "t_lanes"))
    rows = rows.withColumn("reply", F.expr(reply))
    return rows.select(
        "device", F.lit("optics_diagnostics").alias("rpc"), F.col("ts").alias("run_timestamp"),
        F.col("order_key").cast("string").alias("path"), F.expr(_finish("reply", "order_key % 16")).alias("xml"),
    )


# Rows of the lane view whose reply yields optics, with the values to expect.
OPTICS_EXPECTED = """
    select device, ts as run_timestamp, case when order_key % 16 = 8 then 'unknown' else if_name end as if_name,
           case when order_key % 16 = 6 then 0 else lane end as lane, tx_bias as q,
           case when order_key % 16 <> 9 then tx_bias end as lane_bias, tx_power,
           case when order_key % 16 not in (2, 10) then rx_power end as lane_rx,
           case when order_key % 16 <> 10 then rx_power end as rx_power, order_key
    from t_lanes where order_key % 16 not in (0, 3, 4, 11)"""


def stats_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One statistics reply per counter row."""
    k = "event_id % 12"
    bins = [("0", "cast(counter % 7 as string)", "cast(counter % 5 as string)"),
            ("1", "'x'", "cast(counter % 11 as string)"),
            ("3.0", "cast(counter % 17 as string)", "''"),
            ("17", "'1'", "'2'"),
            ("abc", "'5'", "'5'")]
    histogram = " || ".join(
        "'<ethernet-fechistogram-statistics>' || " + _tag("bin-num", f"'{n}'") + " || "
        + _tag("sym-live-err", live) + " || " + _tag("sym-harvest-err", harvest)
        + " || '</ethernet-fechistogram-statistics>'"
        for n, live, harvest in bins
    )
    again = ("case when event_id % 3 = 0 then '<ethernet-fechistogram-statistics><bin-num>1</bin-num><sym-live-err>' "
             "|| cast(counter % 13 as string) || '</sym-live-err></ethernet-fechistogram-statistics>' else '' end")
    body = " || ".join([
        f"case when {k} = 4 then '' else {_tag('name', 'if_name')} end",
        _tag("admin-status", f"case when {k} = 5 then 'Up' else 'up' end"),
        f"case when {k} = 7 then '' else {_tag('oper-status', chr(39) + 'down' + chr(39))} end",
        _tag("speed", "case event_id % 5 when 0 then '400Gbps' when 1 then '1.5Gbps' when 2 then 'Auto' "
                      "when 3 then '100mbps' else '10 kbps' end"),
        "'<traffic-statistics>'",
        _tag("input-bps", "format_number(counter, 0)"),
        _tag("input-pps", f"cast(counter as string) || case when {k} = 6 then ' pps' else '' end"),
        f"case when {k} = 7 then '' else {_tag('output-bps', 'cast(value as string)')} end",
        _tag("output-pps", "cast(counter % 1000 as string)"),
        "'</traffic-statistics>'",
        f"case when {k} = 2 then '' else '<ethernet-fec-statistics>' || "
        + _tag("fec_ccw_count", f"case when {k} = 3 then 'n/a' else cast(counter as string) end") + " || "
        + f"case when {k} = 8 then '' else " + _tag("fec_nccw_count", "cast(counter % 50 as string)") + " end || "
        + _tag("fec_ccw_error_rate", "cast(value as string)") + " || "
        + _tag("pre-fec-ber", "cast(counter as string) || 'e-12'")
        + " || '</ethernet-fec-statistics>' end",
        histogram,
        again,
    ])
    reply = ("'<rpc-reply><interface-information><physical-interface>' || " + body
             + " || '</physical-interface></interface-information></rpc-reply>'")
    rows = spread(view(spark, sf, "t_counters")).withColumn("reply", F.expr(reply))
    return rows.select(
        "device", F.lit("interface_statistics").alias("rpc"), F.col("ts").alias("run_timestamp"),
        F.col("event_id").cast("string").alias("path"), F.expr(_finish("reply", k)).alias("xml"),
    )


# All readable statistics replies with the values to expect.
STATS_EXPECTED = """
    select device, ts as run_timestamp, if_name, case when event_id % 12 = 5 then 'Up' else 'up' end as admin_status,
           case when event_id % 12 <> 7 then 'down' end as oper_status,
           cast(case event_id % 5 when 0 then 400000000000 when 1 then 1500000000 when 3 then 100000000
                when 4 then 10000 end as bigint) as speed_bps,
           cast(counter as double) as input_bps,
           case when event_id % 12 <> 6 then cast(counter as double) end as input_pps,
           case when event_id % 12 <> 7 then value end as output_bps,
           cast(counter % 1000 as double) as output_pps,
           case when event_id % 12 not in (2, 3) then cast(counter as double) end as fec_ccw,
           case when event_id % 12 not in (2, 8) then cast(counter % 50 as double) end as fec_nccw,
           case when event_id % 12 <> 2 then value end as fec_ccw_error_rate,
           cast(null as double) as fec_nccw_error_rate,
           case when event_id % 12 <> 2 then cast(cast(counter as varchar) || 'e-12' as double) end as pre_fec_ber,
           event_id, counter
    from t_counters where event_id % 12 not in (0, 4, 11)"""


def system_docs(spark: SparkSession, sf: str) -> DataFrame:
    body = " || ".join([
        "'<system-information>'",
        f"case when s_suppkey % 7 = 2 then '' else {_tag('host-name', 'origin_hostname')} end",
        f"case when hardware_model is null then '' else {_tag('hardware-model', 'hardware_model')} end",
        "'<os-name>os</os-name>'",
        _tag("os-version", "'v' || cast(s_suppkey % 4 as string)"),
        "'</system-information>'",
    ])
    rows = spread(view(spark, sf, "t_devices")).withColumn("body", F.expr(body))
    rows = rows.withColumn("reply", F.concat(F.lit("<rpc-reply>"), "body", F.lit("</rpc-reply>")))
    xml = f"case s_suppkey % 7 when 3 then body when 4 then '<rpc-reply><other/></rpc-reply>' " \
          f"else {_finish('reply', 's_suppkey % 7')} end"
    return rows.select("device", F.lit("system_information").alias("rpc"), F.lit(0).cast("long").alias("run_timestamp"),
                       F.col("device").alias("path"), F.expr(xml).alias("xml"))


def chassis_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One chassis reply per device: at most 2 FPCs of 2 PICs of 4 transceivers, and modules that are none."""
    xcvrs = """array_join(transform(sequence(0, cast(s_suppkey % 4 as int)), x ->
        '<chassis-sub-sub-module><name>Xcvr ' || x || '</name><serial-number>'
        || case (f + p + x + s_suppkey) % 4 when 0 then 'N/A' when 1 then 'BUILTIN' else 'XS' || f || p || x end
        || '</serial-number></chassis-sub-sub-module>'), '')"""
    pics = f"""array_join(transform(sequence(0, 1), p ->
        '<chassis-sub-module><name>PIC ' || p || '</name>' || {xcvrs} || '</chassis-sub-module>'), '')"""
    fpcs = f"""array_join(transform(sequence(0, cast(s_suppkey % 2 as int)), f ->
        '<chassis-module><name>FPC ' || f || '</name><chassis-sub-module><name>CPU</name></chassis-sub-module>'
        || {pics} || '</chassis-module>'), '')"""
    reply = f"""'<rpc-reply><chassis-inventory><chassis>'
        || case when s_suppkey % 5 = 0 then '<serial-number/>' else {_tag('serial-number', 'origin_name')} end
        || '<chassis-module><name>Routing Engine 0</name></chassis-module>' || {fpcs}
        || '</chassis></chassis-inventory></rpc-reply>'"""
    rows = spread(view(spark, sf, "t_devices")).withColumn("reply", F.expr(reply))
    return rows.select("device", F.lit("chassis_inventory").alias("rpc"), F.lit(0).cast("long").alias("run_timestamp"),
                       F.col("device").alias("path"), "hardware_model",
                       F.expr(_finish("reply", "s_suppkey % 13")).alias("xml"))


def pic_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One port reply per part: its port, a port without number and a port without metadata."""
    port = " || ".join([
        "'<port>'",
        _tag("port-number", "cast(p_partkey as string)"),
        _tag("cable-type", "media_type"),
        _tag("fiber-mode", "case p_partkey % 4 when 0 then 'Multi Mode' when 1 then 'SM' when 2 then 'n/a' "
                           "else 'other' end"),
        _tag("sfp-vendor-name", "vendor"),
        "case when p_partkey % 3 = 0 then '' else " + _tag("sfp-vendor-pno", "'PN' || cast(p_partkey as string)")
        + " end",
        _tag("sfp-vendor-sn", "case when p_partkey % 5 = 0 then 'NONE' else serial_number end"),
        _tag("wavelength", "cast(wavelength_nm as string) || 'nm'"),
        _tag("sfp-vendor-fw-ver", "case when p_partkey % 2 = 0 then '0.0' else '1.' || cast(p_partkey as string) end"),
        "'<sfp-jnpr-ver/>'",
        "'</port>'",
    ])
    reply = f"""'<rpc-reply><fpc-information><fpc><pic-detail><port-information>'
        || case when p_partkey % 6 = 0 then
             '<port><port-number>' || cast(p_partkey as string) || '</port-number><wavelength>old</wavelength></port>'
           else '' end
        || {port} || '<port><sfp-vendor-name>no number</sfp-vendor-name></port>'
        || '<port><port-number>777</port-number><sfp-vendor-name>n/a</sfp-vendor-name></port>'
        || '</port-information></pic-detail></fpc></fpc-information></rpc-reply>'"""
    rows = spread(view(spark, sf, "t_xcvr")).withColumn("reply", F.expr(reply))
    return rows.select(
        F.expr("'dev-' || cast(p_partkey % 97 as string)").alias("device"), F.lit("pic_detail").alias("rpc"),
        F.lit(0).cast("long").alias("run_timestamp"), F.col("p_partkey").cast("string").alias("path"),
        F.lit(0).alias("fpc"), F.expr("cast(p_partkey % 4 as int)").alias("pic"),
        F.expr(_finish("reply", "p_partkey % 13")).alias("xml"),
    )
