"""XML replies to rows.

`docs` has the columns device, rpc, run_timestamp, path, xml. One reply is one
row, so replies are the unit of parallel work and nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake import constants as C
from opticlake import schemas as S
from opticlake.functions import (
    build_if_name,
    cleanse_placeholders,
    device_profile,
    filled,
    map_fiber_mode,
    parse_int,
    parse_module_slot,
    parse_numeric_commas,
    parse_numeric_units,
    parse_speed_bps,
)
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize

XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": S.CORRUPT,
    "ignoreNamespace": "true",
}
DOC_KEYS = ["device", "run_timestamp"]


# --- reading elements --------------------------------------------------------


def parse_reply(xml: str | Column, schema: T.StructType) -> Column:
    """The reply as a struct; tags match whatever their namespace or prefix."""
    return F.from_xml(F.col(xml) if isinstance(xml, str) else xml, schema, XML_OPTIONS)


def first_text(node: Column, tag: str) -> Column:
    """Text of the first child with this tag, NULL where absent or empty."""
    return filled(F.get(node[tag], F.lit(0)))


def _flat(nested: Column) -> Column:
    return F.flatten(F.filter(nested, lambda x: x.isNotNull()))


def find_elements(root: Column, schema: T.StructType, paths: list[list[str]]) -> Column:
    """All elements under the given paths, as one array."""
    found = []
    for path in paths:
        node, kind = root[path[0]], schema[path[0]].dataType
        for tag in path[1:]:
            node, kind = _flat(node[tag]), kind.elementType[tag].dataType
        fields = kind.elementType.fields
        found.append((node, fields))
    # Wrapper paths share one element type; a root that is the element itself is among them.
    shape = T.ArrayType(T.StructType(found[0][1]))
    return F.concat(*[F.coalesce(node, F.array().cast(shape)) for node, _ in found])


def namespace_agnostic_tags(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Replies parsed to a `reply` struct with namespaces and prefixes ignored; those that have one already stay as they are."""
    if "reply" in docs.columns:
        return docs
    # A generator output is neither inlined nor filtered below, so each reply is parsed once.
    return docs.select("*", F.explode(F.array(parse_reply("xml", schema))).alias("reply"))


def found_elements(docs: DataFrame, schema: T.StructType, paths: list[list[str]]) -> tuple[DataFrame, Column]:
    """Parsed replies without their text, and the array of elements found in each."""
    parsed = namespace_agnostic_tags(docs, schema).drop("xml")
    return parsed, find_elements(F.col("reply"), schema, paths)


def quarantine_malformed(docs: DataFrame, schema: T.StructType, keep: bool | list[str] = False) -> tuple[DataFrame, DataFrame]:
    """(replies that parse, rejects with the reason); no reply stops the job.

    With `keep` the parsed replies are written once for both, without it each side parses when it is read. Columns given as
    `keep` are all that the good side has: then neither they nor what is written hold the texts and trees of good replies.
    """
    parsed = namespace_agnostic_tags(docs, schema)
    broken = F.col("reply").isNull() | F.col("reply")[S.CORRUPT].isNotNull()
    why = F.when(F.col("xml").isNull(), "missing").when(F.trim("xml") == "", "empty").otherwise("malformed")
    if isinstance(keep, list):
        own = [c for c in keep if c not in ("device", "rpc")]
        told = parsed.select("device", "rpc", *own, F.when(broken, why).alias("_reason"), F.when(broken, F.col("xml")).alias("_payload"))
        told = materialize(told, "parsed")
        rejects = told.where("_reason IS NOT NULL").select("device", "rpc", F.col("_reason").alias("reason"), F.col("_payload").alias("payload"))
        return told.where("_reason IS NULL").select(*keep), rejects
    parsed = materialize(parsed, "parsed") if keep else parsed
    good = parsed.where(~broken)
    rejects = parsed.where(broken).select("device", "rpc", why.alias("reason"), F.col("xml").alias("payload"))
    return good, rejects


def interface_elements(docs: DataFrame, schema: T.StructType, keep: list[str] | None = None,
                       unnamed: str | None = None) -> DataFrame:
    """One row per physical interface, with its name chosen and filtered before any number is read."""
    parsed, found = found_elements(docs, schema, S.INTERFACE_PATHS)
    rows = parsed.select("*", F.explode(found).alias("pi")).drop("reply")
    name = first_text(F.col("pi"), "name")
    rows = rows.withColumn("if_name", F.coalesce(name, F.lit(unnamed)) if unnamed else name)
    if unnamed is None:
        rows = rows.where(F.col("if_name").isNotNull())
    return rows.where(F.col("if_name").isin(keep)) if keep else rows


def _keys(df: DataFrame) -> list[str]:
    return [k for k in DOC_KEYS if k in df.columns]


# --- optics ------------------------------------------------------------------


def drop_unavailable_optics(parsed: DataFrame) -> DataFrame:
    """Drop interfaces without diagnostics or marked as having none; adds `diag`."""
    diag = F.get(F.col("pi")["optics-diagnostics"], F.lit(0))
    marked = F.size(F.coalesce(diag["optic-diagnostics-not-available"], F.array().cast("array<string>"))) > 0
    return parsed.where(diag.isNotNull() & ~marked).withColumn("diag", diag)


def extract_temperature_attr(node: Column) -> Column:
    """Celsius attribute of the temperature element; its text is never read."""
    return parse_numeric_units(F.get(node, F.lit(0))["_celsius"])


def coalesce_rx_power(primary: Column, fallback: Column) -> Column:
    """The fallback counts only where the first text is missing or empty, not where it is no number."""
    return parse_numeric_units(F.coalesce(filled(primary), filled(fallback)))


def inject_metadata(df: DataFrame, meta: dict | DataFrame | None) -> DataFrame:
    """Constant or per-device metadata; it replaces columns of the same name. Of a device's rows the largest counts."""
    if meta is None:
        return df
    if isinstance(meta, dict):
        return df.withColumns({name: F.lit(value) for name, value in meta.items()})
    extra = [c for c in meta.columns if c != "device"]
    right = meta.groupBy("device").agg(F.max(F.struct(*extra)).alias("_meta"))
    joined = join_per_key(df, right, ["device"])
    own = {
        c: F.when(F.col("_meta").isNotNull(), F.col("_meta")[c]).otherwise(F.col(c)) if c in df.columns
        else F.col("_meta")[c]
        for c in extra
    }
    return joined.withColumns(own).drop("_meta")


def _measured(diag: Column, field: str) -> Column:
    text = F.get(diag[C.MEASURED_TAGS[field]], F.lit(0))
    if field in C.FALLBACK_TAGS:
        return coalesce_rx_power(text, F.get(diag[C.FALLBACK_TAGS[field]], F.lit(0)))
    return parse_numeric_units(text)


def optics_elements(docs: DataFrame, keep: list[str] | None = None, schema: T.StructType = S.OPTICS_REPLY) -> DataFrame:
    """Interfaces with diagnostics as read from the replies: the common part of both optics tables."""
    rows = drop_unavailable_optics(interface_elements(docs, schema, keep, C.UNNAMED_INTERFACE))
    return rows.select(*_keys(rows), "if_name", "diag")


def _interface_numbers(diag: Column) -> list[Column]:
    return [
        *[parse_numeric_units(F.get(diag[tag], F.lit(0))).alias(f) for f, tag in C.THRESHOLD_TAGS.items()],
        extract_temperature_attr(diag["module-temperature"]).alias("temperature"),
        *[_measured(diag, f).alias(f) for f in C.MEASURED_TAGS],
    ]


def optics_interfaces(elements: DataFrame) -> DataFrame:
    """Twenty thresholds and seven measured values per element."""
    return elements.select(*_keys(elements), "if_name", *_interface_numbers(F.col("diag")))


def optics_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(interface rows, lane rows) of replies that are parsed once.

    What is kept for both are the numbers of the interfaces and the texts of the lanes: plain columns are written and read at a
    fraction of the cost of the texts of all tags, an array each.
    """
    elements = optics_elements(docs)
    lanes = F.struct(F.col("diag")[S.LANE.name].alias(S.LANE.name)).alias("diag")
    read = materialize(elements.select(*_keys(elements), "if_name", *_interface_numbers(F.col("diag")), lanes), "optics")
    return read.drop("diag"), optics_lanes(read)


def optics_lanes(elements: DataFrame) -> DataFrame:
    """One row per lane; a lane without an index is lane 0, a non-integer index is NULL."""
    lanes = elements.select(*_keys(elements), "if_name", F.explode("diag.optics-diagnostics-lane-values").alias("l"))
    lane = F.col("l")
    index = first_text(lane, "lane-index")
    return lanes.select(
        *_keys(lanes),
        "if_name",
        F.when(index.isNull(), 0).otherwise(parse_int(index)).alias("lane"),
        *[parse_numeric_units(F.get(lane[tag], F.lit(0))).alias(f) for f, tag in C.LANE_TAGS.items()],
    )


def extract_optics_interface(docs: DataFrame, metadata: dict | DataFrame | None = None,
                             keep: list[str] | None = None) -> DataFrame:
    """Replies to interface rows; lanes are not read."""
    return inject_metadata(optics_interfaces(optics_elements(docs, keep, S.OPTICS_INTERFACE_REPLY)), metadata)


def extract_optics_lanes(docs: DataFrame, metadata: dict | DataFrame | None = None,
                         keep: list[str] | None = None) -> DataFrame:
    """Replies to lane rows; thresholds are not read."""
    return inject_metadata(optics_lanes(optics_elements(docs, keep, S.OPTICS_LANE_REPLY)), metadata)


def read_mapping(spark: SparkSession, path: str) -> list[str]:
    """The `path:field` lines of a mapping file; configuration of a few dozen lines."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return [row["value"] for row in lines.collect()]


def extract_by_mapping(docs: DataFrame, mapping: list[str], row_path: str) -> DataFrame:
    """Rows described by `path:field` lines, one row per `row_path` element.

    The lines are configuration, a few dozen at most: they become the schema.
    """
    wrappers = ("rpc-reply", "interface-information")
    pairs = []
    for line in mapping:
        path, field = line.strip().rsplit(":", 1)
        pairs.append(([tag for tag in path.split("/") if tag not in wrappers][1:], field))
    depth = row_path.split("/")[1:]

    fields = [S.elements("optics-diagnostics", S.leaves("optic-diagnostics-not-available"))]
    for path, _ in pairs:
        leaf = [S.TEMPERATURE] if path[-1] == S.TEMPERATURE.name else S.leaves(path[-1])
        for tag in reversed(path[:-1]):
            leaf = [S.elements(tag, leaf)]
        fields += leaf
    schema = S.reply(S.INTERFACE_PATHS, S.merge_fields(fields))

    parsed, found = found_elements(docs, schema, S.INTERFACE_PATHS)
    rows = parsed.select(*_keys(docs), F.explode(found).alias("pi"))
    rows = drop_unavailable_optics(rows).drop("diag")
    node = F.get(F.col("pi")[depth[0]], F.lit(0)) if depth else F.col("pi")
    for tag in depth[1:]:
        rows = rows.select("*", F.explode(node[tag]).alias(f"at_{tag}"))
        node = F.col(f"at_{tag}")

    def value(path: list[str], field: str) -> Column:
        at, rest = F.col("pi"), path
        if depth and path[: len(depth)] == depth:
            at, rest = node, path[len(depth):]
        for tag in rest[:-1]:
            at = F.get(at[tag], F.lit(0))
        if rest[-1] == S.TEMPERATURE.name:
            return extract_temperature_attr(at[rest[-1]])
        text = F.get(at[rest[-1]], F.lit(0))
        if field == "if_name":
            return F.coalesce(filled(text), F.lit(C.UNNAMED_INTERFACE))
        if field == "lane":
            return F.when(filled(text).isNull(), 0).otherwise(parse_int(text))
        return parse_numeric_units(text)

    return rows.select(*_keys(rows), *[value(path, field).alias(field) for path, field in pairs])


# --- interface statistics ----------------------------------------------------


def keep_fec_interfaces(parsed: DataFrame) -> DataFrame:
    """Keep interfaces with text in either codeword counter, be it a number or not."""
    fec = F.get(F.col("pi")["ethernet-fec-statistics"], F.lit(0))
    texts = [first_text(fec, C.FEC_TAGS[f]) for f in ("fec_ccw", "fec_nccw")]
    return parsed.where(F.coalesce(*texts).isNotNull())


def stats_elements(docs: DataFrame, keep: list[str] | None = None, fec_only: bool = True,
                   schema: T.StructType = S.STATS_FULL_REPLY) -> DataFrame:
    """Named interfaces as read from the replies: the common part of counters and histogram."""
    rows = interface_elements(docs, schema, keep)
    rows = keep_fec_interfaces(rows) if fec_only else rows
    return rows.select(*_keys(rows), "if_name", "pi")


def stats_rows(rows: DataFrame) -> DataFrame:
    """Status, speed, traffic rates and FEC measures per element."""
    pi = F.col("pi")
    traffic = F.get(pi["traffic-statistics"], F.lit(0))
    fec = F.get(pi["ethernet-fec-statistics"], F.lit(0))
    return rows.select(
        *_keys(rows),
        "if_name",
        first_text(pi, "admin-status").alias("admin_status"),
        first_text(pi, "oper-status").alias("oper_status"),
        parse_speed_bps(first_text(pi, "speed")).alias("speed_bps"),
        *[parse_numeric_commas(first_text(traffic, tag)).alias(f) for f, tag in C.TRAFFIC_TAGS.items()],
        *[parse_numeric_commas(first_text(fec, tag)).alias(f) for f, tag in C.FEC_TAGS.items()],
    )


def extract_interface_stats(docs: DataFrame, keep: list[str] | None = None, fec_only: bool = True) -> DataFrame:
    """Replies to counter rows; the histogram is not read."""
    return stats_rows(stats_elements(docs, keep, fec_only, S.STATS_REPLY))


def histogram_rows(rows: DataFrame) -> DataFrame:
    """Long form: one row per element and bin. The last of equal bins wins, within the reply itself."""
    def count(node: Column, tag: str) -> Column:
        return F.coalesce(parse_numeric_commas(first_text(node, tag)), F.lit(0.0))

    def bin_of(node: Column) -> Column:
        return parse_numeric_commas(first_text(node, "bin-num")).try_cast("int")

    bins = F.map_from_entries(
        F.transform(
            F.filter(F.col("pi")["ethernet-fechistogram-statistics"], lambda b: bin_of(b).isNotNull()),
            lambda b: F.struct(
                bin_of(b),
                F.struct(count(b, "sym-live-err").alias("live"), count(b, "sym-harvest-err").alias("harvest")),
            ),
        )
    )
    long = rows.select(*_keys(rows), "if_name", F.explode(bins).alias("bin", "n"))
    return long.select(
        *_keys(long), "if_name", "bin", "n.live", "n.harvest", (F.col("n.live") + F.col("n.harvest")).alias("total")
    )


def extract_fec_histogram(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Replies to histogram rows; counters are not read."""
    return histogram_rows(stats_elements(docs, keep, schema=S.HISTOGRAM_REPLY))


def pivot_fec_histogram(bins: DataFrame, indexes: int = C.HISTOGRAM_BINS) -> DataFrame:
    """Long bins to columns; bins are named up front, so no pass over the data finds them."""
    keys = [*_keys(bins), "if_name"]
    wide = bins.groupBy(*keys).pivot("bin", list(range(indexes))).agg(
        F.max("total").alias("total"), F.max("live").alias("live"), F.max("harvest").alias("harvest")
    )
    columns = []
    for i in range(indexes):
        columns.append(F.col(f"{i}_total").alias(f"histogram_bin_{i}"))
        columns += [F.col(f"{i}_{part}").alias(f"histogram_bin_{i}_{part}") for part in ("live", "harvest")]
    return wide.select(*keys, *columns)


# --- system, chassis, ports --------------------------------------------------


def extract_system_info(docs: DataFrame) -> DataFrame:
    """One row per reply: a malformed or foreign reply leaves the device alone."""
    reply = F.col("reply")
    parsed = namespace_agnostic_tags(docs, S.SYSTEM_REPLY)
    root = F.regexp_extract("xml", r"^(?:\s|<\?[^>]*\?>|<!--.*?-->)*<(?:[\w.-]+:)?([\w.-]+)", 1)
    found = find_elements(reply, S.SYSTEM_REPLY, [[S.SYSTEM_TAG], ["multi-routing-engine-results",
                                                                   "multi-routing-engine-item", S.SYSTEM_TAG]])
    # The generator pins the choice, so the search runs once and not once per column.
    own = F.struct(*[reply[f.name].alias(f.name) for f in S.SYSTEM_LEAVES])
    info = F.coalesce(F.get(found, F.lit(0)), F.when(reply.isNotNull() & (root == S.SYSTEM_TAG), own))
    rows = parsed.select(*_keys(docs), F.explode(F.array(info)).alias("info"))
    node = F.col("info")
    model = first_text(node, "hardware-model")
    hostname = F.when(node.isNotNull(), F.coalesce(first_text(node, "host-name"), F.col("device")))
    return rows.select(
        *_keys(rows),
        hostname.alias("origin_hostname"),
        model.alias("hardware_model"),
        first_text(node, "os-name").alias("os_name"),
        first_text(node, "os-version").alias("os_version"),
        device_profile(model).alias("device_profile"),
    )


def _chassis(docs: DataFrame) -> DataFrame:
    parsed, found = found_elements(docs, S.CHASSIS_REPLY, S.CHASSIS_PATHS)
    return parsed.select("*", F.explode(F.array(found)).alias("chassis")).drop("reply")


def _named(nodes: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(F.coalesce(nodes, F.array()), lambda n: F.coalesce(test(first_text(n, "name")), F.lit(False)))


def _slot(kind: str, word: str) -> Callable[[Column], Column]:
    return lambda name: name.startswith(word) & (parse_module_slot(name)["type"] == kind)


def extract_chassis_inventory(docs: DataFrame, platform: str | Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(device serial per reply, transceivers with their serial); a repeated slot keeps the last."""
    platform = F.lit(None).cast("string") if platform is None else platform
    rows = _chassis(docs)
    serials = F.filter(F.transform("chassis", lambda c: first_text(c, "serial-number")), lambda s: s.isNotNull())
    device_serial = rows.select(*_keys(rows), F.get(serials, F.lit(0)).alias("origin_name"))

    def number(node: Column) -> Column:
        return parse_module_slot(first_text(node, "name"))["number"]

    def serial(node: Column) -> Column:
        text = first_text(node, "serial-number")
        return F.when(~text.isin(*C.SERIAL_PLACEHOLDERS), text)

    fpcs = _named(_flat(F.col("chassis")["chassis-module"]), _slot("fpc", "FPC"))
    slots = F.flatten(F.transform(fpcs, lambda f: F.flatten(F.transform(
        _named(f["chassis-sub-module"], _slot("pic", "PIC")),
        lambda p: F.transform(
            _named(p["chassis-sub-sub-module"], _slot("port", "Xcvr")),
            lambda x: F.struct(
                F.struct(number(f).alias("fpc"), number(p).alias("pic"), number(x).alias("port")), serial(x)
            ),
        ),
    ))))
    ports = rows.select(*[c for c in rows.columns if c != "chassis"],
                        F.explode(F.map_from_entries(slots)).alias("at", "serial_number"))
    transceivers = ports.select(
        *_keys(ports), build_if_name("at.fpc", "at.pic", "at.port", platform).alias("if_name"), "serial_number"
    )
    return device_serial, transceivers


def discover_slots(docs: DataFrame) -> DataFrame:
    """(fpc, pic) pairs to ask for port details."""
    rows = _chassis(docs)

    def number(node: Column, word: str) -> Column:
        return parse_int(F.regexp_extract(first_text(node, "name"), rf"(?i){word}\s+(\d+)", 1))

    fpcs = rows.select(*_keys(rows), F.explode(_flat(F.col("chassis")["chassis-module"])).alias("m"))
    pics = (
        fpcs.where(first_text(F.col("m"), "name").contains("FPC"))
        .select(*_keys(fpcs), number(F.col("m"), "FPC").alias("fpc"), F.explode("m.chassis-sub-module").alias("s"))
        .where(first_text(F.col("s"), "name").contains("PIC"))
    )
    slots = pics.select(*_keys(pics), "fpc", number(F.col("s"), "PIC").alias("pic"))
    return slots.where(F.col("fpc").isNotNull() & F.col("pic").isNotNull())


def extract_pic_ports(docs: DataFrame, platform: str | Column | None = None) -> DataFrame:
    """Transceiver metadata per numbered port; docs also carry fpc and pic."""
    platform = F.lit(None).cast("string") if platform is None else platform

    def cleaned(node: Column, field: str) -> Column:
        extra = C.FIRMWARE_PLACEHOLDERS if field == "firmware_version" else ()
        return cleanse_placeholders(first_text(node, C.PORT_TAGS[field]), extra)

    def fiber(node: Column) -> Column:
        return map_fiber_mode(first_text(node, "fiber-mode"))

    def described(node: Column) -> Column:
        return F.coalesce(*[cleaned(node, f) for f in C.PORT_TAGS], fiber(node)).isNotNull()

    parsed, found = found_elements(docs, S.PORT_REPLY, S.PORT_PATHS)
    kept = F.filter(found, lambda p: first_text(p, "port-number").isNotNull() & described(p))
    by_number = F.map_from_entries(F.transform(kept, lambda p: F.struct(first_text(p, "port-number"), p)))
    rows = parsed.select("*", F.explode(by_number).alias("port", "p")).drop("reply")
    port = F.col("p")
    values = {f: cleaned(port, f) for f in C.PORT_TAGS}
    values["media_type"] = values["cable_type"]
    values["fiber_type"] = fiber(port)
    return rows.select(
        *_keys(rows),
        "fpc",
        "pic",
        build_if_name("fpc", "pic", "port", platform).alias("if_name"),
        *[values[f].alias(f) for f in [*C.TRANSCEIVER_COLUMNS, "juniper_version"]],
    )


def merge_pic_slots(ports: DataFrame) -> DataFrame:
    """One row per interface of a device; the later slot replaces the earlier one."""
    keys = [*_keys(ports), "if_name"]
    values = [c for c in ports.columns if c not in keys]
    last = ports.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("fpc", "pic")).alias("v"))
    return last.select(*keys, "v.*")
