"""Explicit schemas: XML reply shapes, parsed JSON documents and tables.

Every XML leaf and container is an array, so a repeated element keeps its
order and the first one can be chosen; a scalar field would keep the last.
"""

from __future__ import annotations

from pyspark.sql import types as T

from opticlake import constants as C

# --- Fixed values: tags and field names of replies, documents and tables ------

CORRUPT = "_corrupt_record"
_TEXT = T.ArrayType(T.StringType())


def leaves(*tags: str) -> list[T.StructField]:
    return [T.StructField(tag, _TEXT) for tag in tags]


def elements(tag: str, fields: list[T.StructField]) -> T.StructField:
    return T.StructField(tag, T.ArrayType(T.StructType(fields)))


def merge_fields(fields: list[T.StructField]) -> list[T.StructField]:
    """One field per tag; containers listed twice get the fields of both."""
    merged: dict[str, T.StructField] = {}
    for field in fields:
        seen = merged.get(field.name)
        if seen is not None and isinstance(field.dataType.elementType, T.StructType):
            both = merge_fields(seen.dataType.elementType.fields + field.dataType.elementType.fields)
            field = elements(field.name, both)
        merged[field.name] = field
    return list(merged.values())


def reply(paths: list[list[str]], fields: list[T.StructField]) -> T.StructType:
    """Schema of a reply that holds the same element under any of several paths."""
    roots = []
    for path in paths:
        node = fields
        for tag in reversed(path):
            node = [elements(tag, node)]
        roots += node
    return T.StructType(merge_fields(roots) + [T.StructField(CORRUPT, T.StringType())])


def under_wrappers(path: list[str]) -> list[list[str]]:
    """The places where a reply body occurs: bare, in its container, or per routing engine."""
    engines = ["multi-routing-engine-results", "multi-routing-engine-item"]
    return [path[start:] for start in range(len(path))] + [engines + path, engines[1:] + path]


# --- optics diagnostics ------------------------------------------------------

INTERFACE_PATHS = under_wrappers(["interface-information", "physical-interface"])

TEMPERATURE = T.StructField(
    "module-temperature",
    T.ArrayType(T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_celsius", T.StringType())])),
)
LANE = elements("optics-diagnostics-lane-values", leaves("lane-index", *C.LANE_TAGS.values()))
DIAGNOSTICS = elements(
    "optics-diagnostics",
    leaves(
        *C.THRESHOLD_TAGS.values(),
        *C.MEASURED_TAGS.values(),
        *C.FALLBACK_TAGS.values(),
        "optic-diagnostics-not-available",
    )
    + [TEMPERATURE, LANE],
)
# Lane reading needs no threshold, threshold reading no lane: give the parser only what is read.
OPTICS_INTERFACE_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name") + [elements("optics-diagnostics", [f for f in DIAGNOSTICS.dataType.elementType if f != LANE])],
)
OPTICS_TEMPERATURE_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name") + [elements("optics-diagnostics", leaves("optic-diagnostics-not-available") + [TEMPERATURE])],
)
OPTICS_RX_POWER_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name") + [elements("optics-diagnostics", leaves(
        "optic-diagnostics-not-available", C.MEASURED_TAGS["rx_power"], C.FALLBACK_TAGS["rx_power"]))],
)
OPTICS_REPLY = reply(INTERFACE_PATHS, leaves("name") + [DIAGNOSTICS])
OPTICS_LANE_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name") + [elements("optics-diagnostics", leaves("optic-diagnostics-not-available") + [LANE])],
)

# --- interface statistics ----------------------------------------------------

STATS_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name", "admin-status", "oper-status", "speed")
    + [
        elements("traffic-statistics", leaves(*C.TRAFFIC_TAGS.values())),
        elements("ethernet-fec-statistics", leaves(*C.FEC_TAGS.values())),
    ],
)
HISTOGRAM_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name")
    + [
        elements("ethernet-fec-statistics", leaves(C.FEC_TAGS["fec_ccw"], C.FEC_TAGS["fec_nccw"])),
        elements("ethernet-fechistogram-statistics", leaves("bin-num", "sym-live-err", "sym-harvest-err")),
    ],
)

STATS_FULL_REPLY = reply(
    INTERFACE_PATHS,
    leaves("name", "admin-status", "oper-status", "speed")
    + [
        elements("traffic-statistics", leaves(*C.TRAFFIC_TAGS.values())),
        elements("ethernet-fec-statistics", leaves(*C.FEC_TAGS.values())),
        elements("ethernet-fechistogram-statistics", leaves("bin-num", "sym-live-err", "sym-harvest-err")),
    ],
)

# --- system, chassis, ports --------------------------------------------------

SYSTEM_TAG = "system-information"
SYSTEM_LEAVES = leaves("host-name", "hardware-model", "os-name", "os-version")
SYSTEM_REPLY = reply([[SYSTEM_TAG], [], ["multi-routing-engine-results", "multi-routing-engine-item", SYSTEM_TAG]],
                     SYSTEM_LEAVES)

CHASSIS_PATHS = under_wrappers(["chassis-inventory", "chassis"])
CHASSIS_REPLY = reply(
    CHASSIS_PATHS,
    leaves("serial-number")
    + [elements(
        "chassis-module",
        leaves("name") + [elements(
            "chassis-sub-module",
            leaves("name") + [elements("chassis-sub-sub-module", leaves("name", "serial-number"))],
        )],
    )],
)

PORT_PATHS = under_wrappers(["fpc-information", "fpc", "pic-detail", "port-information", "port"]) + [
    ["fpc-information", "fpc", "pic-detail", "port"],
]
PORT_REPLY = reply(PORT_PATHS, leaves("port-number", "fiber-mode", *C.PORT_TAGS.values()))

# --- parsed JSON documents ---------------------------------------------------


def _fields(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


_DOUBLE, _STRING, _LONG = T.DoubleType(), T.StringType(), T.LongType()

OPTICS_JSON = T.StructType([
    T.StructField("interfaces", T.ArrayType(T.StructType(
        _fields(["if_name", "device", *C.LABEL_COLUMNS, "inventory_instance", "firmware_version"], _STRING)
        + _fields(["timestamp"], _LONG)
        + _fields([*C.THRESHOLD_TAGS, *C.INTERFACE_MEASURES], _DOUBLE)
    ))),
    T.StructField("lanes", T.ArrayType(T.StructType(
        _fields(["if_name", "device", *C.LABEL_COLUMNS, "inventory_instance", "firmware_version"], _STRING)
        + _fields(["timestamp", "lane"], _LONG)
        + _fields(C.LANE_MEASURES, _DOUBLE)
    ))),
])
STATS_JSON = T.StructType([
    T.StructField("interfaces", T.ArrayType(T.StructType(
        _fields(["if_name", "device", "admin_status", "oper_status", "collection_time"], _STRING)
        + _fields(["timestamp", "speed_bps"], _LONG)
        + _fields([*C.TRAFFIC_TAGS, *C.FEC_TAGS], _DOUBLE)
    ))),
])
SYSTEM_JSON = T.StructType(
    _fields(["device", "origin_hostname", "hardware_model", "os_name", "os_version", "device_profile"], _STRING)
)
CHASSIS_JSON = T.StructType([
    T.StructField("device", _STRING),
    T.StructField("origin_name", _STRING),
    T.StructField("transceivers", T.MapType(_STRING, T.StructType(_fields(["part_number", "serial_number"], _STRING)))),
])
PIC_JSON = T.StructType([
    T.StructField("device", _STRING),
    T.StructField("transceivers", T.MapType(_STRING, T.StructType(
        _fields([*C.TRANSCEIVER_COLUMNS, "juniper_version"], _STRING)))),
])
METRICS_JSON = {
    "system_information": SYSTEM_JSON,
    "chassis_inventory": CHASSIS_JSON,
    "optics_diagnostics": OPTICS_JSON,
    "interface_statistics": STATS_JSON,
}
