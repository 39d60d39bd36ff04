"""Values that must equal those of the formats for results to be right."""

# --- Fixed values: reply tags and the fields they fill -----------------------

THRESHOLD_TAGS = {
    "temperature_high_alarm": "module-temperature-high-alarm-threshold",
    "temperature_low_alarm": "module-temperature-low-alarm-threshold",
    "temperature_high_warn": "module-temperature-high-warn-threshold",
    "temperature_low_warn": "module-temperature-low-warn-threshold",
    "voltage_high_alarm": "module-voltage-high-alarm-threshold",
    "voltage_low_alarm": "module-voltage-low-alarm-threshold",
    "voltage_high_warn": "module-voltage-high-warn-threshold",
    "voltage_low_warn": "module-voltage-low-warn-threshold",
    "tx_power_high_alarm": "laser-tx-power-high-alarm-threshold-dbm",
    "tx_power_low_alarm": "laser-tx-power-low-alarm-threshold-dbm",
    "tx_power_high_warn": "laser-tx-power-high-warn-threshold-dbm",
    "tx_power_low_warn": "laser-tx-power-low-warn-threshold-dbm",
    "rx_power_high_alarm": "laser-rx-power-high-alarm-threshold-dbm",
    "rx_power_low_alarm": "laser-rx-power-low-alarm-threshold-dbm",
    "rx_power_high_warn": "laser-rx-power-high-warn-threshold-dbm",
    "rx_power_low_warn": "laser-rx-power-low-warn-threshold-dbm",
    "tx_bias_high_alarm": "laser-bias-current-high-alarm-threshold",
    "tx_bias_low_alarm": "laser-bias-current-low-alarm-threshold",
    "tx_bias_high_warn": "laser-bias-current-high-warn-threshold",
    "tx_bias_low_warn": "laser-bias-current-low-warn-threshold",
}

MEASURED_TAGS = {
    "voltage": "module-voltage",
    "tx_bias": "laser-bias-current",
    "tx_power_mw": "laser-output-power",
    "tx_power": "laser-output-power-dbm",
    "rx_power_mw": "laser-rx-optical-power",
    "rx_power": "laser-rx-optical-power-dbm",
}

# Second tag read when the first one has no text.
FALLBACK_TAGS = {
    "rx_power_mw": "rx-signal-avg-optical-power",
    "rx_power": "rx-signal-avg-optical-power-dbm",
}

LANE_TAGS = {
    "rx_power_mw": "laser-rx-optical-power",
    "rx_power": "laser-rx-optical-power-dbm",
    "tx_power_mw": "laser-output-power",
    "tx_power": "laser-output-power-dbm",
    "tx_bias": "laser-bias-current",
}

TRAFFIC_TAGS = {
    "input_bps": "input-bps",
    "input_pps": "input-pps",
    "output_bps": "output-bps",
    "output_pps": "output-pps",
}

FEC_TAGS = {
    "fec_ccw": "fec_ccw_count",
    "fec_nccw": "fec_nccw_count",
    "fec_ccw_error_rate": "fec_ccw_error_rate",
    "fec_nccw_error_rate": "fec_nccw_error_rate",
    "pre_fec_ber": "pre-fec-ber",
}

PORT_TAGS = {
    "vendor": "sfp-vendor-name",
    "part_number": "sfp-vendor-pno",
    "serial_number": "sfp-vendor-sn",
    "cable_type": "cable-type",
    "wavelength": "wavelength",
    "firmware_version": "sfp-vendor-fw-ver",
    "juniper_version": "sfp-jnpr-ver",
}

# --- Fixed values: interface naming ------------------------------------------

# First key contained in the platform name wins, in this order.
PLATFORM_PREFIXES = {
    "qfx5240": "et",
    "qfx5230": "et",
    "qfx5220": "et",
    "qfx5210": "et",
    "qfx5200": "et",
    "qfx5130": "et",
    "qfx5120": "et",
    "qfx5110": "xe",
    "qfx5100": "xe",
    "qfx10k": "et",
    "mx": "et",
    "mx960": "et",
    "mx480": "et",
    "mx240": "et",
    "mx204": "et",
    "mx150": "et",
    "ptx": "et",
    "ptx10k": "et",
    "ptx5000": "et",
    "ptx3000": "et",
    "ptx1000": "et",
    "ex": "xe",
    "ex4300": "ge",
    "ex4600": "et",
}
DEFAULT_PREFIX = "et"
UNNAMED_INTERFACE = "unknown"

# --- Fixed values: units, placeholders, fibre words --------------------------

# First suffix that ends the text wins, in this order.
SPEED_UNITS = {"gbps": 1_000_000_000, "mbps": 1_000_000, "kbps": 1_000, "bps": 1}

PLACEHOLDERS = ["n/a", "na", "none", ""]
FIRMWARE_PLACEHOLDERS = ["0.0"]
SERIAL_PLACEHOLDERS = ["N/A", "BUILTIN", ""]
PROFILE_PREFIX = "Juniper_"

MULTI_MODE = "FIBER_TYPE_MULTI_MODE"
SINGLE_MODE = "FIBER_TYPE_SINGLE_MODE"
MULTI_MODE_WAVELENGTH = 850
SINGLE_MODE_WAVELENGTHS = (1270, 1610)
MULTI_MODE_WORDS = ["SR", "SX", "VCSEL", "850NM", "MMF", "MULTIMODE"]
SINGLE_MODE_WORDS = ["LR", "ER", "ZR", "LX", "EX", "ZX", "1310NM", "1550NM", "CWDM", "DWDM", "SMF", "SINGLEMODE"]
MULTI_MODE_DESCRIPTION_WORDS = MULTI_MODE_WORDS + ["SHORT"]
SINGLE_MODE_DESCRIPTION_WORDS = SINGLE_MODE_WORDS + ["LONG", "EXTENDED"]

# --- Fixed values: remote calls and their files ------------------------------

METRIC_TYPES = ["system_information", "chassis_inventory", "optics_diagnostics", "interface_statistics"]
FILTERABLE_RPCS = ["optics_diagnostics", "interface_statistics"]
RPC_NAMES = {
    "system_information": "get-system-information",
    "chassis_inventory": "get-chassis-inventory",
    "optics_diagnostics": "get-interface-optics-diagnostics-information",
    "interface_statistics": "get-interface-information",
}

# --- Fixed values: exposition and lake layouts -------------------------------

HISTOGRAM_BINS = 16

LABEL_COLUMNS = [
    "origin_hostname",
    "device_profile",
    "origin_name",
    "vendor",
    "part_number",
    "serial_number",
    "media_type",
    "cable_type",
    "wavelength",
    "fiber_type",
]
INTERFACE_MEASURES = ["temperature", "voltage", "tx_bias", "tx_power_mw", "tx_power", "rx_power_mw", "rx_power"]
PREFIXED_MEASURES = ["speed_bps", *TRAFFIC_TAGS, *FEC_TAGS]
STATUS_MEASURES = ["admin_status", "oper_status"]
LANE_MEASURES = ["rx_power_mw", "rx_power", "tx_power_mw", "tx_power", "tx_bias"]

IDENTITY_COLUMNS = ["origin_hostname", "origin_name", "inventory_instance", "timestamp", "collection_timestamp"]
INTERFACE_DOM_COLUMNS = IDENTITY_COLUMNS + [
    "device_profile", "vendor", "media_type", "fiber_type", "if_name",
    "temperature", "voltage", "part_number", "serial_number",
]
LANE_DOM_COLUMNS = IDENTITY_COLUMNS + ["if_name", "lane", "tx_bias", "tx_power", "rx_power"]
INTERFACE_COUNTERS_COLUMNS = IDENTITY_COLUMNS + [
    "if_name", "admin_status", "oper_status", "speed_bps",
    "input_bps", "input_pps", "output_bps", "output_pps",
    "fec_ccw", "fec_nccw", "fec_ccw_error_rate", "fec_nccw_error_rate", "pre_fec_ber",
]
DATASETS = ["interface_dom", "lane_dom", "interface_counters"]
CODECS = ["snappy", "gzip", "none"]

TRANSCEIVER_COLUMNS = [
    "vendor", "part_number", "serial_number", "cable_type",
    "media_type", "wavelength", "fiber_type", "firmware_version",
]
