from opticlake.functions.names import build_if_name, extract_channel, normalize_if_name, parse_module_slot
from opticlake.functions.text import (
    classify_fiber_type,
    cleanse_placeholders,
    device_profile,
    filled,
    map_fiber_mode,
    parse_int,
    parse_number,
    parse_numeric_commas,
    parse_numeric_units,
    parse_speed_bps,
    status_to_gauge,
)
from opticlake.functions.times import run_time_columns

__all__ = [
    "build_if_name", "classify_fiber_type", "cleanse_placeholders", "device_profile", "extract_channel", "filled",
    "map_fiber_mode", "normalize_if_name", "parse_int", "parse_module_slot", "parse_number", "parse_numeric_commas",
    "parse_numeric_units", "parse_speed_bps", "run_time_columns", "status_to_gauge",
]
