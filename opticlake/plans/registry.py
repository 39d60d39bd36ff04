"""The calls collected by default, and how to plug in another one."""

from __future__ import annotations

from pyspark.sql import types as T

from opticlake import constants as C
from opticlake import schemas as S
from opticlake.operators import extract as X
from opticlake.sources.replies import RpcRegistry


def default_registry() -> RpcRegistry:
    registry = RpcRegistry()
    transforms = {
        "system_information": (S.SYSTEM_REPLY, X.extract_system_info),
        "chassis_inventory": (S.CHASSIS_REPLY, lambda docs: X.extract_chassis_inventory(docs)[1]),
        "optics_diagnostics": (S.OPTICS_LANE_REPLY, X.extract_optics_lanes),
        "interface_statistics": (S.STATS_REPLY, X.extract_interface_stats),
    }
    for name, (schema, fn) in transforms.items():
        registry.register(name, schema, fn, name in C.FILTERABLE_RPCS, C.RPC_NAMES[name])
    # The other tables of the same replies.
    more = {
        "optics_interfaces": ("optics_diagnostics", S.OPTICS_INTERFACE_REPLY, X.extract_optics_interface),
        "chassis_serials": ("chassis_inventory", S.CHASSIS_REPLY, lambda docs: X.extract_chassis_inventory(docs)[0]),
    }
    for name, (reply, schema, fn) in more.items():
        registry.register(name, schema, fn, reply in C.FILTERABLE_RPCS, C.RPC_NAMES[reply], reply)
    return registry


def register_rpc_transform(registry: RpcRegistry, name: str, schema: T.StructType, fn, filterable: bool = False) -> RpcRegistry:
    """Add a call: its reply schema and a DataFrame function over docs."""
    registry.register(name, schema, fn, filterable)
    return registry
