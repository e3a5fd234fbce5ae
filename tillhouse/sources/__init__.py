"""Readers: JSON orders, relational snapshots, warehouse tables."""

from tillhouse.sources.json_orders import read_orders_json
from tillhouse.sources.snapshots import land_snapshot, map_snapshot_types, read_jdbc_table
from tillhouse.sources.tables import read_products, read_table

__all__ = [
    "land_snapshot",
    "map_snapshot_types",
    "read_jdbc_table",
    "read_orders_json",
    "read_products",
    "read_table",
]
