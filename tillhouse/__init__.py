"""Retail warehouse operators written as Spark DataFrame transformations."""

from tillhouse.operators.joins import left_join
from tillhouse.operators.logistics import avg_delay, delivery_facts
from tillhouse.operators.ntile import Measure, global_ntile
from tillhouse.operators.orders import dropped_orders, flatten_orders, invalid_order_dates
from tillhouse.operators.ranking import dense_key, dense_key_by, global_row_number
from tillhouse.operators.rfm import dim_customer, rfm, rfm_base
from tillhouse.operators.scd2 import (
    DuplicateKeyError,
    changed_rows,
    classify,
    current_rows,
    find_changes,
    quarantine,
    scd2_merge,
)
from tillhouse.plans.flows import (
    WarehousePaths,
    read_published,
    releases,
    run_all,
    run_dimensions,
    run_logistics,
    run_orders,
    show_release,
)
from tillhouse.session import build_session
from tillhouse.staging import Staging

__all__ = [
    "DuplicateKeyError",
    "Measure",
    "Staging",
    "WarehousePaths",
    "avg_delay",
    "build_session",
    "changed_rows",
    "classify",
    "current_rows",
    "delivery_facts",
    "dense_key",
    "dense_key_by",
    "dim_customer",
    "dropped_orders",
    "find_changes",
    "flatten_orders",
    "global_ntile",
    "global_row_number",
    "invalid_order_dates",
    "left_join",
    "quarantine",
    "read_published",
    "releases",
    "rfm",
    "rfm_base",
    "run_all",
    "run_dimensions",
    "run_logistics",
    "run_orders",
    "scd2_merge",
    "show_release",
]
