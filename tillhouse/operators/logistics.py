"""Delivery facts and the average delay per warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse import functions as fn


def delivery_facts(logistics: DataFrame) -> DataFrame:
    """One row per delivery with its delay in days and a late flag; no shuffle."""
    delta = fn.delivery_delta_days(
        F.col("actual_delivery_date"), F.col("estimated_delivery_date")
    )
    return logistics.select(
        "order_id",
        delta.alias("delivery_time_delta_days"),
        fn.is_late(delta).alias("is_late_delivery"),
        "shipping_cost",
        "warehouse_id",
    )


def avg_delay(facts: DataFrame) -> DataFrame:
    """Mean delay per warehouse, NULL warehouse included, in warehouse order."""
    return (
        facts.groupBy("warehouse_id")
        .agg(F.avg("delivery_time_delta_days").alias("avg_delivery_delta"))
        .orderBy(F.asc_nulls_first("warehouse_id"))
    )
