"""Nested orders to order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse import functions as fn


def flatten_orders(orders: DataFrame) -> DataFrame:
    """One row per order item; orders whose items are NULL or empty give no row.

    A narrow transformation: no shuffle, and only the used item fields are read.
    """
    return orders.select(
        "order_id", "customer_id", "order_date", "payment_status", F.explode("items").alias("item")
    ).select(
        fn.order_line_id(F.col("order_id"), F.col("item.product_id")).alias("order_line_id"),
        "order_id",
        "customer_id",
        "order_date",
        "payment_status",
        "item.product_id",
        "item.sales_quantity",
        "item.price_per_unit",
    )


def dropped_orders(orders: DataFrame) -> DataFrame:
    """Orders that `flatten_orders` gives no row for."""
    return orders.where(F.coalesce(F.size("items"), F.lit(0)) <= 0)


def invalid_order_dates(lines: DataFrame) -> DataFrame:
    """Lines whose order date is present but not a date; RFM ignores their date."""
    return lines.where(F.col("order_date").isNotNull() & fn.order_day(F.col("order_date")).isNull())


def is_unusable_line() -> Column:
    """Whether RFM counts a line in part only: its date is no date, or its amount cannot be counted."""
    date_lost = F.col("order_date").isNotNull() & fn.order_day(F.col("order_date")).isNull()
    return date_lost | fn.is_unusable(F.col("sales_quantity"), F.col("price_per_unit"))


def unusable_lines(lines: DataFrame) -> DataFrame:
    """Lines that RFM counts in part only: their date is no date, or their amount cannot be counted."""
    return lines.where(is_unusable_line())
