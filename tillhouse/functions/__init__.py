"""Column functions shared by the operators."""

from tillhouse.functions.columns import (
    delivery_delta_days,
    epoch_ms_to_timestamp,
    is_late,
    is_unusable,
    line_amount,
    order_day,
    order_line_id,
    price_text,
    recency_days,
    sum_amount,
    to_epoch_ms,
    utc_day,
)

__all__ = [
    "delivery_delta_days",
    "epoch_ms_to_timestamp",
    "is_late",
    "is_unusable",
    "line_amount",
    "order_day",
    "order_line_id",
    "price_text",
    "recency_days",
    "sum_amount",
    "to_epoch_ms",
    "utc_day",
]
