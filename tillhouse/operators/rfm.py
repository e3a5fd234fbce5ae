"""Recency, frequency and monetary scores, and the customer dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse import functions as fn
from tillhouse.operators.ntile import Measure, global_ntile
from tillhouse.operators.ranking import dense_key_by
from tillhouse.schemas import DIM_CUSTOMER, conform
from tillhouse.staging import Staging

# In every score 1 is best: most recent, most frequent, highest spending.
MEASURES = (
    Measure("recency", "r_score"),
    Measure("frequency", "f_score", descending=True),
    Measure("monetary", "m_score", descending=True),
)


def rfm_base(lines: DataFrame, snapshot_date: date) -> DataFrame:
    """Last purchase, order count, amount and days since, per customer.

    Both shuffles carry partial aggregates, the first keyed by customer and
    order, so a customer holding a large part of the lines is spread out.
    """
    monetary = fn.sum_amount(F.col("sales_quantity"), F.col("price_per_unit"))
    return (
        lines.groupBy("customer_id")
        .agg(
            F.max(fn.order_day(F.col("order_date"))).alias("last_purchase_date"),
            F.count_distinct("order_id").alias("frequency"),
            monetary.alias("monetary"),
        )
        .withColumn("recency", fn.recency_days(F.col("last_purchase_date"), snapshot_date))
    )


def rfm(
    lines: DataFrame, snapshot_date: date, buckets: int = 5, staging: Staging | None = None
) -> DataFrame:
    """`rfm_base` with the three scores and their sum, 3 (best) to 3 x `buckets`.

    Ranking uses exact decimal amounts; the `monetary` column is a double.
    """
    staging = staging or Staging(lines.sparkSession)
    base = staging.save(rfm_base(lines, snapshot_date), "rfm")
    scored = global_ntile(base, buckets, MEASURES, "customer_id")
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumns({"RFM_Score": total, "monetary": F.col("monetary").cast("double")})


def dim_customer(
    customers: DataFrame, lines: DataFrame, snapshot_date: date, staging: Staging | None = None
) -> DataFrame:
    """Every customer with a dense key and an RFM score, NULL without orders.

    Whole customer rows are dealt once, by id, to meet key and score.
    """
    staging = staging or Staging(customers.sparkSession)
    scores = rfm(lines, snapshot_date, staging=staging).select("customer_id", "RFM_Score")
    return conform(dense_key_by(customers, "customer_id", 0, "cust_key", staging, scores), DIM_CUSTOMER)
