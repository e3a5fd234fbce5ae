"""Time the headline operators against plain single-window and four-join forms.

Inputs are prepared as Parquet before timing. Every run computes all rows and
discards them. Prints one JSON line; `naive` holds the plain forms' times.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import date

import tillhouse as th
from checks import recipes
from checks.queries import RUN_DATES, SNAPSHOT_DATE
from tillhouse import schemas, sinks
from tillhouse.operators.scd2 import ACTION
from tillhouse.sources.tables import rename_products

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARM_UPS = 2
MEMORY = os.environ.get("BENCH_MEMORY", "16g")

NAIVE_RFM = """
WITH per_customer AS (
  SELECT customer_id, max(order_date) AS last_purchase_date, count(DISTINCT order_id) AS frequency,
    sum(sales_quantity * price_per_unit) AS monetary
  FROM lines GROUP BY customer_id),
measured AS (SELECT *, datediff(DATE '2025-10-01', last_purchase_date) AS recency FROM per_customer)
SELECT *, r_score + f_score + m_score AS RFM_Score FROM (
  SELECT *, ntile(5) OVER (ORDER BY recency) AS r_score,
    ntile(5) OVER (ORDER BY frequency DESC) AS f_score,
    ntile(5) OVER (ORDER BY monetary DESC) AS m_score
  FROM measured)
"""

NAIVE_SCD2 = """
WITH open AS (SELECT * FROM dim WHERE dw_end_date = '9999-12-31'),
both_sides AS (
  SELECT n.*, o.product_key, o.product_id AS old_id, o.category AS old_category,
    o.sub_category AS old_sub_category, o.product_price AS old_price,
    o.product_description AS old_description, o.dw_start_date, o.dw_end_date
  FROM snapshot n FULL JOIN open o ON n.product_id = o.product_id)
SELECT coalesce(product_key, monotonically_increasing_id()) AS product_key, product_id, product_price,
  dw_start_date, dw_end_date
FROM (
  SELECT product_key, old_id AS product_id, old_price AS product_price, old_category, old_sub_category,
    old_description, dw_start_date, dw_end_date
  FROM both_sides WHERE product_id IS NOT NULL AND old_id IS NOT NULL AND product_price = old_price
  UNION ALL SELECT NULL, product_id, product_price, category, sub_category, product_description,
    DATE '2025-01-02', DATE '9999-12-31' FROM both_sides WHERE old_id IS NULL
  UNION ALL SELECT product_key, old_id, old_price, old_category, old_sub_category, old_description,
    dw_start_date, DATE '2025-01-02'
  FROM both_sides WHERE product_id IS NOT NULL AND old_id IS NOT NULL AND product_price <> old_price
  UNION ALL SELECT NULL, product_id, product_price, category, sub_category, product_description,
    DATE '2025-01-02', DATE '9999-12-31'
  FROM both_sides WHERE product_id IS NOT NULL AND old_id IS NOT NULL AND product_price <> old_price)
"""


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(runs: dict) -> dict[str, float]:
    """Median per entry; entries take turns, so that all meet an equally warm JVM."""
    times = {name: [] for name in runs}
    for turn in range(RUNS + WARM_UPS):
        for name, run in runs.items():
            start = time.perf_counter()
            run()
            if turn >= WARM_UPS:
                times[name].append(time.perf_counter() - start)
    return {name: round(statistics.median(seconds), 4) for name, seconds in times.items()}


def main() -> None:
    spark = th.build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=MEMORY,
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = th.Staging(spark)
    orders = inputs.save(recipes.raw_orders(spark, SF_DIR), "orders")
    lines = inputs.save(recipes.order_lines(spark, SF_DIR), "lines")
    customers = inputs.save(recipes.customers(spark, SF_DIR), "customers")
    logistics = inputs.save(recipes.logistics(spark, SF_DIR), "logistics")
    snapshots = [
        inputs.save(schemas.conform(rename_products(r(spark, SF_DIR)), schemas.PRODUCTS), "products")
        for r in (recipes.products_first, recipes.products_second)
    ]
    empty = sinks.VersionedTable(spark, inputs.path("none"), schemas.DIM_PRODUCTS).read()
    first = th.scd2_merge(empty, snapshots[0], RUN_DATES[0], staging=inputs).drop(ACTION)
    dim = inputs.save(schemas.conform(first, schemas.DIM_PRODUCTS), "dim")
    lines.createOrReplaceTempView("lines")
    dim.createOrReplaceTempView("dim")
    snapshots[1].createOrReplaceTempView("snapshot")

    def staged(operator):
        def run():
            staging = th.Staging(spark)
            consume(operator(staging))
            staging.clear()

        return run

    ours = {
        "order_lines": lambda: consume(th.flatten_orders(orders)),
        "rfm_scores": staged(lambda s: th.rfm(lines, SNAPSHOT_DATE, staging=s)),
        "dim_customer": staged(lambda s: th.dim_customer(customers, lines, SNAPSHOT_DATE, s)),
        "scd2_merge_safe": staged(lambda s: th.scd2_merge(dim, snapshots[1], RUN_DATES[1], staging=s)),
        "scd2_merge_reference": staged(
            lambda s: th.scd2_merge(dim, snapshots[1], RUN_DATES[1], "reference", staging=s)
        ),
        "fact_logistics": lambda: consume(th.delivery_facts(logistics)),
        "avg_delay_per_warehouse": lambda: consume(th.avg_delay(th.delivery_facts(logistics))),
    }
    naive = {
        "rfm_scores": lambda: consume(spark.sql(NAIVE_RFM)),
        "scd2_merge_reference": lambda: consume(spark.sql(NAIVE_SCD2)),
    }
    every = median_seconds(ours | {f"naive {name}": run for name, run in naive.items()})
    times = {name: every[name] for name in ours}
    plain = {name: every[f"naive {name}"] for name in naive}
    inputs.clear()
    print(
        json.dumps(
            {
                "metric": "headline operators, warm median, total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "naive": plain,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
                "date": date.today().isoformat(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
