import json
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest

import tillhouse as th
from tillhouse import storage
from tillhouse.operators.scd2 import OPEN_END

DAY = date(2025, 10, 1)


def orders_text(n_orders):
    return "\n".join(
        json.dumps(
            {
                "order_id": o,
                "customer_id": o % 3,
                "order_date": "2025-09-01",
                "payment_status": "paid",
                "items": [
                    {"product_id": p, "sales_quantity": 1, "price_per_unit": 2.0} for p in range(o % 4)
                ],
            }
        )
        for o in range(n_orders)
    )


def customers(spark):
    return spark.createDataFrame(
        [(i, 30, "F", "A", date(2020, 1, 1)) for i in range(5)],
        "customer_id int, age int, gender string, city string, registration_date date",
    )


def products(spark, *rows):
    return spark.createDataFrame(
        [(i, "c", "s", p and Decimal(p), "d") for i, p in rows],
        "product_id int, category string, sub_category string, current_price decimal(10,2), description string",
    )


def logistics(spark):
    return spark.sql(
        "SELECT 1 AS order_id, TIMESTAMP_NTZ'2025-01-03 01:00:00' AS actual_delivery_date, "
        "TIMESTAMP_NTZ'2025-01-01 23:00:00' AS estimated_delivery_date, "
        "CAST(1.5 AS DECIMAL(10,2)) AS shipping_cost, 4 AS warehouse_id"
    )


@pytest.fixture
def paths(staging):
    return th.WarehousePaths(staging.path("warehouse"))


@pytest.fixture
def raw(tmp_path):
    file = tmp_path / "raw_orders.json"
    file.write_text(orders_text(8))
    return str(file)


def test_all_flows(spark, paths, raw):
    for run, price in enumerate(("1.00", "2.00"), 1):
        th.run_all(
            spark, paths, raw, customers(spark), products(spark, (1, price), (2, "5.00")), logistics(spark),
            DAY, date(2025, 1, run),
        )
    assert spark.table("staging_orderlines").count() == 12
    dim = {r.customer_id: r.RFM_Score for r in spark.table("Dim_Customer").collect()}
    assert set(dim) == set(range(5)) and dim[3] is None and dim[0] is not None
    assert spark.table("Dim_Customer").first().registration_date == 1577836800000
    assert Counter((r.product_id, r.product_price, r.dw_end_date) for r in spark.table("Dim_Products").collect()) == {
        (1, "1.00", date(2025, 1, 2)): 1,
        (1, "2.00", OPEN_END): 1,
        (2, "5.00", OPEN_END): 1,
    }
    fact = spark.table("Fact_Logistics").first()
    assert tuple(fact) == (1, 2, True, "1.50", 4)


def test_reference_policy_flow(spark, paths, raw):
    th.run_orders(spark, paths, raw)
    for run, price in enumerate(("1.00", None), 1):
        _, dim = th.run_dimensions(
            spark, paths, customers(spark), products(spark, (1, price), (2, "5.00")), DAY, date(2025, 1, run), "reference"
        )
    assert [(r.product_id, r.product_price) for r in dim.collect()] == [(2, "5.00")]


def test_intermediates_are_cleared(spark, paths, raw):
    root = spark.conf.get("spark.checkpoint.dir")
    th.run_orders(spark, paths, raw)
    before = set(storage.child_names(spark, root))
    th.run_dimensions(spark, paths, customers(spark), products(spark, (1, "1.00")), DAY)
    assert set(storage.child_names(spark, root)) == before


def test_a_malformed_order_stops_the_flow(spark, paths, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text(orders_text(2) + "\n{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        th.run_orders(spark, paths, str(bad))
    assert not storage.exists(spark, paths.order_lines)


def test_average_delay(spark, paths):
    facts, average = th.run_logistics(spark, paths, logistics(spark))
    assert facts.count() == 1
    assert [tuple(r) for r in average.collect()] == [(4, 2.0)]


def test_a_failing_run_changes_nothing(spark, paths, raw):
    th.run_orders(spark, paths, raw)
    th.run_dimensions(spark, paths, customers(spark), products(spark, (1, "1.00")), DAY, date(2025, 1, 1))
    folders = (paths.customers, paths.products, paths.dim_customer, f"{paths.dim_products}/version-00000001")
    before = [storage.child_names(spark, folder) for folder in folders]
    with pytest.raises(th.DuplicateKeyError):
        th.run_dimensions(
            spark, paths, customers(spark).limit(1), products(spark, (1, "2.00"), (1, "3.00")), DAY, date(2025, 1, 2)
        )
    assert [storage.child_names(spark, folder) for folder in folders] == before
    assert spark.table("Dim_Products").count() == 1


def test_rejected_rows_and_old_versions(spark, paths, raw):
    th.run_orders(spark, paths, raw)
    for day in (1, 2, 3):
        th.run_dimensions(
            spark, paths, customers(spark), products(spark, (1, f"{day}.00"), (None, "5.00")), DAY, date(2025, 1, day), keep=2
        )
    assert th.read_published(spark, paths, paths.rejected_products).count() == 1
    assert th.read_published(spark, paths, paths.rejected_lines).count() == 0
    assert len([n for n in storage.child_names(spark, paths.dim_products) if n.startswith("version-")]) == 2
    assert spark.table("Dim_Products").count() == 3


def test_undeclared_fields_stay_in_the_staged_copy(spark, paths, tmp_path):
    file = tmp_path / "wide.json"
    item = {"product_id": 1, "sales_quantity": 2, "price_per_unit": 3, "discount": 0.5}
    order = {"order_id": 1, "customer_id": 2, "order_date": "2025-09-01", "payment_status": "paid", "channel": "web"}
    file.write_text(json.dumps([order | {"items": [item]}], indent=1))
    lines = th.run_orders(spark, paths, str(file), multi_line=True, schema=None)
    assert lines.first().price_per_unit == 3.0
    staged = th.read_published(spark, paths, paths.staged_orders)
    assert staged.first().channel == "web" and staged.first()["items"][0].discount == 0.5
