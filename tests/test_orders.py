from pyspark.sql import Row

import tillhouse as th
from tillhouse.schemas import ORDER_LINES, RAW_ORDERS, same_columns


def order(order_id, items, customer_id=1):
    return (order_id, customer_id, "2025-01-01", "paid", items)


def orders_frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_ORDERS)


def test_one_row_per_item_with_declared_columns(spark):
    lines = th.flatten_orders(orders_frame(spark, order(7, [(1, 2, 3.5), (4, 5, 6.0)])))
    assert same_columns(lines.schema, ORDER_LINES)
    assert sorted(lines.collect()) == [
        Row("7_1", 7, 1, "2025-01-01", "paid", 1, 2, 3.5),
        Row("7_4", 7, 1, "2025-01-01", "paid", 4, 5, 6.0),
    ]


def test_a_product_listed_twice_repeats_its_line_id(spark):
    lines = th.flatten_orders(orders_frame(spark, order(7, [(1, 2, 3.5), (1, 9, 3.5)])))
    assert [r.order_line_id for r in lines.collect()] == ["7_1", "7_1"]


def test_line_id_is_null_when_a_part_is(spark):
    lines = th.flatten_orders(orders_frame(spark, order(None, [(1, 2, 3.5)]), order(7, [(None, 2, 1.0)])))
    assert [r.order_line_id for r in lines.collect()] == [None, None]


def test_orders_without_items_vanish_and_are_listed(spark):
    orders = orders_frame(spark, order(1, None), order(2, []), order(3, [(1, 1, 1.0)]))
    assert [r.order_id for r in th.flatten_orders(orders).collect()] == [3]
    assert sorted(r.order_id for r in th.dropped_orders(orders).collect()) == [1, 2]


def test_a_null_item_still_gives_a_row(spark):
    lines = th.flatten_orders(orders_frame(spark, order(3, [None, (1, 1, 1.0)])))
    assert sorted((r.product_id or 0, r.order_line_id) for r in lines.collect()) == [(0, None), (1, "3_1")]


def test_invalid_dates_are_listed_and_missing_ones_are_not(spark):
    rows = [("a", 1, 1, d, "paid", 1, 1, 1.0) for d in ("2025-01-01", "soon", None, "2025-02-30")]
    bad = th.invalid_order_dates(spark.createDataFrame(rows, ORDER_LINES))
    assert sorted(r.order_date for r in bad.collect()) == ["2025-02-30", "soon"]
