from datetime import date

from pyspark.sql import functions as F

import tillhouse as th
from tillhouse import functions as fn
from tillhouse.schemas import CUSTOMERS, DIM_CUSTOMER, ORDER_LINES, same_columns

DAY = date(2025, 10, 1)


def line(customer_id, order_id, order_date="2025-09-01", quantity=1, price=10.0):
    return (f"{order_id}_1", order_id, customer_id, order_date, "paid", 1, quantity, price)


def lines_frame(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_LINES)


def test_base_measures(spark):
    lines = lines_frame(
        spark,
        line(1, 10, "2025-09-01", 2, 1.25),
        line(1, 10, "2025-09-01", 1, 0.5),
        line(1, 11, "2025-09-30", 3, 1.0),
        line(1, None, "2025-08-01", 1, 1.0),
    )
    row = th.rfm_base(lines, DAY).first()
    assert (row.last_purchase_date, row.frequency, float(row.monetary), row.recency) == (
        date(2025, 9, 30),
        2,
        7.0,
        1,
    )


def test_amounts_are_exact_and_may_be_negative(spark):
    lines = lines_frame(spark, *[line(1, i, price=0.1) for i in range(1000)], line(2, 1, price=-2.5, quantity=3))
    totals = {r.customer_id: str(r.monetary) for r in th.rfm_base(lines, DAY).collect()}
    assert totals == {1: "100.0000000000", 2: "-7.5000000000"}


def test_missing_prices_are_left_out_of_the_total(spark):
    lines = lines_frame(spark, line(1, 1, price=None), line(1, 2, price=2.0), line(2, 3, price=None))
    totals = {r.customer_id: r.monetary for r in th.rfm_base(lines, DAY).collect()}
    assert totals == {1: 2, 2: None}


def test_large_groups_do_not_overflow(spark):
    big = 9.0e13
    lines = lines_frame(spark, *[line(1, i, price=big, quantity=9) for i in range(200)])
    assert int(th.rfm_base(lines, DAY).first().monetary) == 200 * 9 * 90_000_000_000_000


def test_malformed_dates_are_ignored(spark):
    lines = lines_frame(spark, line(1, 10, "2025-09-01"), line(1, 11, "zzz"), line(2, 12, "zzz"))
    got = {r.customer_id: (r.recency, r.frequency) for r in th.rfm_base(lines, DAY).collect()}
    assert got == {1: (30, 2), 2: (None, 1)}


def test_scores_stay_in_range_and_one_is_best(spark, staging):
    rows = [line(c, c * 100 + o, f"2025-0{1 + c % 9}-01", 1, float(c)) for c in range(1, 21) for o in range(c)]
    scored = th.rfm(lines_frame(spark, *rows), DAY, staging=staging).collect()
    by_id = {r.customer_id: r for r in scored}
    assert all(3 <= r.RFM_Score <= 15 for r in scored)
    assert by_id[20].f_score == by_id[20].m_score == 1
    assert by_id[1].f_score == by_id[1].m_score == 5
    assert {by_id[c].r_score for c in (8, 17)} == {1}


def test_a_customer_without_a_date_ranks_most_recent(spark, staging):
    rows = [line(c, c, "zzz" if c == 9 else f"2025-01-0{c}") for c in range(1, 10)]
    scored = {r.customer_id: r.r_score for r in th.rfm(lines_frame(spark, *rows), DAY, staging=staging).collect()}
    assert scored[9] == 1


def test_unregistered_buyers_count_in_the_quintiles(spark, staging):
    lines = lines_frame(spark, *[line(c, c, "2025-09-01", 1, float(c)) for c in range(1, 11)], line(None, 99, price=99.0))
    customers = spark.createDataFrame([(1, 30, "F", "A", 0), (10, 31, "M", "B", 0), (77, 32, "F", "C", 0)], CUSTOMERS)
    dim = th.dim_customer(customers, lines, DAY, staging)
    assert same_columns(dim.schema, DIM_CUSTOMER)
    rows = {r.customer_id: r for r in dim.collect()}
    assert set(rows) == {1, 10, 77}
    assert rows[77].RFM_Score is None
    assert sorted(r.cust_key for r in rows.values()) == [0, 1, 2]
    # 11 ranked customers: three in the first bucket, so customer 10 is behind the guests.
    scores = {r.customer_id: r.m_score for r in th.rfm(lines, DAY, staging=staging).collect()}
    assert [scores[c] for c in (None, 10, 9, 8, 1)] == [1, 1, 1, 2, 5]


def test_no_lines_at_all(spark, staging):
    customers = spark.createDataFrame([(1, 30, "F", "A", 0)], CUSTOMERS)
    dim = th.dim_customer(customers, lines_frame(spark), DAY, staging).collect()
    assert [(r.cust_key, r.RFM_Score) for r in dim] == [(0, None)]


def test_fine_prices_count_in_full_and_unusable_ones_do_not_stop_the_job(spark):
    million = 1_000_000
    lines = lines_frame(
        spark,
        line(1, 1, price=0.00004, quantity=million),
        line(2, 2, price=0.00016, quantity=million),
        line(3, 3, price=1.00005, quantity=million),
        line(4, 4, price=float("nan")), line(4, 5, price=2.0, quantity=1),
        line(5, 6, price=float("inf")),
        line(6, 7, price=1e10, quantity=million),
        line(7, 8, price=1e300),
        line(8, 9, price=0.1234567891, quantity=3), line(8, 10, price=0.5, quantity=1),
    )
    totals = {r.customer_id: r.monetary for r in th.rfm_base(lines, DAY).collect()}
    assert {k: None if v is None else float(v) for k, v in totals.items()} == {
        1: 40.0, 2: 160.0, 3: 1_000_050.0, 4: 2.0, 5: None, 6: 1e16, 7: None, 8: 0.8703703673,
    }
    lost = lines.where(fn.is_unusable(F.col("sales_quantity"), F.col("price_per_unit")))
    assert sorted(r.order_id for r in lost.collect()) == [4, 6, 8]


def test_ids_beyond_32_bits(spark):
    lines = lines_frame(spark, line(6_000_000_000, 1), line(6_000_000_001, 2))
    customers = spark.createDataFrame(
        [(6_000_000_000, 30, "F", "x", 0), (6_000_000_002, 30, "F", "x", 0)],
        "customer_id long, age int, gender string, city string, registration_date long",
    )
    rows = {r.customer_id: r.RFM_Score for r in th.dim_customer(customers, lines, DAY).collect()}
    assert rows[6_000_000_000] is not None and rows[6_000_000_002] is None


def test_eight_places_are_summed_as_longs(spark):
    """Amounts with up to eight places leave the decimal sum, whatever their size within the bounds, without a change."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from tillhouse import functions as fn
    from tillhouse.functions import columns

    prices = [0.00000123, 104949.50000369, 999999.99999999, 1000000.5, 1e9 + 0.25, 0.123456789, -0.00000001, -5.5, 0.0, 7.0, None]
    quantities = [1, 3, 89_999, 90_000, 2**40 // 7, -50, 0, None]
    rows = [(q, p) for q in quantities for p in prices]
    lines = spark.createDataFrame(rows, "q long, p double")
    total, longs = lines.agg(
        fn.sum_amount(F.col("q"), F.col("p")).alias("total"), F.sum(fn.line_amount(F.col("q"), F.col("p"))).alias("plain")
    ).first()
    want = sum(q * Decimal(repr(p)) for q, p in rows if q is not None and p is not None and abs(q) < 10**11)
    assert total == longs == want
    # Such prices are whole numbers of units, so no decimals are made of them.
    assert all(round(p * columns.PRICE_UNIT) / columns.PRICE_UNIT == p for p in prices[:3])


def test_unusable_numbers_at_the_bounds(spark):
    from pyspark.sql import functions as F

    from tillhouse import functions as fn
    from tillhouse.functions.columns import exact_price

    prices = [0.0, 1e15, -1e15, 9.9e15, 1e16, -1e16, 1e300, float("nan"), float("inf"), -float("inf"), None]
    quantities = [0, 10**10, 10**11 - 1, 10**11, -(10**11), 2**63 - 1, -(2**63), None]
    lines = spark.createDataFrame([(q, p) for q in quantities for p in prices], "q long, p double")
    q, p = F.col("q"), F.col("p")
    plain = (p.isNotNull() & exact_price(p).isNull()) | (q.isNotNull() & q.try_cast("decimal(11,0)").isNull())
    rows = lines.select(fn.is_unusable(q, p).alias("got"), plain.alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert {r.got for r in rows} == {True, False}
