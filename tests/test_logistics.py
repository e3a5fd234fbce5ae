from datetime import date

import pytest
from pyspark.sql import functions as F

import tillhouse as th
from tillhouse import functions as fn
from tillhouse.schemas import FACT_LOGISTICS, LOGISTICS, same_columns

DAY = 86_400_000


@pytest.fixture(params=["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def zone(request, spark):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_delta_is_in_utc_in_every_session_zone(spark, zone):
    df = spark.createDataFrame(
        [(1759305600000, 1759298400000), (0, -1), (-1, 0), (DAY, DAY - 1), (None, 5), (5, None)],
        "a bigint, e bigint",
    )
    got = [r.d for r in df.select(fn.delivery_delta_days(F.col("a"), F.col("e")).alias("d")).collect()]
    assert got == [0, 1, -1, 1, None, None]


def test_late_flag(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (-1,)], "d int")
    assert [r.late for r in df.select(fn.is_late(F.col("d")).alias("late")).collect()] == [False, False, True, False]


def test_epoch_milliseconds_are_exact(spark, zone):
    values = [-1, 1759363199999, 4102444800001, 253402300799999]
    df = spark.createDataFrame([(v,) for v in values], "ms bigint")
    row = df.select(F.unix_millis(fn.epoch_ms_to_timestamp(F.col("ms"))).alias("ms")).collect()
    assert [r.ms for r in row] == values
    days = [r.day for r in df.select(fn.utc_day(F.col("ms")).alias("day")).collect()]
    assert days == [date(1969, 12, 31), date(2025, 10, 1), date(2100, 1, 1), date(9999, 12, 31)]


def test_facts_and_average(spark):
    rows = [
        (1, 3 * DAY, DAY, "1.50", 7),
        (2, DAY, 2 * DAY, "2.50", 7),
        (3, None, DAY, "3.50", 7),
        (4, 5 * DAY, DAY, None, None),
        (5, None, DAY, "1.00", 8),
    ]
    facts = th.delivery_facts(spark.createDataFrame(rows, LOGISTICS))
    assert same_columns(facts.schema, FACT_LOGISTICS)
    assert {r.order_id: (r.delivery_time_delta_days, r.is_late_delivery) for r in facts.collect()} == {
        1: (2, True),
        2: (-1, False),
        3: (None, False),
        4: (4, True),
        5: (None, False),
    }
    assert [tuple(r) for r in th.avg_delay(facts).collect()] == [(None, 4.0), (7, 0.5), (8, None)]
