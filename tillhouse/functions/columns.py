"""Column expressions; all stay inside Spark's generated code and ignore the session zone."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, TimestampNTZType, TimestampType

MS_PER_DAY = 86_400_000
PRICE, QUANTITY, MONEY = "decimal(26,10)", "decimal(11,0)", "decimal(38,10)"
ADDEND = "decimal(37,10)"  # two of these add up without losing a place
# Amounts below these bounds, in units of the eighth decimal place, fit in a long.
PRICE_UNIT = 10**8
PLAIN_PRICE, PLAIN_QUANTITY = 10**6, 9 * 10**4
HALF_BITS = 20
# Numbers within these bounds have an exact form.
SURE_PRICE, SURE_QUANTITY = 10**15, 10**10


def order_line_id(order_id: Column, product_id: Column) -> Column:
    """`<order>_<product>`; NULL when either part is NULL."""
    return F.concat(order_id.cast("string"), F.lit("_"), product_id.cast("string"))


def exact_price(unit_price: Column) -> Column:
    """The price as its shortest text shows it, to ten places; NULL if it is no such number."""
    return unit_price.cast("string").try_cast(PRICE)


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price, exact; NULL for lines that `is_unusable`."""
    return (quantity.try_cast(QUANTITY) * exact_price(unit_price)).cast(MONEY)


def is_unusable(quantity: Column, unit_price: Column) -> Column:
    """A quantity or price is given but is not finite, or too large to be counted exactly."""
    # Few rows need the conversions that decide.
    price_lost = F.when(unit_price.between(-SURE_PRICE, SURE_PRICE), False).otherwise(unit_price.isNotNull() & exact_price(unit_price).isNull())
    amount_lost = F.when(quantity.between(-SURE_QUANTITY, SURE_QUANTITY), False).otherwise(
        quantity.isNotNull() & quantity.try_cast(QUANTITY).isNull()
    )
    return price_lost | amount_lost


def sum_amount(quantity: Column, unit_price: Column) -> Column:
    """Exact total of the line amounts, whatever order the rows are added in.

    Most prices have eight places at most. Their amounts are summed as two longs,
    high and low bits, since decimal buffers would double the cost and one long
    could overflow in a very large group. All others are summed as decimals.
    """
    scaled = F.rint(unit_price * PRICE_UNIT)
    plain = (F.abs(unit_price) < PLAIN_PRICE) & (F.abs(quantity) < PLAIN_QUANTITY) & (scaled / PRICE_UNIT == unit_price)
    units = F.when(plain, quantity * F.when(plain, scaled).cast("bigint"))
    high = F.sum(F.shiftright(units, HALF_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << HALF_BITS) - 1))).cast("decimal(20,0)")
    longs = (high * F.lit(1 << HALF_BITS).cast("decimal(7,0)") + low) * F.lit(Decimal(1) / PRICE_UNIT)
    others = F.sum(F.when(~F.coalesce(plain, F.lit(False)), line_amount(quantity, unit_price)))
    nothing = F.lit(0).cast(ADDEND)
    total = F.coalesce(longs.cast(ADDEND), nothing) + F.coalesce(others.cast(ADDEND), nothing)
    return F.when(longs.isNotNull() | others.isNotNull(), total.cast(MONEY))


def order_day(order_date: Column) -> Column:
    """The ISO text as a date; malformed text becomes NULL instead of failing the job."""
    return order_date.try_cast("date")


def recency_days(last_purchase: Column, snapshot_date: date) -> Column:
    return F.date_diff(F.lit(snapshot_date), last_purchase)


def epoch_ms_to_timestamp(millis: Column) -> Column:
    """Exact to the millisecond; dividing by 1000 first would go through a double."""
    return F.timestamp_millis(millis)


def utc_day(millis: Column) -> Column:
    """The UTC calendar date of an instant."""
    return F.date_from_unix_date(((millis - F.pmod(millis, F.lit(MS_PER_DAY))) / MS_PER_DAY).cast("int"))


def delivery_delta_days(actual_ms: Column, estimated_ms: Column) -> Column:
    """Calendar days, in UTC, by which the delivery missed its estimate."""
    return F.date_diff(utc_day(actual_ms), utc_day(estimated_ms))


def is_late(delta_days: Column) -> Column:
    """True for a positive delay; unknown delays count as not late."""
    return F.coalesce(delta_days > 0, F.lit(False))


def price_text(price: Column) -> Column:
    """Decimal text in one spelling (`7.0` and `7.00` agree); other text stays as it is."""
    return F.coalesce(price.try_cast("decimal(38,18)").cast("string"), price)


def to_epoch_ms(column: Column, source: DataType) -> Column:
    """A date or timestamp as milliseconds since 1970-01-01 UTC."""
    if isinstance(source, DateType):
        return F.unix_date(column).cast("bigint") * MS_PER_DAY
    if isinstance(source, TimestampType):
        return F.unix_millis(column)
    if isinstance(source, TimestampNTZType):
        seconds = F.date_part(F.lit("SECOND"), column)
        return (
            F.unix_date(column.cast("date")).cast("bigint") * MS_PER_DAY
            + F.hour(column).cast("bigint") * 3_600_000
            + F.minute(column).cast("bigint") * 60_000
            + F.floor(seconds * 1000).cast("bigint")
        )
    raise TypeError(f"{source.simpleString()} is not a date or timestamp")


def snapshot_column(column: Column, source: DataType) -> Column:
    """One imported column in warehouse form: instants as epoch ms, decimals as text."""
    if isinstance(source, (DateType, TimestampType, TimestampNTZType)):
        return to_epoch_ms(column, source)
    if isinstance(source, DecimalType):
        return column.cast("string")
    return column
