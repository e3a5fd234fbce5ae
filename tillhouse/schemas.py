"""Declared schema of every table, and the cast that makes a frame match it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

BOOLEAN, DATE, DOUBLE, INT, BIGINT, STRING = (
    BooleanType(),
    DateType(),
    DoubleType(),
    IntegerType(),
    LongType(),
    StringType(),
)


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW_ORDERS = _schema(
    order_id=BIGINT,
    customer_id=BIGINT,
    order_date=STRING,
    payment_status=STRING,
    items=ArrayType(_schema(product_id=BIGINT, sales_quantity=BIGINT, price_per_unit=DOUBLE)),
)

ORDER_LINES = _schema(
    order_line_id=STRING,
    order_id=BIGINT,
    customer_id=BIGINT,
    order_date=STRING,
    payment_status=STRING,
    product_id=BIGINT,
    sales_quantity=BIGINT,
    price_per_unit=DOUBLE,
)

CUSTOMERS = _schema(
    customer_id=BIGINT,
    age=INT,
    gender=STRING,
    city=STRING,
    registration_date=BIGINT,
)

PRODUCTS_SOURCE = _schema(
    product_id=BIGINT,
    category=STRING,
    sub_category=STRING,
    current_price=STRING,
    description=STRING,
)

PRODUCTS = _schema(
    product_id=BIGINT,
    category=STRING,
    sub_category=STRING,
    product_price=STRING,
    product_description=STRING,
)

LOGISTICS = _schema(
    order_id=BIGINT,
    actual_delivery_date=BIGINT,
    estimated_delivery_date=BIGINT,
    shipping_cost=STRING,
    warehouse_id=INT,
)

DIM_CUSTOMER = _schema(
    cust_key=BIGINT,
    customer_id=BIGINT,
    age=INT,
    gender=STRING,
    city=STRING,
    registration_date=BIGINT,
    RFM_Score=BIGINT,
)

DIM_PRODUCTS = _schema(
    product_key=BIGINT,
    product_id=BIGINT,
    category=STRING,
    sub_category=STRING,
    product_price=STRING,
    product_description=STRING,
    dw_start_date=DATE,
    dw_end_date=DATE,
)

FACT_LOGISTICS = _schema(
    order_id=BIGINT,
    delivery_time_delta_days=INT,
    is_late_delivery=BOOLEAN,
    shipping_cost=STRING,
    warehouse_id=INT,
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """`df` with exactly the columns, order and types of `schema`, matched by name.

    Names match regardless of case, as they do in the catalog. A missing column
    or a value outside the declared type is an error, never a silent NULL.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def same_columns(actual: StructType, expected: StructType) -> bool:
    """Equal names, order and types; nullability is not compared, Parquet drops it."""
    return [(f.name, f.dataType.simpleString()) for f in actual.fields] == [
        (f.name, f.dataType.simpleString()) for f in expected.fields
    ]
