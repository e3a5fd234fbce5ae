"""Retail inputs derived from whole test tables.

The values are chosen so that every case the operators distinguish occurs:
guest orders without a customer (one large NULL group), registered accounts
that never ordered, products that appear, disappear, change price, lose their
price or only spell it differently, undelivered orders, unknown warehouses.
`oracles.py` states the same inputs in SQL.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_header() -> list[Column]:
    return [
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("failed")
        .alias("payment_status"),
    ]


def item_fields() -> list[Column]:
    """Items whose prices have two places, or eight on three lines of four."""
    small = (F.col("l_linenumber") % 4).cast("decimal(9,0)") * F.lit(Decimal("0.00000123"))
    return [
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("sales_quantity"),
        (F.col("l_extendedprice").cast("decimal(12,2)") + small).cast("double").alias("price_per_unit"),
    ]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What flattening every order gives, built by a join instead."""
    orders = table(spark, sf_dir, "orders").select(*order_header())
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", *item_fields())
    joined = items.join(orders, F.col("l_orderkey") == F.col("order_id"))
    line_id = F.concat(F.col("order_id").cast("string"), F.lit("_"), F.col("product_id").cast("string"))
    return joined.select(
        line_id.alias("order_line_id"),
        "order_id",
        "customer_id",
        "order_date",
        "payment_status",
        "product_id",
        "sales_quantity",
        "price_per_unit",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order, with all its items; orders without lines get NULL or empty items."""
    documents = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("order_id"), F.struct(*item_fields()).alias("item"))
        .groupBy("order_id")
        .agg(F.collect_list("item").alias("items"))
    )
    no_items = F.when(F.col("payment_status") != "pending", F.array())
    items = F.coalesce("items", no_items.cast(documents.schema["items"].dataType))
    return table(spark, sf_dir, "orders").select(*order_header()).join(documents, "order_id", "left").withColumn("items", items)


def spoilt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as lines of JSON in `value`: some broken off, some without a date, some priced beyond counting."""
    key = F.col("order_id")
    items = F.transform(
        "items",
        lambda i: F.struct(
            i["product_id"].alias("product_id"),
            i["sales_quantity"].alias("sales_quantity"),
            F.when(key % 50 == 13, F.lit(1e300)).otherwise(i["price_per_unit"]).alias("price_per_unit"),
        ),
    )
    day = F.when(key % 50 == 11, "unknown").otherwise(F.col("order_date"))
    orders = raw_orders(spark, sf_dir).withColumns({"items": items, "order_date": day})
    broken = F.concat(F.lit('{"order_id": '), key.cast("string"), F.lit(', "items": ['))
    return orders.select(F.when(key % 50 == 7, broken).otherwise(F.to_json(F.struct(*orders.columns))).alias("value"))


def spoilt_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first snapshot, with services that have lost their key."""
    key = F.when(F.col("category") != "SERVICE", F.col("product_id"))
    return products_first(spark, sf_dir).withColumn("product_id", key)


def relational_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered accounts as a database keeps them: buyers, and suppliers who never order."""
    nation = table(spark, sf_dir, "nation")
    buyers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n_nationkey")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("id"), F.col("s_nationkey").alias("n_nationkey")
    )
    positive = F.abs("id")
    return (
        buyers.unionByName(suppliers)
        .join(nation, "n_nationkey")
        .select(
            F.col("id").cast("bigint").alias("customer_id"),
            (18 + positive % 60).cast("int").alias("age"),
            F.when(positive % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("n_name").alias("city"),
            F.date_add(F.lit("2020-01-01").cast("date"), (positive % 1000).cast("int")).alias(
                "registration_date"
            ),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts as imported: registration as epoch milliseconds."""
    day = F.unix_date("registration_date").cast("bigint")
    return relational_customers(spark, sf_dir).withColumn("registration_date", day * 86_400_000)


def _parts(spark: SparkSession, sf_dir: str, price: Column, description: Column) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        price.alias("current_price"),
        description.alias("description"),
    )


def _retail_price() -> Column:
    return F.col("p_retailprice").cast("decimal(12,2)")


def relational_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First product snapshot in database types: parts, and services of every supplier."""
    parts = _parts(
        spark, sf_dir, F.when(F.col("p_size") != 13, _retail_price()), F.col("p_name")
    )
    services = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).cast("bigint").alias("product_id"),
        F.lit("SERVICE").alias("category"),
        F.lit("none").alias("sub_category"),
        F.abs("s_acctbal").cast("decimal(12,2)").alias("current_price"),
        F.col("s_name").alias("description"),
    )
    return parts.unionByName(services)


def products_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First snapshot as imported: price as text."""
    return relational_products(spark, sf_dir).withColumn(
        "current_price", F.col("current_price").cast("string")
    )


def products_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second snapshot: services gone, personal offers added, prices and texts revised."""
    size = F.col("p_size")
    price = (
        F.when(size == 17, F.lit(None).cast("string"))
        .when(size == 7, _retail_price().cast("decimal(13,3)").cast("string"))
        .when(F.col("p_brand") == "Brand#13", (_retail_price() + 1).cast("decimal(12,2)").cast("string"))
        .otherwise(_retail_price().cast("string"))
    )
    description = F.when(size == 21, F.concat("p_name", F.lit(" v2"))).otherwise(F.col("p_name"))
    offers = table(spark, sf_dir, "customer").select(
        (-10_000_000_000 - F.col("c_custkey")).cast("bigint").alias("product_id"),
        F.lit("OFFER").alias("category"),
        F.col("c_mktsegment").alias("sub_category"),
        F.abs("c_acctbal").cast("decimal(12,2)").cast("string").alias("current_price"),
        F.col("c_name").alias("description"),
    )
    return _parts(spark, sf_dir, price, description).unionByName(offers)


def relational_logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries in database types; open low-priority orders are not delivered yet."""
    key = F.col("o_orderkey")
    ordered_on = F.col("o_orderdate").cast("date").cast("timestamp_ntz")
    undelivered = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    delay = F.make_dt_interval(
        days=(key * 7919 % 15).cast("int"), hours=(key % 24).cast("int")
    )
    return table(spark, sf_dir, "orders").select(
        key.cast("bigint").alias("order_id"),
        F.when(~undelivered, ordered_on + delay).alias("actual_delivery_date"),
        (ordered_on + F.make_dt_interval(days=F.lit(7))).alias("estimated_delivery_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("shipping_cost"),
        F.nullif(key % 11, F.lit(10)).cast("int").alias("warehouse_id"),
    )


def logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as imported: instants as epoch milliseconds, cost as text."""
    key = F.col("o_orderkey")
    base = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 86_400_000
    undelivered = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    return table(spark, sf_dir, "orders").select(
        key.cast("bigint").alias("order_id"),
        F.when(
            ~undelivered, base + (key * 7919 % 15) * 86_400_000 + (key % 24) * 3_600_000
        ).alias("actual_delivery_date"),
        (base + 7 * 86_400_000).alias("estimated_delivery_date"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("shipping_cost"),
        F.nullif(key % 11, F.lit(10)).cast("int").alias("warehouse_id"),
    )
