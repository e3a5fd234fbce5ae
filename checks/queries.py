"""One Spark query per operator, over whole test tables.

Queries that write use a fresh staging folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tillhouse as th
from checks import recipes
from tillhouse import functions as fn
from tillhouse import schemas, sinks, sources
from tillhouse.operators.scd2 import ACTION
from tillhouse.sources.tables import rename_products

SNAPSHOT_DATE = date(2025, 10, 1)
RUN_DATES = (date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3))

Query = Callable[[SparkSession, str], DataFrame]


def _stored(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Path of a fresh Parquet copy of `df`."""
    path = th.Staging(spark).path(name)
    sinks.replace_parquet(df, path)
    return path


def _money(column: str) -> Column:
    return F.round(F.col(column).cast("double"), 2).alias(column)


def _positioned(ordered: DataFrame, spark: SparkSession) -> DataFrame:
    """Adds the place that each row has in the order in which it was written."""
    rows = sinks.replace_parquet(ordered.withColumn("__id", F.monotonically_increasing_id()), th.Staging(spark).path("ordered"))
    return th.global_row_number(rows, ["__id"], th.Staging(spark), "position").drop("__id")


# Scans


def _documents(orders: DataFrame) -> DataFrame:
    """Each document as it was read, with its items as one sorted text."""
    text = F.transform(
        "items",
        lambda i: F.concat_ws(":", i["product_id"], i["sales_quantity"], i["price_per_unit"].cast("decimal(20,8)")),
    )
    return orders.select(
        "order_id",
        "customer_id",
        "order_date",
        "payment_status",
        F.when(F.col("items").isNotNull(), F.size("items")).cast("bigint").alias("n_items"),
        F.array_join(F.array_sort(text), ",").alias("item_list"),
    )


def _written_orders(spark, sf_dir) -> str:
    path = th.Staging(spark).path("raw_orders")
    recipes.raw_orders(spark, sf_dir).write.option("ignoreNullFields", "false").json(path)
    return path


def json_orders_scan(spark, sf_dir):
    """Documents as read from line-delimited JSON, NULL and empty arrays apart."""
    return _documents(sources.read_orders_json(spark, _written_orders(spark, sf_dir)))


def json_orders_inferred_scan(spark, sf_dir):
    """The same documents with an inferred schema, whose fields come in order of name."""
    return _documents(sources.read_orders_json(spark, _written_orders(spark, sf_dir), schema=None))


# Orders in one file of several lines, about.
ORDERS_PER_FILE = 10_000


def _array_files(raw: DataFrame, orders_per_file: int = ORDERS_PER_FILE) -> DataFrame:
    """Arrays of about `orders_per_file` documents of one day as `value`, with their `order_date` and `part`."""
    document = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    files = F.ceil(F.count("*") / orders_per_file).alias("files")
    days = raw.groupBy(F.col("order_date").alias("day")).agg(files)
    # One row for each day, however many orders there are.
    dealt = raw.select("order_date", "order_id", document.alias("value")).join(
        F.broadcast(days), F.col("order_date").eqNullSafe(F.col("day"))
    )
    part = F.pmod(F.xxhash64("order_id"), "files").alias("part")
    arrays = dealt.groupBy("order_date", part).agg(F.collect_list("value").alias("all"))
    return arrays.select(F.concat(F.lit("["), F.array_join("all", ",\n"), F.lit("\n]")).alias("value"), "order_date", "part")


def json_orders_multiline_scan(spark, sf_dir):
    """The same documents as arrays spread over lines, a file or more for each day."""
    path = th.Staging(spark).path("arrays")
    _array_files(recipes.raw_orders(spark, sf_dir)).write.partitionBy("order_date", "part").text(path)
    return _documents(sources.read_orders_json(spark, f"{path}/*/*", multi_line=True))


def staged_orders_scan(spark, sf_dir):
    path = _stored(spark, recipes.raw_orders(spark, sf_dir), "orders")
    return _documents(sources.read_table(spark, path, schemas.RAW_ORDERS))


def customers_scan(spark, sf_dir):
    return sources.read_table(spark, _stored(spark, recipes.customers(spark, sf_dir), "customers"))


def order_lines_scan(spark, sf_dir):
    path = _stored(spark, recipes.order_lines(spark, sf_dir), "order_lines")
    return sources.read_table(spark, path, schemas.ORDER_LINES)


def products_scan(spark, sf_dir):
    return sources.read_products(spark, _stored(spark, recipes.products_first(spark, sf_dir), "products"))


def logistics_scan(spark, sf_dir):
    path = _stored(spark, recipes.logistics(spark, sf_dir), "logistics")
    return sources.read_table(spark, path, schemas.LOGISTICS)


def customers_snapshot(spark, sf_dir):
    return sources.land_snapshot(
        recipes.relational_customers(spark, sf_dir), th.Staging(spark).path("customers")
    )


def products_snapshot(spark, sf_dir):
    return sources.land_snapshot(
        recipes.relational_products(spark, sf_dir), th.Staging(spark).path("products")
    )


def logistics_snapshot(spark, sf_dir):
    return sources.land_snapshot(
        recipes.relational_logistics(spark, sf_dir), th.Staging(spark).path("logistics")
    )


def snapshot_type_mapping(spark, sf_dir):
    """Every mapped type over lineitem: date, timestamp, decimal, and types left alone."""
    lines = recipes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_shipdate").cast("date").alias("ship_day"),
        (F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_tax"))).alias("ship_time"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        "l_quantity",
        (F.col("l_discount") > 0.05).alias("discounted"),
        "l_returnflag",
    )
    return sources.map_snapshot_types(lines)


# Sinks


def _released(spark, df: DataFrame, schema=None) -> DataFrame:
    """`df` as read from a release that replaces an empty version of its table."""
    root, schema = th.Staging(spark).root, schema or df.schema
    releases = sinks.Releases(spark, f"{root}/releases")
    for version in (spark.createDataFrame([], schema), df):
        with releases.draft() as draft:
            draft.write(f"{root}/table", version, schema)
            draft.publish()
    return releases.read(f"{root}/table", schema)


def orders_stage_roundtrip(spark, sf_dir):
    return th.flatten_orders(_released(spark, recipes.raw_orders(spark, sf_dir)))


def order_lines_roundtrip(spark, sf_dir):
    return _released(spark, th.flatten_orders(recipes.raw_orders(spark, sf_dir)), schemas.ORDER_LINES)


def _customer_dimension(spark, sf_dir, staging=None):
    customers, lines = recipes.customers(spark, sf_dir), recipes.order_lines(spark, sf_dir)
    return th.dim_customer(customers, lines, SNAPSHOT_DATE, staging)


def _stored_customers(spark, sf_dir) -> str:
    with th.Staging(spark) as scratch:
        return _stored(spark, _customer_dimension(spark, sf_dir, scratch), "Dim_Customer")


def dim_customer_roundtrip(spark, sf_dir):
    with th.Staging(spark) as scratch:
        return _released(spark, _customer_dimension(spark, sf_dir, scratch), schemas.DIM_CUSTOMER)


def fact_logistics_roundtrip(spark, sf_dir):
    return _released(spark, th.delivery_facts(recipes.logistics(spark, sf_dir)), schemas.FACT_LOGISTICS)


def _snapshot(spark, sf_dir, run: int) -> DataFrame:
    """Product snapshots of three runs: first, second, then the first again."""
    recipe = recipes.products_second if run == 2 else recipes.products_first
    return schemas.conform(rename_products(recipe(spark, sf_dir)), schemas.PRODUCTS)


def _product_versions(spark, sf_dir, runs: int, policy: str = "safe") -> sinks.VersionedTable:
    """A published product dimension after the first `runs` snapshots."""
    path = th.Staging(spark).path("Dim_Products")
    table = sinks.VersionedTable(spark, path, schemas.DIM_PRODUCTS)
    for run in range(1, runs + 1):
        snapshot, day = _snapshot(spark, sf_dir, run), RUN_DATES[run - 1]
        with th.Staging(spark) as scratch:
            merged = th.scd2_merge(table.read(), snapshot, day, policy, staging=scratch)
            table.publish(merged.drop(ACTION))
    return table


# Product keys in one bucket; small, so that test tables have several.
KEYS_PER_BUCKET = 500


def scd2_publish_roundtrip(spark, sf_dir):
    """Three runs, each writing the buckets of the dimension that it changes."""
    root = th.Staging(spark).root
    releases, place = sinks.Releases(spark, f"{root}/releases"), f"{root}/Dim_Products"
    for run, day in enumerate(RUN_DATES, 1):
        with th.Staging(spark) as scratch, releases.draft() as draft:
            dim, snapshot = draft.read(place, schemas.DIM_PRODUCTS), _snapshot(spark, sf_dir, run)
            found = th.find_changes(dim, snapshot, day, staging=scratch)
            changed = scratch.save(th.changed_rows(dim, snapshot, found, day).drop(ACTION), "changed")
            draft.write_changes(place, changed, schemas.DIM_PRODUCTS, "product_key", KEYS_PER_BUCKET)
            draft.publish()
    return releases.read(place, schemas.DIM_PRODUCTS)


# Catalog


def ext_staging_orderlines(spark, sf_dir):
    path = _stored(spark, recipes.order_lines(spark, sf_dir), "order_lines")
    sinks.drop_table(spark, "staging_orderlines")
    sinks.create_external_table(spark, "staging_orderlines", schemas.ORDER_LINES, path)
    return spark.table("staging_orderlines")


def ext_dim_customer(spark, sf_dir):
    path = _stored_customers(spark, sf_dir)
    sinks.create_external_table(spark, "Dim_Customer", schemas.DIM_CUSTOMER, path, replace=True)
    return spark.table("Dim_Customer")


def ext_dim_products(spark, sf_dir):
    """Files in another column order and letter case than the table declares."""
    versions = _product_versions(spark, sf_dir, 1).read()
    shuffled = versions.select(*[F.col(c).alias(c.upper()) for c in reversed(versions.columns)])
    path = _stored(spark, shuffled, "Dim_Products")
    sinks.create_external_table(spark, "Dim_Products", schemas.DIM_PRODUCTS, path, replace=True)
    return spark.table("Dim_Products")


def ext_fact_logistics(spark, sf_dir):
    facts = schemas.conform(
        th.delivery_facts(recipes.logistics(spark, sf_dir)), schemas.FACT_LOGISTICS
    )
    path = _stored(spark, facts, "fact_logistics")
    sinks.create_external_table(spark, "Fact_Logistics", schemas.FACT_LOGISTICS, path, replace=True)
    return spark.table("Fact_Logistics")


def ext_drop_recreate(spark, sf_dir):
    """Dropping the table keeps the files, so a new one shows the same rows."""
    path = _stored(spark, recipes.customers(spark, sf_dir), "customers")
    sinks.create_external_table(spark, "customers_again", schemas.CUSTOMERS, path, replace=True)
    sinks.drop_table(spark, "customers_again")
    sinks.create_external_table(spark, "customers_again", schemas.CUSTOMERS, path)
    return spark.table("customers_again")


# Projections


def project_columns(spark, sf_dir):
    return recipes.order_lines(spark, sf_dir).select(
        "order_id", F.col("product_id").alias("item"), "price_per_unit"
    )


def computed_columns(spark, sf_dir):
    lines = recipes.order_lines(spark, sf_dir)
    return lines.withColumns(
        {
            "amount": F.round(F.col("sales_quantity") * F.col("price_per_unit"), 2),
            "order_day": fn.order_day(F.col("order_date")),
        }
    ).select("order_line_id", "amount", "order_day")


def rename_columns(spark, sf_dir):
    return rename_products(recipes.products_second(spark, sf_dir))


def nested_field_access(spark, sf_dir):
    return (
        recipes.raw_orders(spark, sf_dir)
        .select("order_id", F.explode("items").alias("item"))
        .select("order_id", "item.product_id", "item.sales_quantity")
    )


def typed_literals(spark, sf_dir):
    return recipes.products_first(spark, sf_dir).select(
        "product_id",
        F.lit(None).cast("bigint").alias("product_key"),
        F.lit("2025-10-01").cast("date").alias("dw_start_date"),
        F.lit("9999-12-31").cast("date").alias("dw_end_date"),
        F.lit("_").alias("separator"),
    )


# Filters


def scd2_current_rows(spark, sf_dir):
    return th.current_rows(_product_versions(spark, sf_dir, 2).read())


def filter_null_checks(spark, sf_dir):
    return recipes.logistics(spark, sf_dir).where(
        F.col("actual_delivery_date").isNotNull() & F.col("warehouse_id").isNull()
    )


def _snapshot_pairs(spark, sf_dir, how: str) -> DataFrame:
    first = _snapshot(spark, sf_dir, 1).select(
        F.col("product_id").alias("old_id"), F.col("product_price").alias("old_price")
    )
    second = _snapshot(spark, sf_dir, 2).select(
        F.col("product_id").alias("new_id"), F.col("product_price").alias("new_price")
    )
    return second.join(first, F.col("new_id") == F.col("old_id"), how)


def filter_unmatched(spark, sf_dir):
    return _snapshot_pairs(spark, sf_dir, "left").where(F.col("old_id").isNull())


def filter_equal_3vl(spark, sf_dir):
    return _snapshot_pairs(spark, sf_dir, "inner").where("new_price = old_price")


def filter_notequal_3vl(spark, sf_dir):
    return _snapshot_pairs(spark, sf_dir, "inner").where("new_price <> old_price")


# Joins


def join_left_outer(spark, sf_dir):
    base = th.rfm_base(recipes.order_lines(spark, sf_dir), SNAPSHOT_DATE)
    joined = th.left_join(recipes.customers(spark, sf_dir), base, "customer_id")
    return joined.select("customer_id", "city", "frequency", "recency")


def join_left_outer_null_keys(spark, sf_dir):
    """Order lines with their buyer's city; the lines of all guests have no key."""
    lines, customers = recipes.order_lines(spark, sf_dir), recipes.customers(spark, sf_dir)
    cities = customers.select("customer_id", "city")
    return th.left_join(lines, cities, "customer_id").select("order_line_id", "customer_id", "sales_quantity", "city")


def join_full_outer(spark, sf_dir):
    return _snapshot_pairs(spark, sf_dir, "full")


def join_matched_inner(spark, sf_dir):
    return _snapshot_pairs(spark, sf_dir, "inner")


def join_new_only_anti(spark, sf_dir):
    first, second = _snapshot(spark, sf_dir, 1), _snapshot(spark, sf_dir, 2)
    return second.join(first, "product_id", "left_anti")


# Aggregates


def _rfm_base(spark, sf_dir):
    return th.rfm_base(recipes.order_lines(spark, sf_dir), SNAPSHOT_DATE)


def agg_last_purchase(spark, sf_dir):
    return _rfm_base(spark, sf_dir).select("customer_id", "last_purchase_date")


def agg_order_frequency(spark, sf_dir):
    return _rfm_base(spark, sf_dir).select("customer_id", "frequency")


def agg_monetary(spark, sf_dir):
    return _rfm_base(spark, sf_dir).select("customer_id", _money("monetary"))


def rfm_base(spark, sf_dir):
    return _rfm_base(spark, sf_dir).withColumn("monetary", _money("monetary"))


def avg_delay_per_warehouse(spark, sf_dir):
    facts = th.delivery_facts(recipes.logistics(spark, sf_dir))
    delays = th.avg_delay(facts).withColumn("avg_delivery_delta", F.round("avg_delivery_delta", 6))
    return _positioned(delays, spark)


# Scores, order, union


def rfm_scores(spark, sf_dir):
    scores = th.rfm(recipes.order_lines(spark, sf_dir), SNAPSHOT_DATE)
    return scores.withColumn("monetary", _money("monetary"))


def _score(column: str) -> Query:
    def query(spark, sf_dir):
        return th.rfm(recipes.order_lines(spark, sf_dir), SNAPSHOT_DATE).select("customer_id", column)

    return query


def scd2_history_ordered(spark, sf_dir):
    dim = _product_versions(spark, sf_dir, 3).read()
    return _positioned(dim.orderBy("product_id", "dw_start_date", "dw_end_date"), spark)


def preview_top_n(spark, sf_dir):
    """The ten first order lines; a limit is the operator here."""
    lines = recipes.order_lines(spark, sf_dir)
    return lines.orderBy("order_line_id", "sales_quantity", "price_per_unit").limit(10)


def union_by_name_fill(spark, sf_dir):
    """Columns in another order and some absent on one side."""
    versions = _product_versions(spark, sf_dir, 1).read()
    second = _snapshot(spark, sf_dir, 2)
    snapshot = second.select(*reversed(second.columns))
    return versions.unionByName(snapshot, allowMissingColumns=True)


# Functions


def explode_items(spark, sf_dir):
    return (
        recipes.raw_orders(spark, sf_dir)
        .select("order_id", F.explode("items").alias("item"))
        .select("order_id", "item.*")
    )


def order_line_id(spark, sf_dir):
    """Also over a NULL part: guest orders have no customer."""
    lines = recipes.order_lines(spark, sf_dir)
    return lines.select(
        fn.order_line_id(F.col("order_id"), F.col("product_id")).alias("order_line_id"),
        fn.order_line_id(F.col("customer_id"), F.col("product_id")).alias("customer_line_id"),
    )


def recency_days(spark, sf_dir):
    lines = recipes.order_lines(spark, sf_dir)
    days = fn.recency_days(fn.order_day(F.col("order_date")), SNAPSHOT_DATE)
    return lines.select("order_line_id", days.alias("recency"))


def delivery_delta_days(spark, sf_dir):
    delta = fn.delivery_delta_days(F.col("actual_delivery_date"), F.col("estimated_delivery_date"))
    return recipes.logistics(spark, sf_dir).select("order_id", delta.alias("delta_days"))


def epoch_ms_to_timestamp(spark, sf_dir):
    """Instants shown as microseconds and UTC date, so that no session zone matters."""
    millis = F.col("actual_delivery_date")
    return recipes.logistics(spark, sf_dir).select(
        "order_id",
        F.unix_micros(fn.epoch_ms_to_timestamp(millis)).alias("micros"),
        fn.utc_day(millis).alias("day"),
    )


def arith_line_amount(spark, sf_dir):
    amount = fn.line_amount(F.col("sales_quantity"), F.col("price_per_unit"))
    return recipes.order_lines(spark, sf_dir).select(
        "order_line_id",
        amount.cast("double").alias("amount"),
        (F.col("sales_quantity") / 1000).alias("thousands"),
        (F.col("sales_quantity") + F.col("product_id")).alias("total"),
    )


def late_flag(spark, sf_dir):
    facts = th.delivery_facts(recipes.logistics(spark, sf_dir))
    return facts.select("order_id", "is_late_delivery")


def coalesce_key(spark, sf_dir):
    """Known keys kept, missing ones taken from elsewhere."""
    lines = recipes.order_lines(spark, sf_dir)
    return lines.select("order_line_id", F.coalesce("customer_id", "order_id").alias("key"))


def surrogate_key_dense(spark, sf_dir):
    customers = recipes.customers(spark, sf_dir).select("customer_id", "city")
    return th.dense_key_by(customers, "customer_id", 100, "cust_key", th.Staging(spark))


# Composite operators


def order_lines(spark, sf_dir):
    return th.flatten_orders(recipes.raw_orders(spark, sf_dir))


def dropped_orders(spark, sf_dir):
    return th.dropped_orders(recipes.raw_orders(spark, sf_dir)).drop("items")


def dim_customer(spark, sf_dir):
    return _customer_dimension(spark, sf_dir)


def _second_merge(spark, sf_dir, policy: str) -> DataFrame:
    """Second snapshot merged into the dimension that the first one built."""
    dim = _product_versions(spark, sf_dir, 1, policy).read()
    return th.scd2_merge(dim, _snapshot(spark, sf_dir, 2), RUN_DATES[1], policy)


def scd2_first_run(spark, sf_dir):
    return th.scd2_merge(
        sinks.VersionedTable(spark, th.Staging(spark).path("absent"), schemas.DIM_PRODUCTS).read(),
        _snapshot(spark, sf_dir, 1),
        RUN_DATES[0],
    )


def scd2_merge_reference(spark, sf_dir):
    return _second_merge(spark, sf_dir, "reference")


def scd2_merge_safe(spark, sf_dir):
    return _second_merge(spark, sf_dir, "safe")


def scd2_third_reference(spark, sf_dir):
    return _product_versions(spark, sf_dir, 3, "reference").read()


def _scd2_action(action: str) -> Query:
    def query(spark, sf_dir):
        return _second_merge(spark, sf_dir, "reference").where(F.col(ACTION) == action).drop(ACTION)

    return query


def fact_logistics(spark, sf_dir):
    return th.delivery_facts(recipes.logistics(spark, sf_dir))


# Flows


def _flow_orders(spark, sf_dir) -> th.WarehousePaths:
    paths = th.WarehousePaths(th.Staging(spark).root)
    raw = f"{paths.root}/raw_orders"
    recipes.raw_orders(spark, sf_dir).write.json(raw)
    sinks.drop_table(spark, "staging_orderlines")
    th.run_orders(spark, paths, raw)
    return paths


def flow_orders(spark, sf_dir):
    _flow_orders(spark, sf_dir)
    return spark.table("staging_orderlines")


def flow_dimensions(spark, sf_dir):
    """Keys, scores and versions from both published tables, joined side by side as rows."""
    paths = _flow_orders(spark, sf_dir)
    for run, recipe in enumerate((recipes.products_first, recipes.products_second)):
        th.run_dimensions(
            spark,
            paths,
            recipes.relational_customers(spark, sf_dir),
            recipe(spark, sf_dir),
            SNAPSHOT_DATE,
            RUN_DATES[run],
        )
    customers = spark.table("Dim_Customer").select(
        F.lit("customer").alias("dimension"),
        F.col("cust_key").alias("key"),
        F.col("customer_id").alias("id"),
        F.col("RFM_Score").cast("string").alias("detail"),
        F.lit(None).cast("date").alias("dw_start_date"),
        F.lit(None).cast("date").alias("dw_end_date"),
    )
    products = spark.table("Dim_Products").select(
        F.lit("product").alias("dimension"),
        F.col("product_key").alias("key"),
        F.col("product_id").alias("id"),
        F.col("product_price").alias("detail"),
        "dw_start_date",
        "dw_end_date",
    )
    return customers.unionByName(products)


def _spoilt_flow(spark, sf_dir) -> th.WarehousePaths:
    """Orders and dimensions over documents, lines and products of which some cannot be used."""
    paths = th.WarehousePaths(th.Staging(spark).root)
    recipes.spoilt_orders(spark, sf_dir).write.text(f"{paths.root}/raw_orders")
    th.run_orders(spark, paths, f"{paths.root}/raw_orders", corrupt="reject")
    th.run_dimensions(
        spark,
        paths,
        recipes.relational_customers(spark, sf_dir),
        recipes.spoilt_products(spark, sf_dir),
        SNAPSHOT_DATE,
        RUN_DATES[0],
    )
    return paths


def rejected_documents(spark, sf_dir):
    """The texts of documents that the orders flow could not read."""
    paths = _spoilt_flow(spark, sf_dir)
    return th.read_published(spark, paths, paths.rejected_documents).select(F.col("_corrupt_record").alias("document"))


def rejected_lines(spark, sf_dir):
    """Lines that the scores count in part only."""
    paths = _spoilt_flow(spark, sf_dir)
    return th.read_published(spark, paths, paths.rejected_lines).select("order_line_id", "order_date", "price_per_unit")


def scd2_quarantine(spark, sf_dir):
    """Products without a key, which the merge leaves out."""
    paths = _spoilt_flow(spark, sf_dir)
    return th.read_published(spark, paths, paths.rejected_products)


def reject_counts(spark, sf_dir):
    """How many rows the flows read and rejected, as counted by the passes that use them."""
    paths = _spoilt_flow(spark, sf_dir)
    return th.read_published(spark, paths, paths.reject_counts)


def flow_all(spark, sf_dir):
    """All flows, started again without and with news; rows of all tables of the last release side by side."""
    paths = th.WarehousePaths(th.Staging(spark).root)
    raw = f"{paths.root}/raw_orders"
    recipes.raw_orders(spark, sf_dir).write.json(raw)

    def run(products, day) -> list[str]:
        frames = recipes.relational_customers(spark, sf_dir), products, recipes.relational_logistics(spark, sf_dir)
        return th.run_all(spark, paths, raw, *frames, SNAPSHOT_DATE, day)

    first, second = recipes.products_first(spark, sf_dir), recipes.products_second(spark, sf_dir)
    steps = [run(first, RUN_DATES[0]), run(first, RUN_DATES[0]), run(second, RUN_DATES[1])]
    if steps != [["orders", "dimensions", "logistics"], [], ["dimensions"]]:
        raise RuntimeError(f"steps were repeated or left out: {steps}")
    release = th.releases(spark, paths).current()

    def rows(kind: str, table: str, schema, key: str | None, id_: str, detail: str, day: str | None = None) -> DataFrame:
        df = th.releases(spark, paths).read(table, schema, release)
        return df.select(
            F.lit(kind).alias("kind"),
            (F.col(key) if key else F.lit(None).cast("bigint")).alias("key"),
            F.col(id_).alias("id"),
            F.col(detail).cast("string").alias("detail"),
            (F.col(day) if day else F.lit(None).cast("date")).alias("until"),
        )

    lines = rows("line", paths.order_lines, schemas.ORDER_LINES, None, "order_id", "order_line_id")
    customers = rows("customer", paths.dim_customer, schemas.DIM_CUSTOMER, "cust_key", "customer_id", "RFM_Score")
    products = rows("product", paths.dim_products, schemas.DIM_PRODUCTS, "product_key", "product_id", "product_price", "dw_end_date")
    facts = rows("delivery", paths.fact_logistics, schemas.FACT_LOGISTICS, None, "order_id", "delivery_time_delta_days")
    return lines.unionAll(customers).unionAll(products).unionAll(facts)


def flow_logistics(spark, sf_dir):
    paths = th.WarehousePaths(th.Staging(spark).root)
    th.run_logistics(spark, paths, recipes.relational_logistics(spark, sf_dir))
    late = F.count_if("is_late_delivery").alias("late")
    facts = spark.table("Fact_Logistics")
    return facts.groupBy("warehouse_id").agg(
        F.round(F.avg("delivery_time_delta_days"), 6).alias("avg_delivery_delta"),
        late,
        F.count("*").alias("deliveries"),
    )


def all_queries() -> dict[str, Query]:
    plain = [
        json_orders_scan,
        json_orders_inferred_scan,
        json_orders_multiline_scan,
        staged_orders_scan,
        customers_scan,
        order_lines_scan,
        products_scan,
        logistics_scan,
        customers_snapshot,
        products_snapshot,
        logistics_snapshot,
        snapshot_type_mapping,
        orders_stage_roundtrip,
        order_lines_roundtrip,
        dim_customer_roundtrip,
        scd2_publish_roundtrip,
        fact_logistics_roundtrip,
        ext_staging_orderlines,
        ext_dim_customer,
        ext_dim_products,
        ext_fact_logistics,
        ext_drop_recreate,
        project_columns,
        computed_columns,
        rename_columns,
        nested_field_access,
        typed_literals,
        scd2_current_rows,
        filter_null_checks,
        filter_unmatched,
        filter_equal_3vl,
        filter_notequal_3vl,
        join_left_outer,
        join_left_outer_null_keys,
        join_full_outer,
        join_matched_inner,
        join_new_only_anti,
        agg_last_purchase,
        agg_order_frequency,
        agg_monetary,
        rfm_base,
        avg_delay_per_warehouse,
        scd2_history_ordered,
        preview_top_n,
        union_by_name_fill,
        explode_items,
        order_line_id,
        recency_days,
        delivery_delta_days,
        epoch_ms_to_timestamp,
        arith_line_amount,
        late_flag,
        coalesce_key,
        surrogate_key_dense,
        order_lines,
        dropped_orders,
        rfm_scores,
        dim_customer,
        scd2_first_run,
        scd2_merge_reference,
        scd2_merge_safe,
        scd2_third_reference,
        fact_logistics,
        flow_orders,
        flow_dimensions,
        flow_logistics,
        flow_all,
        rejected_documents,
        rejected_lines,
        scd2_quarantine,
        reject_counts,
    ]
    queries = {query.__name__: query for query in plain}
    for letter in "rfm":
        queries[f"rfm_{letter}_score"] = _score(f"{letter}_score")
    for action in ("unchanged", "new", "expired", "new_version"):
        queries[f"scd2_{action}"] = _scd2_action(action)
    return queries
