"""The three warehouse flows, from sources to external tables.

Every flow writes its tables into new folders and publishes them together, as one
release; see `tillhouse.sinks.releases`.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillhouse import storage
from tillhouse.metrics import observed
from tillhouse.operators.logistics import avg_delay, delivery_facts
from tillhouse.operators.orders import flatten_orders, is_unusable_line, unusable_lines
from tillhouse.operators.rfm import dim_customer
from tillhouse.operators.scd2 import ACTION, changed_rows, find_changes, quarantine, scd2_merge
from tillhouse.schemas import (
    CUSTOMERS,
    DIM_CUSTOMER,
    DIM_PRODUCTS,
    FACT_LOGISTICS,
    LOGISTICS,
    ORDER_LINES,
    PRODUCTS_SOURCE,
    RAW_ORDERS,
    conform,
)
from tillhouse.sinks.catalog import show_table
from tillhouse.sinks.releases import Draft, Release, Releases
from tillhouse.sources.json_orders import CORRUPT_COLUMN, read_orders_json
from tillhouse.sources.snapshots import map_snapshot_types
from tillhouse.sources.tables import rename_products
from tillhouse.staging import Staging


@dataclass(frozen=True)
class WarehousePaths:
    """Where each table lives below one root folder; its newest version is in a folder there that the release names."""

    root: str = "/user"

    @property
    def staged_orders(self) -> str:
        return f"{self.root}/staging/e-commerce/orders"

    @property
    def order_lines(self) -> str:
        return f"{self.root}/warehouse/e-commerce/order_lines"

    @property
    def customers(self) -> str:
        return f"{self.root}/source/customers"

    @property
    def products(self) -> str:
        return f"{self.root}/source/products"

    @property
    def logistics(self) -> str:
        return f"{self.root}/source/logistics"

    @property
    def dim_customer(self) -> str:
        return f"{self.root}/warehouse/e-commerce/Dim_Customer"

    @property
    def dim_products(self) -> str:
        return f"{self.root}/warehouse/e-commerce/Dim_Products"

    @property
    def rejected(self) -> str:
        return f"{self.root}/warehouse/e-commerce/rejected"

    @property
    def rejected_documents(self) -> str:
        return f"{self.rejected}/documents"

    @property
    def rejected_lines(self) -> str:
        return f"{self.rejected}/order_lines"

    @property
    def rejected_products(self) -> str:
        return f"{self.rejected}/products"

    @property
    def reject_counts(self) -> str:
        return f"{self.rejected}/counts"

    @property
    def releases(self) -> str:
        return f"{self.root}/releases"

    @property
    def fact_logistics(self) -> str:
        return f"{self.root}/warehouse/e-commerce/fact_logistics"


def releases(spark: SparkSession, paths: WarehousePaths) -> Releases:
    """The releases of a warehouse, through which its tables are read and published."""
    return Releases(spark, paths.releases)


def read_published(
    spark: SparkSession, paths: WarehousePaths, table: str, schema: StructType | None = None
) -> DataFrame:
    """A table as of the newest release, for example `paths.order_lines`."""
    if schema is None:
        release = releases(spark, paths).current()
        return spark.read.parquet(*release.tables[table].paths)
    return releases(spark, paths).read(table, schema)


def catalog_tables(paths: WarehousePaths) -> dict[str, tuple[str, StructType]]:
    """The external tables of a warehouse: their name, their place and their columns."""
    return {
        "staging_orderlines": (paths.order_lines, ORDER_LINES),
        "Dim_Customer": (paths.dim_customer, DIM_CUSTOMER),
        "Dim_Products": (paths.dim_products, DIM_PRODUCTS),
        "Fact_Logistics": (paths.fact_logistics, FACT_LOGISTICS),
    }


def show_release(spark: SparkSession, paths: WarehousePaths, release: Release, only: set[str] | None = None) -> None:
    """Point the external tables at a release; run again if a run died before it had done so.

    The catalog moves one table after the other. Readers who need tables that
    belong together take them from one release.
    """
    for name, (place, schema) in catalog_tables(paths).items():
        if place in release.tables and (only is None or place in only):
            show_table(spark, name, schema, release.tables[place], place)


def run_orders(
    spark: SparkSession,
    paths: WarehousePaths,
    raw_orders: str,
    multi_line: bool = False,
    schema: StructType | None = RAW_ORDERS,
    corrupt: str = "fail",
    keep: int = 2,
    fingerprint: str = "",
) -> DataFrame:
    """JSON orders at `raw_orders` to staged orders to order lines and their table.

    Fields that `schema` does not name are left out of the staged copy; None
    infers the schema and keeps every field. A malformed document stops the run;
    with `corrupt="reject"` its text is kept below `paths.rejected` instead.
    Both tables and the rejects are published together.
    """
    if corrupt not in ("fail", "reject"):
        raise ValueError(f"corrupt must be 'fail' or 'reject', not {corrupt!r}")
    with Staging(spark) as staging, releases(spark, paths).draft() as draft:
        if corrupt == "fail":
            orders = read_orders_json(spark, raw_orders, multi_line, schema=schema, staging=staging)
            staged = draft.write(paths.staged_orders, orders)
        else:
            orders = read_orders_json(spark, raw_orders, multi_line, "column", schema, staging)
            staged = _keep_rejects(spark, draft, paths, orders, staging)
        lines = draft.write(paths.order_lines, flatten_orders(staged), ORDER_LINES)
        release = draft.publish("orders", fingerprint)
    show_release(spark, paths, release, {paths.order_lines})
    releases(spark, paths).prune(keep)
    return lines


def _keep_rejects(
    spark: SparkSession, draft: Draft, paths: WarehousePaths, orders: DataFrame, staging: Staging
) -> DataFrame:
    """Keep what can be read; the texts of malformed documents and their number become tables of their own."""
    counted = Observation()
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    counted_orders = orders.observe(counted, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("bad"))
    every = staging.save(counted_orders, "documents")
    n = observed(counted, NO_ROWS)
    draft.write(paths.rejected_documents, every.where(bad).select(CORRUPT_COLUMN), expected=n["bad"])
    _write_counts(spark, draft, paths, {"documents": (n["read"], n["bad"])})
    return draft.write(paths.staged_orders, every.where(~bad).drop(CORRUPT_COLUMN), expected=n["read"] - n["bad"])


NO_ROWS = {"read": 0, "bad": 0}
COUNTS = StructType(
    [StructField("source", StringType()), StructField("rows_read", LongType()), StructField("rows_rejected", LongType())]
)


def _write_counts(
    spark: SparkSession, draft: Draft, paths: WarehousePaths, counts: dict[str, tuple[int, int]]
) -> None:
    """How many rows were read and rejected: one row for each source, those of other flows kept."""
    known = {r.source: (r.rows_read, r.rows_rejected) for r in draft.read(paths.reject_counts, COUNTS).collect()}
    rows = [(source, *numbers) for source, numbers in sorted((known | counts).items())]
    draft.write(paths.reject_counts, spark.createDataFrame(rows, COUNTS).coalesce(1), COUNTS)


def run_dimensions(
    spark: SparkSession,
    paths: WarehousePaths,
    customers: DataFrame,
    products: DataFrame,
    snapshot_date: date,
    as_of: date | None = None,
    policy: str = "safe",
    keep: int = 2,
    fingerprint: str = "",
) -> tuple[DataFrame, DataFrame]:
    """Rebuild the customer dimension, merge the products, land both snapshots.

    Needs the order lines that `run_orders` writes. `customers` and `products`
    come from `read_jdbc_table` or any other reader. Everything is built and
    checked before it is published, all at once, so a run that fails changes
    nothing. Of the product dimension `safe` writes the buckets that have changed.
    `keep` releases stay. Products without a key and lines whose amount or date
    cannot be used are kept below `paths.rejected`, with their numbers, which
    come from the passes that build the dimensions.
    """
    as_of = as_of or date.today()
    with Staging(spark) as staging, releases(spark, paths).draft() as draft:
        lines_counted, sold_counted = Observation(), Observation()
        lines = draft.read(paths.order_lines, ORDER_LINES)
        # Counting is a step of its own in the plan, below which no further column is dropped.
        measured = lines.select("customer_id", "order_id", "order_date", "sales_quantity", "price_per_unit")
        counted_lines = measured.observe(
            lines_counted, F.count(F.lit(1)).alias("read"), F.count_if(is_unusable_line()).alias("bad")
        )
        keyless = F.col("product_id").isNull()
        counted_products = map_snapshot_types(products).observe(
            sold_counted, F.count(F.lit(1)).alias("read"), F.count_if(keyless).alias("bad")
        )
        landed = draft.write(paths.customers, map_snapshot_types(customers))
        sold = rename_products(conform(draft.write(paths.products, counted_products), PRODUCTS_SOURCE))
        scored = dim_customer(conform(landed, CUSTOMERS), counted_lines, snapshot_date, staging)
        dimension = draft.write(paths.dim_customer, scored, DIM_CUSTOMER)

        dim = draft.read(paths.dim_products, DIM_PRODUCTS)
        if policy == "safe":
            found = find_changes(dim, sold, as_of, staging=staging)
            changed = staging.save(changed_rows(dim, sold, found, as_of).drop(ACTION), "changed")
            versions = draft.write_changes(paths.dim_products, changed, DIM_PRODUCTS, "product_key")
        else:
            merged = scd2_merge(dim, sold, as_of, policy, staging=staging)
            versions = draft.write(paths.dim_products, merged.drop(ACTION), DIM_PRODUCTS)

        found_rows = {"order_lines": observed(lines_counted, NO_ROWS), "products": observed(sold_counted, NO_ROWS)}
        counts = {name: (n["read"], n["bad"]) for name, n in found_rows.items()}
        draft.write(paths.rejected_products, quarantine(sold), expected=counts["products"][1])
        draft.write(paths.rejected_lines, unusable_lines(lines), expected=counts["order_lines"][1])
        _write_counts(spark, draft, paths, counts)
        release = draft.publish("dimensions", fingerprint)
    show_release(spark, paths, release, {paths.dim_customer, paths.dim_products})
    releases(spark, paths).prune(keep)
    return dimension, versions


def run_logistics(
    spark: SparkSession, paths: WarehousePaths, logistics: DataFrame, keep: int = 2, fingerprint: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Land the logistics snapshot, write its facts, average the delay per warehouse."""
    with releases(spark, paths).draft() as draft:
        landed = conform(draft.write(paths.logistics, map_snapshot_types(logistics)), LOGISTICS)
        facts = draft.write(paths.fact_logistics, delivery_facts(landed), FACT_LOGISTICS)
        release = draft.publish("logistics", fingerprint)
    show_release(spark, paths, release, {paths.fact_logistics})
    releases(spark, paths).prune(keep)
    return facts, avg_delay(facts)


def frame_mark(df: DataFrame) -> list[str]:
    """What tells two states of a table apart: its columns, the number of its rows and a sum of their hashes."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("hash")).first()
    return [df.schema.simpleString(), str(row["n"]), str(row["hash"])]


def _mark_of(*told: object) -> str:
    return hashlib.sha256(json.dumps(told, default=str).encode()).hexdigest()


def run_all(
    spark: SparkSession,
    paths: WarehousePaths,
    raw_orders: str,
    customers: DataFrame,
    products: DataFrame,
    logistics: DataFrame,
    snapshot_date: date,
    as_of: date | None = None,
    policy: str = "safe",
    multi_line: bool = False,
    schema: StructType | None = RAW_ORDERS,
    corrupt: str = "fail",
) -> list[str]:
    """Orders before dimensions, which read the order lines; logistics stands alone. Returns the steps it ran.

    A release says from which inputs each flow made its tables. A step whose
    inputs have not changed since is left out, so a run that was killed goes on
    where it stopped when it is started again, and a finished one does nothing.
    Inputs are told apart by the names, sizes and times of files and by a sum of
    hashes over the rows of frames, which costs one more read of those.
    """
    as_of = as_of or date.today()
    ran = []

    def pending(step: str, mark: str) -> bool:
        if releases(spark, paths).current().steps.get(step) == mark:
            return False
        ran.append(step)
        return True

    mark = _mark_of(storage.file_marks(spark, raw_orders), multi_line, schema and schema.simpleString(), corrupt)
    if pending("orders", mark):
        run_orders(spark, paths, raw_orders, multi_line, schema, corrupt, fingerprint=mark)
    lines = releases(spark, paths).current().tables[paths.order_lines].paths
    mark = _mark_of(frame_mark(customers), frame_mark(products), lines, snapshot_date, as_of, policy)
    if pending("dimensions", mark):
        run_dimensions(spark, paths, customers, products, snapshot_date, as_of, policy, fingerprint=mark)
    mark = _mark_of(frame_mark(logistics))
    if pending("logistics", mark):
        run_logistics(spark, paths, logistics, fingerprint=mark)
    # A run may have died between publishing and this.
    show_release(spark, paths, releases(spark, paths).current())
    return ran
