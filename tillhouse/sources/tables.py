"""Parquet tables of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PRODUCT_NAMES = {"current_price": "product_price", "description": "product_description"}


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table, with a declared schema where the caller has one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def rename_products(df: DataFrame) -> DataFrame:
    """Source column names to the names of the product dimension."""
    return df.withColumnsRenamed(PRODUCT_NAMES)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """The landed product snapshot under warehouse names."""
    return rename_products(read_table(spark, path))
