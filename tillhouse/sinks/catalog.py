"""External tables over Parquet folders; dropping one keeps its files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tillhouse.sinks.releases import BUCKET, Table

PARTITIONS_AT_ONCE = 200


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _quoted(path: str) -> str:
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_external_table(
    spark: SparkSession, name: str, schema: StructType, path: str, replace: bool = False
) -> None:
    """Register `path` under `name`; an existing table stays unless `replace` is set."""
    if replace:
        drop_table(spark, name)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) "
        f"USING PARQUET LOCATION {_quoted(path)}"
    )
    # The session may remember the files of an earlier run.
    spark.catalog.refreshTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table, or the view that shows one kept in buckets."""
    kind = "VIEW" if _is_view(spark, name) else "TABLE"
    spark.sql(f"DROP {kind} IF EXISTS {name}")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def point_table(spark: SparkSession, name: str, path: str) -> None:
    """Move an external table to another folder, for example a newer version."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(name)


def show_table(spark: SparkSession, name: str, schema: StructType, table: Table, root: str) -> None:
    """Create `name` over the folders of a released table, or move it there; readers never miss it.

    A table in one folder is an external table. One kept in buckets is an external
    table of its own, `<name>_buckets`, with a partition a bucket, and `name` a view
    of its columns. Only buckets that have moved are altered.
    """
    if table.rows_per_bucket is None:
        if _is_view(spark, name):
            drop_table(spark, name)
        create_external_table(spark, name, schema, table.paths[0])
        point_table(spark, name, table.paths[0])
        return
    files = f"{name}_buckets"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({_columns(schema)}, `{BUCKET}` bigint) "
        f"USING PARQUET PARTITIONED BY ({BUCKET}) LOCATION {_quoted(root)}"
    )
    known = {row[0].removeprefix(f"{BUCKET}=") for row in spark.sql(f"SHOW PARTITIONS {files}").collect()}
    new = [b for b in table.folders if b not in known]
    for at in range(0, len(new), PARTITIONS_AT_ONCE):
        parts = [f"PARTITION ({BUCKET}={b}) LOCATION {_quoted(table.folders[b])}" for b in new[at : at + PARTITIONS_AT_ONCE]]
        spark.sql(f"ALTER TABLE {files} ADD {' '.join(parts)}")
    for b in known & table.folders.keys():
        place = spark.sql(f"DESCRIBE EXTENDED {files} PARTITION ({BUCKET}={b})").where("col_name = 'Location'").first()
        if place is None or not place.data_type.endswith(table.folders[b].split(":", 1)[-1]):
            spark.sql(f"ALTER TABLE {files} PARTITION ({BUCKET}={b}) SET LOCATION {_quoted(table.folders[b])}")
    for b in known - table.folders.keys():
        spark.sql(f"ALTER TABLE {files} DROP PARTITION ({BUCKET}={b})")
    spark.catalog.refreshTable(files)
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        drop_table(spark, name)
    shown = ", ".join(f"`{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM {files}")
