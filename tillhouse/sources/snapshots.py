"""Full snapshots of relational tables, landed as Parquet."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.columns import snapshot_column
from tillhouse.sinks.files import replace_parquet

FETCH_SIZE = "10000"


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str,
    num_partitions: int,
    bounds: tuple[int, int] | tuple[date, date] | tuple[datetime, datetime] | None = None,
    split: str = "stride",
) -> DataFrame:
    """Read one table over `num_partitions` connections split on `split_column`.

    `split="stride"` gives each connection an equal stretch of values. `bounds`
    only shape the stride: rows outside them are still read. Without bounds the
    database is asked for the column's smallest and largest value.
    `split="quantiles"` asks it for the values that part the rows evenly, so that
    a gap or a cluster of values does not load one connection; many rows of one
    value stay together. Rows without a value come with the first part.
    `properties` carries the user, password and driver of the caller's choice;
    unless it says otherwise, `FETCH_SIZE` rows travel at a time, since drivers
    may else hold a whole partition in memory. The connections do not share one
    transaction: a table that changes meanwhile is not read as of one moment.
    """
    if split not in ("stride", "quantiles"):
        raise ValueError(f"split must be 'stride' or 'quantiles', not {split!r}")
    properties = {"fetchsize": FETCH_SIZE} | properties
    if split == "quantiles":
        # One row for each connection.
        parts = (
            f"(SELECT MIN({split_column}) AS lo FROM (SELECT {split_column}, NTILE({num_partitions}) "
            f"OVER (ORDER BY {split_column}) AS part FROM {table} WHERE {split_column} IS NOT NULL) ranked "
            "GROUP BY part) parts"
        )
        starts = sorted({row.lo for row in spark.read.jdbc(url, parts, properties=properties).collect()})
        if len(starts) < 2:
            return spark.read.jdbc(url, table, properties=properties)
        return spark.read.jdbc(url, table, predicates=_ranges(split_column, starts), properties=properties)
    if bounds is None:
        extent = f"(SELECT MIN({split_column}) AS lo, MAX({split_column}) AS hi FROM {table}) extent"
        lo, hi = spark.read.jdbc(url, extent, properties=properties).first()
        if lo is None:
            return spark.read.jdbc(url, table, properties=properties)
        bounds = (lo, hi)
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=num_partitions,
        properties=properties,
    )


def _literal(value: int | Decimal | date | datetime | str) -> str:
    """A value as standard SQL."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _ranges(column: str, starts: list) -> list[str]:
    """Conditions that part all rows at `starts[1:]`; NULL belongs to the first."""
    cuts = [_literal(start) for start in starts[1:]]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def map_snapshot_types(df: DataFrame) -> DataFrame:
    """Dates and timestamps as epoch milliseconds, decimals as text, the rest unchanged."""
    return df.select(
        *[snapshot_column(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def land_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Replace the landed copy of a relational table and return it as read back."""
    return replace_parquet(map_snapshot_types(df), path)
