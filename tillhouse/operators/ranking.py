"""Row numbers and dense keys over a whole table, without one task seeing it.

A window without PARTITION BY moves every row to a single task. Here the rows
are range-partitioned and sorted, and `monotonically_increasing_id` records each
row's partition and place in it. The frame is staged at that point, since range
bounds are sampled and a second run could place rows differently. What reaches
the driver is one count per partition.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.staging import Staging

# monotonically_increasing_id keeps the row's place in the low 33 bits, the partition above.
PLACE_BITS = 33
POSITION = "_position"
SPREAD = "_spread"


class SortedRows:
    """A staged frame in total order, with the number of rows before each partition.

    Without an order rows stay where they are read.
    """

    def __init__(self, df: DataFrame, order: Sequence[Column], staging: Staging, name: str):
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        self.rows = staging.save(df.withColumn(POSITION, F.monotonically_increasing_id()), name)
        counts = (
            self.rows.groupBy(F.shiftright(POSITION, PLACE_BITS).alias("part"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        sizes = sorted((row.part, row.n) for row in counts)
        self.parts = [part for part, _ in sizes]
        *self.starts, self.total = accumulate((n for _, n in sizes), initial=0)

    def position_of(self, index: int) -> int:
        """The stored position of the row at a 0-based place in the total order."""
        at = bisect_right(self.starts, index) - 1
        return (self.parts[at] << PLACE_BITS) + index - self.starts[at]

    def with_index(self, name: str, first: int) -> DataFrame:
        """Rows numbered from `first`; the joined side has one row per partition."""
        starts = self.rows.sparkSession.createDataFrame(
            pa.table(
                {
                    "_part": pa.array(self.parts, pa.int64()),
                    "_start": pa.array(self.starts, pa.int64()),
                }
            )
        )
        place = F.col(POSITION).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        return (
            self.rows.join(
                F.broadcast(starts), F.shiftright(POSITION, PLACE_BITS) == F.col("_part")
            )
            .withColumn(name, F.col("_start") + place + F.lit(first))
            .drop(POSITION, "_part", "_start")
        )


def dense_key(
    df: DataFrame, order: Sequence[str | Column], start: int, name: str, staging: Staging
) -> DataFrame:
    """`df` plus a gapless key from `start`, in `order`.

    Rows that `order` cannot tell apart keep the order they are read in. That
    also lets the range bounds split a large group of copies. Hand in a stored
    frame, whose rows come back in the same order if a task has to run again.
    """
    columns = [F.asc_nulls_first(c) if isinstance(c, str) else c for c in order]
    spread = df.withColumn(SPREAD, F.monotonically_increasing_id())
    ranked = SortedRows(spread, [*columns, F.asc(SPREAD)], staging, name)
    return ranked.with_index(name, start).drop(SPREAD)


def dense_key_by(
    df: DataFrame, key: str, start: int, name: str, staging: Staging, joined: DataFrame | None = None
) -> DataFrame:
    """`df` plus a gapless number from `start`, in order of one column, NULL first.

    Only that column is sorted. Whole rows are dealt by it once, to meet the
    first number of their value, and, in the same exchange, the columns that
    `joined` has for it (a left join). Rows of one value get consecutive
    numbers; they meet in one task. Rows without a value are numbered where they
    are read, and meet nothing.
    """
    has_key = F.col(key).isNotNull()
    no_key = df.where(~has_key)
    keyless = None if no_key.isEmpty() else SortedRows(no_key, [], staging, "keyless")
    first = start + keyless.total if keyless else start
    ranked = dense_key(df.where(has_key).select(key), [key], first, name, staging)
    firsts = ranked.groupBy(key).agg(F.min(name).alias(name))
    keyed = df.where(has_key).join(firsts, key)
    if joined is not None:
        keyed = keyed.join(joined.where(has_key), key, "left")
    copies = F.row_number().over(Window.partitionBy(key).orderBy(key))
    keyed = keyed.withColumn(name, F.col(name) + copies - 1)
    if keyless:
        return keyed.unionByName(keyless.with_index(name, start), allowMissingColumns=True)
    return keyed


def global_row_number(
    df: DataFrame, order: Sequence[str | Column], staging: Staging, name: str = "row_number"
) -> DataFrame:
    """`df` plus its 1-based number in `order`."""
    return dense_key(df, order, 1, name, staging)
