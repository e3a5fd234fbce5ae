"""Equal-sized buckets over a whole table, without one task seeing it.

A bucket is decided by its boundary rows alone. Those are selected by counting,
see `tillhouse.operators.selection`, and every row is then scored by comparing it
with those literals. Ids that are no numbers cannot be counted off; then a narrow
copy of the measures is range-sorted, and the boundary rows looked up by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType, StructType

from tillhouse.operators.ranking import POSITION, SortedRows
from tillhouse.operators.selection import select_places
from tillhouse.staging import Staging

EXACT = "decimal(37,10)"
KEY = "__ntile_key"
RANKS = (-1, 0, 1)
FIELDS = ("rank", "nearest", "left_over", "id")


@dataclass(frozen=True)
class Measure:
    """A score to compute: bucket 1 takes the smallest values, or the largest if `descending`.

    NULL comes first in ascending and last in descending order, and NaN is the
    largest value, as in Spark.
    """

    column: str
    score: str
    descending: bool = False

    def key(self, unique_id: str, kind: DataType) -> Column:
        """A struct of cheaply compared fields that ascends in this order.

        The nearest double comes after NULL and NaN are set apart; decimals that
        share one are told apart by what it leaves over.
        """
        value, sign = F.col(self.column), -1 if self.descending else 1
        nearest = value.cast("double")
        left_over = F.lit(0.0)
        if isinstance(kind, DecimalType):
            left_over = (value.cast(EXACT) - nearest.cast(EXACT)).cast("double") * sign
        kept = F.when(nearest.isNull() | F.isnan(nearest), 0.0)
        rank = F.when(nearest.isNull(), -sign).when(F.isnan(nearest), sign).otherwise(0)
        return F.struct(
            rank.alias("rank"),
            kept.otherwise(nearest * sign).alias("nearest"),
            F.coalesce(left_over, F.lit(0.0)).alias("left_over"),
            F.col(unique_id).alias("id"),
        )


def bucket_ends(total: int, buckets: int) -> list[int]:
    """1-based number of the last row of each bucket but the final one.

    The first `total mod buckets` buckets hold one row more than the rest. With
    fewer rows than buckets only the first `total` buckets are used.
    """
    size, larger = divmod(total, buckets)
    ends = [b * size + min(b, larger) for b in range(1, buckets)]
    return [end for b, end in enumerate(ends, 1) if b < total]


def global_ntile(
    df: DataFrame, buckets: int, measures: Sequence[Measure], unique_id: str
) -> DataFrame:
    """`df` plus one ntile score per measure; ties are broken by `unique_id`.

    `df` is read for the boundaries and again for scoring, so hand in a staged or
    stored frame.
    """
    keys = [m.key(unique_id, df.schema[m.column].dataType) for m in measures]
    if isinstance(df.schema[unique_id].dataType, NumericType):
        total = df.count()
        ends = bucket_ends(total, buckets)
        places = [(i, end) for i in range(len(measures)) for end in ends]
        found = select_places(df, keys, FIELDS, places, total, RANKS) if places else []
        boundaries = [found[i * len(ends) : (i + 1) * len(ends)] for i in range(len(measures))]
    else:
        boundaries = _sorted_boundaries(df, buckets, keys)

    scored = df
    for key, measure, own in zip(keys, measures, boundaries, strict=True):
        kind = df.select(key.alias(KEY)).schema[KEY].dataType
        scored = scored.withColumn(KEY, key).withColumn(measure.score, _bucket(own, 1, kind)).drop(KEY)
    return scored


def _sorted_boundaries(df: DataFrame, buckets: int, keys: Sequence[Column]) -> list[list[Row]]:
    """The boundary rows of each key from a sort of them all.

    The keys are sorted together, one after the other, so each takes up the same
    number of consecutive positions. The sorted copy is dropped as soon as the
    boundaries are known.
    """
    entries = [F.struct(F.lit(i).alias("measure"), k.alias("key")) for i, k in enumerate(keys)]
    narrow = df.select(F.explode(F.array(*entries)).alias("entry")).select("entry.measure", "entry.key.*")
    order = [F.asc_nulls_first(c) for c in narrow.columns]
    with Staging(df.sparkSession) as scratch:
        ranked = SortedRows(narrow, order, scratch, "ranks")
        total = ranked.total // len(keys)
        ends = bucket_ends(total, buckets)
        indexes = [i * total + end - 1 for i in range(len(keys)) for end in ends]
        rows = _rows_at(ranked, [ranked.position_of(i) for i in indexes])
    rows.sort(key=lambda row: (row.measure, row.rank, row.nearest, row.left_over, row.id is not None, row.id))
    return [[row for row in rows if row.measure == i] for i in range(len(keys))]


def _bucket(ends: list[Row], first: int, kind: StructType) -> Column:
    """The number of a row's bucket, by halving: comparisons grow with the logarithm of the buckets."""
    if not ends:
        return F.lit(first)
    middle = len(ends) // 2
    beyond = _exceeds(F.col(KEY), ends[middle], kind)
    return F.when(beyond, _bucket(ends[middle + 1 :], first + middle + 1, kind)).otherwise(
        _bucket(ends[:middle], first, kind)
    )


def _rows_at(ranked: SortedRows, positions: list[int]) -> list[Row]:
    """The boundary rows; positions are sorted in the files, so the scan skips most of them."""
    if not positions:
        return []
    return ranked.rows.where(reduce(or_, [F.col(POSITION) == p for p in positions])).collect()


def _exceeds(key: Column, boundary: Row, kind: StructType) -> Column:
    """Whether a row's key comes after the boundary row's; struct order puts NULL first."""
    return key > F.struct(*[F.lit(boundary[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])
