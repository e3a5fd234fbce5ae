"""Joins that keep rows without a key apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """`left` with the columns that `right` has for its key, NULL where it has none.

    A left outer join deals every row by its key, those without one all to the
    same task, where they match nothing. Here they go past the join.
    """
    has_key = F.col(key).isNotNull()
    met = left.where(has_key).join(right.where(has_key), key, "left")
    return met.unionByName(left.where(~has_key), allowMissingColumns=True)
