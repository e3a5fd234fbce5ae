"""Full replacement of a Parquet folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillhouse import storage


def replace_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write `df` beside the folder and then swap the two, so `df` may read what it replaces.

    A run that dies while writing leaves the old folder as it was; one that dies
    between the two renames leaves it beside its place, under `<path>.old-...`.
    """
    spark, path, mark = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex[:8]
    new, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    try:
        df.write.mode("errorifexists").parquet(new)
    except Exception:
        storage.delete(spark, new)
        raise
    if storage.exists(spark, path):
        storage.rename(spark, path, old)
    storage.rename(spark, new, path)
    storage.delete(spark, old)
    return spark.read.schema(df.schema).parquet(path)
