"""Intermediate results as Parquet in the cluster's shared folder.

A staged frame is computed once, survives the loss of executors and gives
every later step the same rows in the same files, which row numbering needs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillhouse import storage


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


class Staging:
    """A fresh folder for one job's intermediates.

    `clear` drops it once the results are written elsewhere; as a context
    manager it is cleared on leaving.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark).rstrip('/')}/tillhouse-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write `df` and return it read back with the same schema."""
        path = self.path(name)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        storage.delete(self.spark, self.root)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
