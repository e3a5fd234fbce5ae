"""A table kept as numbered folders, so that it can be rebuilt from itself.

Overwriting a folder that the plan still reads destroys it. Each run writes a
new folder instead, checks it, and only then marks it published; readers take
the newest published folder. A run that dies midway leaves the last one valid.
One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse import storage
from tillhouse.metrics import observed
from tillhouse.schemas import conform, same_columns

PREFIX = "version-"
PUBLISHED = "_PUBLISHED"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def versions(self) -> list[int]:
        """Every version folder, published or not."""
        names = storage.child_names(self.spark, self.path)
        return sorted(int(n.removeprefix(PREFIX)) for n in names if n.startswith(PREFIX))

    def folder(self, version: int) -> str:
        return f"{self.path}/{PREFIX}{version:08d}"

    def current(self) -> str | None:
        """Folder of the newest published version, None before the first run.

        A plain Parquet folder written by other means counts as the version
        before the first, so that an existing table is taken over, not restarted.
        """
        for version in reversed(self.versions()):
            if storage.exists(self.spark, f"{self.folder(version)}/{PUBLISHED}"):
                return self.folder(version)
        names = storage.child_names(self.spark, self.path)
        return self.path if any(n.endswith(".parquet") for n in names) else None

    def read(self) -> DataFrame:
        """Rows of the current version; an empty frame only if nothing was ever published.

        Unreadable or damaged files raise: they are not a first run.
        """
        folder = self.current()
        if folder is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(folder)

    def write(self, df: DataFrame) -> str:
        """Write the next version without publishing it; returns its folder."""
        folder = self.folder(max(self.versions(), default=0) + 1)
        written = Observation()
        (
            conform(df, self.schema)
            .observe(written, F.count(F.lit(1)).alias("n"))
            .write.mode("errorifexists")
            .parquet(folder)
        )
        self._verify(folder, observed(written, {"n": 0})["n"])
        return folder

    def _verify(self, folder: str, expected: int) -> None:
        stored = self.spark.read.parquet(folder)
        if not same_columns(stored.schema, self.schema):
            raise RuntimeError(f"{folder} has columns {stored.schema.simpleString()}")
        found = stored.count()
        if found != expected:
            raise RuntimeError(f"{folder} holds {found} rows, {expected} were written")

    def drop_old(self, keep: int = 2) -> None:
        """Delete all but the newest `keep` published versions, and runs that never published."""
        versions = self.versions()
        published = [v for v in versions if storage.exists(self.spark, f"{self.folder(v)}/{PUBLISHED}")]
        kept = set(published[-max(keep, 1) :])
        for version in versions:
            if version not in kept and published and version < published[-1]:
                storage.delete(self.spark, self.folder(version))

    def publish(self, df: DataFrame) -> str:
        """Write, check and publish a new version; returns its folder."""
        return self.mark(self.write(df))

    def mark(self, folder: str) -> str:
        """Publish a version that `write` has left."""
        storage.touch(self.spark, f"{folder}/{PUBLISHED}")
        return folder
