"""Several tables that change together.

A draft writes every table into a new folder beside those in use. Publishing it
creates one small file that must not exist yet, the release, which names the
folders of all tables. Readers take the newest release, so they see every table
of a draft or none, whenever a run dies. Of two drafts that started from the same
release and touch the same tables, the second to publish is refused; drafts of
different tables follow each other.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse import storage
from tillhouse.metrics import observed
from tillhouse.schemas import conform, same_columns

VERSION = "version-"
BUCKET = "bucket"
ROWS_PER_BUCKET = 1_000_000
# An unreadable release is being written, or its writer died; after so long the latter.
GRACE_SECONDS = 60.0
PATIENCE_SECONDS = 5.0


class ConcurrentRelease(RuntimeError):
    """Another run has published a table that this one read or wrote."""


@dataclass(frozen=True)
class Table:
    """The folders of a table, by bucket of its dense key if it is kept in buckets."""

    folders: dict[str, str]
    rows_per_bucket: int | None = None

    @property
    def paths(self) -> list[str]:
        return list(self.folders.values())


@dataclass(frozen=True)
class Release:
    """Number 0 is the state before the first release. `steps` tells from what each flow made its tables."""

    number: int
    tables: dict[str, Table] = field(default_factory=dict)
    steps: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        tables = {path: [table.folders, table.rows_per_bucket] for path, table in self.tables.items()}
        return json.dumps({"number": self.number, "tables": tables, "steps": self.steps}, indent=1, sort_keys=True)

    @staticmethod
    def parse(text: str) -> Release | None:
        """None for a file that is not written to its end."""
        try:
            held = json.loads(text)
        except json.JSONDecodeError:
            return None
        return Release(held["number"], {path: Table(*table) for path, table in held["tables"].items()}, held["steps"])


class Releases:
    """All releases below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, number: int) -> str:
        return f"{self.root}/release-{number:08d}.json"

    def numbers(self) -> list[int]:
        names = storage.child_names(self.spark, self.root)
        return sorted(int(n.removeprefix("release-").removesuffix(".json")) for n in names if n.startswith("release-"))

    def load(self, number: int) -> Release | None:
        return Release.parse(storage.read_text(self.spark, self.path(number)))

    def current(self) -> Release:
        for number in reversed(self.numbers()):
            found = self.load(number)
            if found is not None:
                return found
        return Release(0)

    def read(self, table: str, schema: StructType, release: Release | None = None) -> DataFrame:
        """A table as of a release, by default the newest; empty if it was never published.

        A plain Parquet folder written by other means counts as published
        before the first release. Unreadable or damaged files raise.
        """
        release = release or self.current()
        if table in release.tables:
            folders = release.tables[table].paths
        else:
            names = storage.child_names(self.spark, table)
            folders = [table] if any(n.endswith(".parquet") for n in names) else []
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def draft(self) -> Draft:
        """A new draft on top of the newest release; also clears away a release whose writer died."""
        for number in self.numbers():
            path = self.path(number)
            if self.load(number) is None and storage.age_seconds(self.spark, path) > GRACE_SECONDS:
                storage.delete(self.spark, path)
        return Draft(self, self.current())

    def prune(self, keep: int = 2) -> None:
        """Drop all but the newest `keep` releases, and the version folders that only those used.

        Folders that no release names go as soon as they are older than the
        oldest release kept: their runs died, or are so late that they cannot publish.
        """
        loaded = [release for release in map(self.load, self.numbers()) if release]
        kept = loaded[-max(keep, 1) :]
        if not kept:
            return
        used = {folder for release in kept for table in release.tables.values() for folder in table.paths}
        for table in {path for release in loaded for path in release.tables}:
            for name in storage.child_names(self.spark, table):
                if not name.startswith(VERSION) or int(name.split("-")[1]) > kept[0].number:
                    continue
                folder = f"{table}/{name}"
                within = [f"{folder}/{n}" for n in storage.child_names(self.spark, folder) if n.startswith(f"{BUCKET}=")]
                if folder in used:
                    continue
                unused = [path for path in within if path not in used]
                for path in unused if len(unused) < len(within) else [folder]:
                    storage.delete(self.spark, path)
        for release in loaded[: -len(kept)]:
            storage.delete(self.spark, self.path(release.number))


class Draft:
    """Tables written for the next release; as a context manager it drops them unless they are published."""

    def __init__(self, releases: Releases, base: Release):
        self.releases = releases
        self.spark = releases.spark
        self.base = base
        self.written: dict[str, Table] = {}
        self.watched: set[str] = set()
        self.folders: list[str] = []
        self.attempted = False
        self.published: Release | None = None

    def _new_folder(self, table: str) -> str:
        self.folders.append(f"{table}/{VERSION}{self.base.number + 1:08d}-{uuid.uuid4().hex[:8]}")
        return self.folders[-1]

    def read(self, table: str, schema: StructType) -> DataFrame:
        """A table as of the release that the draft started from; watched until publishing."""
        self.watched.add(table)
        return self.releases.read(table, schema, self.base)

    def write(
        self, table: str, df: DataFrame, schema: StructType | None = None, expected: int | None = None
    ) -> DataFrame:
        """Write all of a table, check what is stored, and return it read back.

        `expected` is the number of rows that it has to have, where the caller knows.
        """
        schema = schema or df.schema
        folder = self._new_folder(table)
        written = Observation()
        counted = conform(df, schema).observe(written, F.count(F.lit(1)).alias("n"))
        counted.write.mode("errorifexists").parquet(folder)
        self._verify(folder, observed(written, {"n": 0})["n"] if expected is None else expected, schema)
        self.written[table] = Table({"": folder})
        return self.spark.read.schema(schema).parquet(folder)

    def _verify(self, folder: str, expected: int, schema: StructType) -> None:
        stored = self.spark.read.parquet(folder)
        kept = StructType([f for f in stored.schema.fields if f.name != BUCKET])
        if not same_columns(kept, schema):
            raise RuntimeError(f"{folder} has columns {stored.schema.simpleString()}")
        found = stored.count()
        if found != expected:
            raise RuntimeError(f"{folder} holds {found} rows, {expected} were written")

    def write_changes(
        self, table: str, changed: DataFrame, schema: StructType, key: str, rows_per_bucket: int = ROWS_PER_BUCKET
    ) -> DataFrame:
        """Write only the buckets that `changed` rows fall into; the others stay where they are.

        `key` is a gapless number, a bucket a range of it: the rows of `changed`
        replace those with the same key or are new. Keys are given in order of
        age, so new rows make new buckets, and long closed ones are not touched
        again. `changed` is read three times; hand in a stored frame.
        """
        self.watched.add(table)
        before = self.base.tables.get(table)
        in_buckets = before is not None and before.rows_per_bucket is not None
        size = before.rows_per_bucket if in_buckets else rows_per_bucket
        bucket = F.floor(F.col(key) / F.lit(size)).cast("long")
        changed = conform(changed, schema)
        # One number for each bucket of a million rows.
        touched = {str(row[0]) for row in changed.select(bucket).distinct().collect()}
        if not touched:
            self.written[table] = before or Table({}, size)
            return self.read(table, schema)
        if in_buckets:
            kept = self._stored([before.folders[b] for b in touched if b in before.folders], schema)
        else:
            # Not kept in buckets yet: everything goes into some.
            before, kept = Table({}), self.read(table, schema)
        rows = kept.join(changed.select(key), key, "left_anti").select(*schema.names).unionByName(changed)
        folder, written = self._new_folder(table), Observation()
        (
            rows.withColumn(BUCKET, bucket)
            .observe(written, F.count(F.lit(1)).alias("n"))
            .repartition(BUCKET)
            .write.mode("errorifexists")
            .partitionBy(BUCKET)
            .parquet(folder)
        )
        self._verify(folder, observed(written, {"n": 0})["n"], schema)
        made = [n.removeprefix(f"{BUCKET}=") for n in storage.child_names(self.spark, folder) if n.startswith(f"{BUCKET}=")]
        self.written[table] = Table(before.folders | {b: f"{folder}/{BUCKET}={b}" for b in made}, size)
        return self._stored(self.written[table].paths, schema)

    def _stored(self, folders: list[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def publish(self, step: str | None = None, fingerprint: str = "") -> Release:
        """Make all tables written so far the newest release, or raise `ConcurrentRelease`."""
        steps = {step: fingerprint} if step else {}
        base, waited = self.base, 0.0
        while True:
            release = Release(base.number + 1, base.tables | self.written, base.steps | steps)
            # From here on the release may be there, whatever happens: its folders have to stay.
            self.attempted = True
            if storage.create_new(self.spark, self.releases.path(release.number), release.text()):
                break
            self.attempted = False
            latest = self.releases.current()
            if latest.number < release.number:
                # Created but not written yet.
                if waited >= PATIENCE_SECONDS:
                    raise ConcurrentRelease(f"release {release.number} is being written by another run")
                time.sleep(0.5)
                waited += 0.5
                continue
            moved = sorted(
                t for t in self.watched | set(self.written) if latest.tables.get(t) != self.base.tables.get(t)
            )
            if moved:
                raise ConcurrentRelease(f"release {latest.number} has changed {', '.join(moved)}")
            base = latest
        if self.releases.load(release.number) != release:
            raise ConcurrentRelease(f"release {release.number} was not kept")
        self.published = release
        return release

    def abandon(self) -> None:
        """Drop what was written."""
        for folder in self.folders:
            storage.delete(self.spark, folder)
        self.folders.clear()
        self.written.clear()

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, *_) -> None:
        if not self.attempted:
            self.abandon()
