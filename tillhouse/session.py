"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


SCAN_SPLIT = 256 << 20
SHUFFLE_SPLIT = 256 << 20


def size_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about `shuffle_bytes`.

    Adaptive execution merges small shuffle partitions but never adds any, so
    the number to start from has to come from the data, not from the default.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // SHUFFLE_SPLIT))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_SPLIT),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT),
    }


def build_session(app_name: str = "tillhouse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with `SETTINGS`; keyword names use `__` for the dots of a Spark setting.

    On a cluster pass `spark__checkpoint__dir`, a folder every executor can
    reach, unless the cluster's own defaults name it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in (SETTINGS | overrides).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
