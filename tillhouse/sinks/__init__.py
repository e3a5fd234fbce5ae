"""Writers: replaced Parquet folders, versioned tables, releases of several tables, external tables."""

from tillhouse.sinks.catalog import create_external_table, drop_table, point_table, show_table
from tillhouse.sinks.files import replace_parquet
from tillhouse.sinks.releases import ConcurrentRelease, Draft, Release, Releases, Table
from tillhouse.sinks.versions import VersionedTable

__all__ = [
    "ConcurrentRelease",
    "Draft",
    "Release",
    "Releases",
    "Table",
    "VersionedTable",
    "create_external_table",
    "drop_table",
    "point_table",
    "replace_parquet",
    "show_table",
]
