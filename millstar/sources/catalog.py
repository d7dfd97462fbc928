"""Which tables a layer directory holds."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millstar.sources import fs


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Sub-directories of ``root`` holding a Parquet file at any depth; [] when missing."""
    root = root.rstrip("/")
    return [name for name in fs.list_dirs(spark, root)
            if not name.startswith(("_", "."))
            and fs.has_file(spark, f"{root}/{name}", ".parquet")]


def has_versions(spark: SparkSession, table_dir: str) -> bool:
    """Whether the folder is a versioned table (committed or not) rather than plain Parquet files."""
    return any(d.startswith("snapshot_ts=") for d in fs.list_dirs(spark, table_dir))
