"""Small helpers of the operators: column names that cannot clash, written intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millstar.session import scratch_path

#: Words as every contract of this subpackage counts them.
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, prefixed until it is no column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back.

    Cuts the lineage: lost executors re-read files instead of recomputing, and
    later plans see true sizes.  The shuffle files of the write are not needed
    again and go when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
