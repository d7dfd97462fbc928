"""Version folders bucketed by a key, so that joins on that key need no exchange.

``write`` lays a version out in ``n`` buckets of one column (Spark's own bucketing: bucket = hash of the key modulo n)
and notes column and n in a sidecar, ``_bucketing.json``, inside the folder.  The folder stays an ordinary Parquet
folder for every other reader.  ``read`` gives the DataFrame with its bucketing; no catalog entry outlives either call,
so versions are still found by their pointers alone.

A bucket is written by one task, but NULL keys and hot keys are not: rows of a key that would fill more than
``HOT_REDUCER_SLACK`` average buckets are spread over all writing tasks, each of which adds a file to that key's bucket.
Reading a bucket is one task, so joins use the bucketing only when no key is hot (``operators.lookup``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.operators.lookup import HOT_REDUCER_SLACK
from millstar.sources import fs

SIDECAR = "_bucketing.json"
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def frequent_keys(counted: DataFrame, column: str, data_type: T.DataType, buckets: int) -> list:
    """Keys with more than HOT_REDUCER_SLACK average buckets of the rows of ``counted``: at most buckets / slack."""
    total = counted.count()
    counts = (counted.select(F.col(_quoted(column)).try_cast(data_type).alias("k")).where(F.col("k").isNotNull())
              .groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    return [r["k"] for r in counts.where(F.col("n") * buckets > HOT_REDUCER_SLACK * total).collect()]


def write(df: DataFrame, path: str, column: str, buckets: int, counted: DataFrame | None = None) -> None:
    """``df`` at ``path`` in buckets of ``column``.

    Hot keys are looked for in ``counted``, a cheaper frame with the same column (such as the rows before cleaning),
    by default in ``df`` itself.  A frame without rows is written as one plain, empty Parquet file.
    """
    spark, key = df.sparkSession, F.col(_quoted(column))
    hot = frequent_keys(df if counted is None else counted, column, df.schema[column].dataType, buckets)
    row = F.xxhash64(*[F.col(_quoted(f.name)) for f in df.schema.fields if not isinstance(f.dataType, _NESTED)])
    spread = key.isNull() | key.isin(hot) if hot else key.isNull()
    task = F.when(spread, F.pmod(row, F.lit(buckets))).otherwise(F.pmod(F.hash(key), F.lit(buckets)))
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartitionById(buckets, task.cast("int")).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, column).sortBy(column).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")   # the entry only: files at a given path stay
    if not fs.has_file(spark, path, ".parquet"):
        # A bucketed write of no rows leaves no file, so nothing would tell the columns.
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
        return
    fs.write_text(spark, f"{path}/{SIDECAR}", json.dumps({"column": column, "buckets": buckets}))


def bucketing(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(column, buckets) of a folder that ``write`` wrote, else None."""
    text = fs.read_text(spark, f"{path}/{SIDECAR}")
    if text is None:
        return None
    found = json.loads(text)
    return found["column"], found["buckets"]


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The folder with its bucketing, when it has one; else as plain Parquet."""
    spec = bucketing(spark, path)
    plain = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if spec is None or any(isinstance(f.dataType, _NESTED) for f in plain.schema.fields):
        return plain
    name, (column, buckets) = f"bucketed_{uuid.uuid4().hex}", spec
    fields = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in plain.schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({_quoted(column)}) SORTED BY ({_quoted(column)}) "
              f"INTO {buckets} BUCKETS LOCATION '{location}'")
    try:
        return spark.table(name)      # resolved here: it keeps files and bucketing without the entry
    finally:
        spark.sql(f"DROP TABLE {name}")
