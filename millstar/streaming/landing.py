"""Incremental landing: payload files arriving in a folder -> bronze versions.

A Structured Streaming file source notices each new file once (tracked in the
query's checkpoint) and ``foreachBatch`` lands the batch's files with S1: every
table and column in them, one bronze version per batch and table.

* By default a batch holds *all* files that are new, so the pages of one
  extraction that lie in the folder when the job runs become one version, and
  nothing that arrived together is split.  ``max_files_per_trigger`` caps a batch
  only when asked to.
* The version is the newest file time (UTC, seconds) and the batch number, zero
  padded: two batches never share a version, and a replayed batch, which holds the
  same files under the same number, rewrites its own (the old copy stays until
  the new one is complete).
* Each batch is an *increment*: cleaning takes the rows of all of them (since the
  newest full extraction, if there is one) in one pass, so it does not matter how
  the files of an extraction were dealt to batches, or whether more are arriving.
* Run it as a scheduled job with ``trigger(availableNow=True)`` (process all
  new files, then stop) or continuously with a processing-time trigger.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millstar.sources import payload
from millstar.sources.snapshots import stamp

# The columns of Spark's file listing source.
_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def batch_version(newest: int, batch_id: int) -> str:
    """Sorts by file time, then by batch."""
    return f"{stamp(dt.datetime.fromtimestamp(newest, tz=dt.timezone.utc))}-{batch_id:012d}"


def _land_batch(bronze_root: str, schema: T.StructType | None, declared: dict[str, T.StructType],
                multi_line: bool):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # File names and times only; the driver tracks this list for the batch anyway.
        files = batch.select("path", F.unix_seconds("modificationTime").alias("at")).collect()
        if not files:
            return
        paths = sorted(r["path"] for r in files)
        landed = schema or payload.open_schema(spark, paths, declared, multi_line)
        payload.land_payload(spark, paths, bronze_root, batch_version(max(r["at"] for r in files), batch_id),
                             landed, multi_line, increment=True)
    return run


def landing_stream(spark: SparkSession, landing_dir: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The stream of landed files (their names and times are read, not their content)."""
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_dir).select("path", "modificationTime")


def start_landing(spark: SparkSession, landing_dir: str, bronze_root: str,
                  checkpoint_location: str, schema: T.StructType | None = None, multi_line: bool = True,
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  processing_time: str | None = None,
                  declared: dict[str, T.StructType] | None = None) -> StreamingQuery:
    """Start the landing query; ``available_now`` processes the backlog and stops.

    Without ``schema`` every table and column is kept, with the types of
    ``declared`` (table -> row type) where they are declared.
    """
    writer = (landing_stream(spark, landing_dir, max_files_per_trigger)
              .writeStream.foreachBatch(_land_batch(bronze_root, schema, declared or {}, multi_line))
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
