"""Silver that grows by increments: only new rows are compared and cleaned (P1 with C1 across versions).

Beside each silver version lies an index of the raw rows that went into it: the first 128 bits of the SHA-256 of each
distinct row, in ``buckets`` hash partitions, sorted, with Parquet bloom filters.  An increment's rows are first reduced to distinct ones;
the digests of the buckets they fall into are read (other buckets' files are pruned by the partition filter), rows that
were there before go, and what is left is cleaned and added to the silver rows.  The index grows by a folder with the new
digests; after ``CHAIN`` folders it is written whole again.

The full pass is taken, with the same result, when there is nothing to grow: no silver or index yet, a new full
extraction, a version that was written again, or columns or types that the index was not made for.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.operators import cleaning
from millstar.session import scratch_path
from millstar.sources import feed, fs, snapshots

CHAIN = 32
ROWS_PER_BUCKET = 1_000_000
DIGEST, BUCKET = "__row_digest", "__row_bucket"
DIGEST_BYTES = 16


def with_digest(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` plus a digest of their values (128 bits of SHA-256) and a bucket; rows that C1 holds equal get equal digests."""
    values = [(F.col(f"`{f.name}`") + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
              else F.col(f"`{f.name}`") for f in rows.schema.fields]  # -0.0 is 0.0
    text = F.to_json(F.struct(*values), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                                         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return _with_bucket(rows.withColumn(DIGEST, F.unhex(F.substring(F.sha2(text, 256), 1, 2 * DIGEST_BYTES))), buckets)


def _with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(DIGEST), F.lit(buckets)).cast("int"))


def _write_index(digests: DataFrame, folder: str, buckets: int) -> None:
    (digests.select(BUCKET, DIGEST).repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, DIGEST)
     .write.partitionBy(BUCKET).option("parquet.bloom.filter.enabled#" + DIGEST, "true").parquet(folder))


def seen(spark: SparkSession, folders: list[str], buckets: list[int]) -> DataFrame:
    """The index's digests in the given buckets."""
    schema = T.StructType([T.StructField(DIGEST, T.BinaryType()), T.StructField(BUCKET, T.IntegerType())])
    out = None
    for folder in folders:
        part = spark.read.schema(schema).option("basePath", folder).parquet(folder)
        out = part if out is None else out.unionByName(part)
    return out.where(F.col(BUCKET).isin(buckets))


def _log(silver_dir: str, version: str) -> str:
    return f"{silver_dir.rstrip('/')}/_index/{version}.json"


def _index(spark: SparkSession, silver_dir: str) -> dict | None:
    version = snapshots.latest_version(spark, silver_dir)
    text = fs.read_text(spark, _log(silver_dir, version)) if version else None
    return json.loads(text) if text else None


def _unseen(unique: DataFrame, old: DataFrame, buckets: int) -> DataFrame:
    """Rows whose digest is not in ``old``, written to scratch: they are read more than once."""
    path = scratch_path(unique.sparkSession, "new-rows")
    fresh = unique.drop(BUCKET).join(old.select(DIGEST), DIGEST, "left_anti").select(
        *[f"`{c}`" for c in unique.columns if c != BUCKET])
    snapshots.write_parquet(fresh, path)
    return _with_bucket(unique.sparkSession.read.parquet(path), buckets)


def grown_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, table: str, version: str,
                 declared_types: bool = True) -> DataFrame:
    """The table's silver rows for ``version``; log and index are written before the caller commits the rows."""
    live = feed.live(spark, bronze_dir)
    taken, index = feed.consumed(spark, silver_dir), _index(spark, silver_dir)
    rows = snapshots.read_folders(spark, live)
    kinds = rows.schema.simpleString()
    grows = bool(index and taken and index["schema"] == kinds and index["declared_types"] == declared_types
                 and index.get("digest_bytes") == DIGEST_BYTES and all(live.get(v) == p for v, p in taken.items()))
    folder = f"{silver_dir.rstrip('/')}/_index/{version}-{uuid.uuid4().hex}"
    if not grows:
        buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
        fresh = with_digest(cleaning.drop_few_duplicates(rows), buckets)
        silver, chain = None, [folder]
        _write_index(fresh, folder, buckets)
    else:
        buckets, old = index["buckets"], index["folders"]
        new = {v: p for v, p in live.items() if v not in taken}
        silver = snapshots.read_latest(spark, silver_dir)
        if not new:
            fresh, chain = None, old
        else:
            # The increment's rows in the common types of all live versions.
            added = snapshots.read_folders(spark, new).select([f"`{c}`" for c in rows.columns])
            unique = with_digest(cleaning.drop_few_duplicates(added), buckets)
            touched = sorted(r[0] for r in unique.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
            fresh = _unseen(unique, seen(spark, old, touched), buckets)
            chain = [*old, folder]
            if len(chain) > CHAIN:
                whole = seen(spark, old, list(range(buckets))).unionByName(fresh.select(DIGEST, BUCKET))
                chain = [folder]
                _write_index(whole, folder, buckets)
            else:
                _write_index(fresh, folder, buckets)
    feed.record(spark, silver_dir, version, live)
    fs.write_text(spark, _log(silver_dir, version), json.dumps(
        {"buckets": buckets, "schema": kinds, "declared_types": declared_types, "digest_bytes": DIGEST_BYTES,
         "folders": chain}))
    if fresh is None:
        return silver
    cleaned = cleaning.clean_table(fresh.drop(DIGEST, BUCKET), table, declared_types, "none")
    return cleaned if silver is None else silver.unionByName(cleaned)
