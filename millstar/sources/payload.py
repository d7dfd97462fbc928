"""Split landed JSON payloads ``{"tables": {name: [row, ...]}}`` into bronze tables.

The extraction lands payload documents as files (one document per page of
rows; JSON Lines when ``multi_line=False``).  Spark reads them all at once and
``inline`` turns each table's array into rows, so pages from many files simply
concatenate.  A table is skipped when its array is absent, NULL, empty in every
page, or not an array of objects (empty arrays are inferred as ``array<string>``).

Every table and every column that was landed is kept.  ``open_schema`` takes
names and types from the data (one inference pass) and puts the declared types in
where a column is declared; id columns that hold text stay text.  Where the
payload is known to hold declared columns only, passing ``payload_schema``
instead saves the inference pass, and drops whatever is not declared.  A multi-line
document is one task's work; ``splittable`` turns those that are too long for that
into pages first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.schemas import KEY_COLUMNS
from millstar.sources import feed, fs, split
from millstar.sources.snapshots import stamp, write_parquet, write_snapshot

# A staged page is one row that holds many; a reader's batch of pages holds about this many of their rows.
ROWS_AT_ONCE = 1 << 16
_BATCH = "spark.sql.parquet.columnarReaderBatchSize"
_SIZES = "sizes"


def payload_schema(tables: dict[str, T.StructType]) -> T.StructType:
    """The payload document type for the given table row types."""
    return T.StructType([T.StructField("tables", T.StructType(
        [T.StructField(name, T.ArrayType(row)) for name, row in tables.items()]))])


def open_schema(spark: SparkSession, landed: str | list[str], declared: dict[str, T.StructType],
                multi_line: bool = True) -> T.StructType:
    """The payload type as landed: all its tables and columns, declared types where declared.

    Declared columns that a landed table lacks are added (they read NULL); a
    declared table that is absent or always empty is left as found.
    """
    found = read_payload(spark, landed, None, multi_line).schema
    if "tables" not in found.names or not isinstance(found["tables"].dataType, T.StructType):
        return found
    tables = {}
    for f in found["tables"].dataType.fields:
        if not (isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)):
            continue  # empty in every page
        row, types = f.dataType.elementType, declared.get(f.name, T.StructType())
        known = {c.name: c.dataType for c in types.fields}
        fields = []
        for c in row.fields:
            text_id = c.name in KEY_COLUMNS and isinstance(c.dataType, T.StringType)
            fields.append(T.StructField(c.name, c.dataType if text_id else known.get(c.name, c.dataType)))
        fields += [T.StructField(c.name, c.dataType) for c in types.fields if c.name not in row.names]
        tables[f.name] = T.StructType(fields)
    return payload_schema(tables)


def read_payload(spark: SparkSession, landed: str | list[str],
                 schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    paths = [landed] if isinstance(landed, str) else list(landed)
    return reader.json(paths)


def table_rows(payload: DataFrame, name: str) -> DataFrame:
    """All rows of one table across every landed page."""
    return payload.select(F.inline(F.col("tables").getField(name)))


def payload_tables(payload: DataFrame) -> list[str]:
    """Table names whose element type is an object (candidates for landing)."""
    if "tables" not in payload.columns:
        return []
    tables = payload.schema["tables"].dataType
    if not isinstance(tables, T.StructType):
        return []
    return [f.name for f in tables.fields
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]


def page_sizes(payload: DataFrame, names: list[str]) -> list:
    """Rows of each table in one page."""
    return [F.size(F.col("tables").getField(n)).alias(f"n{i}") for i, n in enumerate(names)]


def largest_pages(payload: DataFrame, names: list[str], staged: bool = False) -> dict[str, int]:
    """One aggregate pass over the payload: tables that have at least one row, and the most rows of theirs in a page.

    Of ``staged`` pages only the sizes staged beside them are read.
    """
    if not names:
        return {}
    rows = payload.select(f"{_SIZES}.*") if staged else payload.select(*page_sizes(payload, names))
    most = rows.agg(*[F.max(f"n{i}").alias(f"n{i}") for i in range(len(names))]).first()
    return {n: most[f"n{i}"] for i, n in enumerate(names) if most[f"n{i}"] is not None and most[f"n{i}"] > 0}


@contextmanager
def batches_of(spark: SparkSession, pages: int) -> Iterator[None]:
    """Parquet readers planned meanwhile take at most so many pages into a batch.

    A batch of nested rows is held in memory whole, all rows of all its pages.
    """
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(max(1, min(int(before), pages))))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def landed_files(spark: SparkSession, landed: str | list[str]) -> DataFrame:
    """The landed files as a table (path, modificationTime, length): Spark lists the folders, many of them in parallel
    on the executors, and no file is opened."""
    paths = [landed] if isinstance(landed, str) else list(landed)
    return spark.read.format("binaryFile").load(paths).select("path", "modificationTime", "length")


def landed_bytes(spark: SparkSession, landed: str | list[str]) -> int:
    """Bytes of all landed files, summed by Spark over their listing."""
    return landed_files(spark, landed).agg(F.sum("length")).first()[0] or 0


def _range_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728").rstrip("b") or 0) or 1 << 27


def splittable(spark: SparkSession, landed: str | list[str], multi_line: bool, scratch: str) -> tuple:
    """(landed, multi_line) to land from: where a multi-line document is longer than one task should read, the
    documents are first rewritten as JSON Lines pages under ``scratch``, by many tasks (``sources.split``)."""
    if not multi_line or split.longest_file(landed_files(spark, landed)) <= _range_bytes(spark):
        return landed, multi_line
    return split.paginate(spark, landed, scratch), False


def landing_partitions(spark: SparkSession, landed: str | list[str]) -> int:
    """Pieces for rows exploded from multi-line documents: by input bytes, the cluster's width at least.

    Each document is one row read by one task, so its rows must be spread before
    they are written; the count follows the data, not a fixed setting.
    """
    total = landed_bytes(spark, landed)
    per = _range_bytes(spark)
    return max(1, min(spark.sparkContext.defaultParallelism, -(-total // (1 << 20))), -(-total // per))


def land_payload(spark: SparkSession, landed: str | list[str], bronze_root: str,
                 when: dt.datetime | str | None = None, schema: T.StructType | None = None,
                 multi_line: bool = True, stage: bool = True,
                 parallel_writes: int = 4, increment: bool = False) -> dict[str, str]:
    """Write every non-empty table of the landed payload(s) as a new bronze version.

    With ``stage`` (default) the JSON is parsed once into a Parquet copy under
    ``<bronze_root>/_staging/<version>`` (hidden from table listings); the
    emptiness check and every table then read only their own nested column from
    it instead of parsing the JSON once per table, as many pages at a time as
    hold ROWS_AT_ONCE rows.  The staging copy is removed
    after the last table is written; a failed run leaves it to be overwritten.
    An ``increment`` adds to what was landed before; otherwise the landing is a full
    extraction of its tables and replaces it (see ``sources.feed``).
    Tables are written ``parallel_writes`` at a time.
    Returns ``{table: version directory}``.
    """
    version = when if isinstance(when, str) else stamp(when)
    root = bronze_root.rstrip("/")
    payload = read_payload(spark, landed, schema, multi_line)
    names = payload_tables(payload)
    spread = landing_partitions(spark, landed) if multi_line and names else 1
    staging = f"{root}/_staging/{version}"
    if stage and names:
        write_parquet(payload.select("tables", F.struct(*page_sizes(payload, names)).alias(_SIZES)), staging)
        payload = spark.read.parquet(staging)
    largest = largest_pages(payload, names, staged=stage)

    def land(name: str):
        out = table_rows(payload, name)
        if increment:
            feed.mark_increment(spark, f"{root}/{name}", version)
        # Spark sorts before a round-robin repartition, so a retried task reproduces it.
        return name, write_snapshot(out.repartition(spread) if spread > 1 else out, f"{root}/{name}", version)

    with (batches_of(spark, ROWS_AT_ONCE // max(largest.values(), default=1)),
          ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool):
        written = dict(pool.map(land, largest))
    if stage and fs.exists(spark, staging):
        fs.delete(spark, staging)
    return written
