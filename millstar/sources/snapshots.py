"""Versioned tables.

A table is a directory; each version is a folder of Parquet files written by a normal parallel
``DataFrame.write`` (no ``coalesce(1)``, no local rename).  Properties:

* a version is committed by a pointer, an empty file ``_commits/<version>~<generation>[~<folder id>]`` that is created
  last and names the version's folder; creating an empty file is atomic everywhere, so readers see a version whole or
  not at all.  The first generation lies in ``snapshot_ts=<version>``;
* writing a stamp again writes a new folder beside the old one and then a pointer of the next generation: at no moment
  is there no committed copy, and a write that dies between the two steps changes nothing.  The generation before the
  newest stays on disk for readers that resolved it just before; older ones go;
* folders that other writers left as ``snapshot_ts=<version>`` with a ``_SUCCESS`` marker and no pointer count as committed;
* the newest version is the greatest stamp (lexicographic = chronological) and is found by listing names -- no data
  file is read;
* reading several versions merges their schemas: a column missing in a version reads NULL, a column whose type changed
  gets the least common type (``functions.types``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millstar.functions.types import common_schema, widened
from millstar.sources import fs

VERSION_COLUMN = "snapshot_ts"
STAMP_FORMAT = "%Y%m%dT%H%M%S"


def stamp(when: dt.datetime | None = None) -> str:
    """Second-resolution UTC stamp (naive datetimes are taken as UTC)."""
    if when is None:
        when = dt.datetime.now(dt.timezone.utc)
    elif when.tzinfo is not None:
        when = when.astimezone(dt.timezone.utc)
    return when.strftime(STAMP_FORMAT)


def version_path(table_dir: str, version: str) -> str:
    return f"{table_dir.rstrip('/')}/{VERSION_COLUMN}={version}"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Multi-file Parquet write with a save mode, zstd whatever the session's codec is."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file under ``path``."""
    return spark.read.parquet(path)


def _commits(spark: SparkSession, table_dir: str) -> dict[str, list[tuple[int, str]]]:
    """Version -> its committed (generation, folder) pairs, oldest first (two listings of names)."""
    root = table_dir.rstrip("/")
    found: dict[str, list[tuple[int, str]]] = {}
    for marker in fs.glob_names(spark, f"{root}/{VERSION_COLUMN}=*/_SUCCESS"):
        version = marker.rsplit("/", 2)[-2][len(VERSION_COLUMN) + 1:]
        if "~" not in version:
            found[version] = [(0, version_path(root, version))]
    for pointer in fs.glob_names(spark, f"{root}/_commits/*"):
        version, generation, *folder = pointer.rsplit("/", 1)[-1].split("~")
        if folder:
            found.setdefault(version, []).append((int(generation), _generation_path(root, version, generation, *folder)))
        else:
            found.setdefault(version, [(0, version_path(root, version))])
    return {v: sorted(pairs) for v, pairs in sorted(found.items())}


def _generation_path(root: str, version: str, generation: str, folder: str) -> str:
    return f"{version_path(root, version)}~{generation}~{folder}"


def committed(spark: SparkSession, table_dir: str) -> dict[str, str]:
    """Committed versions of a table, oldest first, and the folder of each."""
    return {v: pairs[-1][1] for v, pairs in _commits(spark, table_dir).items()}


def write_snapshot(df: DataFrame, table_dir: str, when: dt.datetime | str | None = None,
                   save: Callable[[DataFrame, str], object] = write_parquet) -> str:
    """A new version of the table, or a new copy of that version; returns its folder.

    ``save`` writes the folder's files (plain Parquet unless told otherwise) before the version is committed.
    """
    version = when if isinstance(when, str) else stamp(when)
    spark, root = df.sparkSession, table_dir.rstrip("/")
    known = _commits(spark, root).get(version)
    if not known:
        path, pointer = version_path(root, version), f"{version}~{0:010d}"
        save(df, path)
    else:
        generation, folder = f"{known[-1][0] + 1:010d}", uuid.uuid4().hex
        path, pointer = _generation_path(root, version, generation, folder), f"{version}~{generation}~{folder}"
        save(df, path)
    fs.create_empty(spark, f"{root}/_commits/{pointer}")
    for generation, folder in (known or [])[:-1]:
        _forget(spark, root, version, generation, folder)
    return path


def _forget(spark: SparkSession, root: str, version: str, generation: int, folder: str) -> None:
    """Remove a copy that newer ones replaced twice: its pointer first, so that it is never half there."""
    name = folder.rsplit("~", 1)[-1]
    pointer = f"{version}~{generation:010d}" + (f"~{name}" if generation else "")
    fs.delete(spark, f"{root}/_commits/{pointer}")
    if generation == 0:
        fs.delete(spark, f"{folder}/_SUCCESS")
    fs.delete(spark, folder)


def versions(spark: SparkSession, table_dir: str) -> list[str]:
    """Committed versions of a table, oldest first."""
    return list(committed(spark, table_dir))


def latest_version(spark: SparkSession, table_dir: str) -> str | None:
    """S3: the newest committed version, or None."""
    vs = versions(spark, table_dir)
    return vs[-1] if vs else None


def read_latest(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """The newest committed version as a DataFrame, or None when there is none."""
    found = committed(spark, table_dir)
    return spark.read.parquet(found[max(found)]) if found else None


def read_folders(spark: SparkSession, folders: dict[str, str], with_version: bool = False) -> DataFrame:
    """The concatenation of version folders (version -> path), columns and types merged.

    Schemas come from the footers, one per version; versions of equal schema are one scan, so the plan grows with the
    number of different schemas, not of versions.
    """
    with ThreadPoolExecutor(max_workers=16) as pool:
        schemas = dict(zip(folders, pool.map(lambda p: spark.read.parquet(p).schema, folders.values())))
    to = common_schema(schemas.values())
    groups: dict[tuple, list[str]] = {}
    for version, schema in schemas.items():
        groups.setdefault((schema.simpleString(), version if with_version else ""), []).append(version)
    out = None
    for vs in groups.values():
        schema = schemas[vs[0]]
        part = spark.read.schema(schema).parquet(*[folders[v] for v in vs])
        part = part.select(*[
            widened(F.col(f"`{f.name}`"), schema[f.name].dataType, f.dataType).alias(f.name) if f.name in schema.names
            else F.lit(None).cast(f.dataType).alias(f.name) for f in to.fields],
            *([F.lit(vs[0]).alias(VERSION_COLUMN)] if with_version else []))
        out = part if out is None else out.unionByName(part)
    return out


def read_all_versions(spark: SparkSession, table_dir: str,
                      with_version: bool = False) -> DataFrame:
    """The concatenation of every committed version.

    Raises ``FileNotFoundError`` naming the table when it has none.
    """
    found = committed(spark, table_dir)
    if not found:
        raise FileNotFoundError(f"table {table_dir.rstrip('/').rsplit('/', 1)[-1]!r} "
                                f"not found (no committed version in {table_dir})")
    return read_folders(spark, found, with_version)
