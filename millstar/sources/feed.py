"""Which bronze versions a table consists of, and which of them silver has already taken.

A version is either a *full* extraction, which replaces what was landed before it, or an *increment*, which adds to it
(the streaming landing writes increments, one per batch).  A table's live versions are its newest full extraction and
every increment after it; without a full one, all increments.  An increment is marked before its data is committed, so a
committed increment is never mistaken for a full extraction.

The consumption log stands beside silver: ``<silver table>/_sources/<silver version>.json`` maps each bronze version that
went into a silver version to the folder that was read.  What is live and not in the newest log is pending, whatever
batch, second or name it came in with; a version that was written again counts as pending too.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from millstar.sources import fs, snapshots


def mark_increment(spark: SparkSession, table_dir: str, version: str) -> None:
    fs.create_empty(spark, f"{table_dir.rstrip('/')}/_increments/{version}")


def increments(spark: SparkSession, table_dir: str) -> set[str]:
    return {p.rsplit("/", 1)[-1] for p in fs.glob_names(spark, f"{table_dir.rstrip('/')}/_increments/*")}


def live(spark: SparkSession, table_dir: str) -> dict[str, str]:
    """Version -> folder of everything the table consists of now, oldest first."""
    found = snapshots.committed(spark, table_dir)
    added = increments(spark, table_dir)
    full = [v for v in found if v not in added]
    return {v: p for v, p in found.items() if not full or v == full[-1] or v in added and v > full[-1]}


def read_live(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """All rows of the live versions (schemas and types merged), or None when there are none."""
    found = live(spark, table_dir)
    return snapshots.read_folders(spark, found) if found else None


def _log(silver_dir: str, version: str) -> str:
    return f"{silver_dir.rstrip('/')}/_sources/{version}.json"


def record(spark: SparkSession, silver_dir: str, version: str, sources: dict[str, str]) -> None:
    """Written before the silver version is committed; a log without its version is never read."""
    fs.write_text(spark, _log(silver_dir, version), json.dumps(sources, sort_keys=True))


def consumed(spark: SparkSession, silver_dir: str) -> dict[str, str]:
    """Bronze versions (and their folders) in the newest silver version; empty when there is none or no log of it."""
    version = snapshots.latest_version(spark, silver_dir)
    text = fs.read_text(spark, _log(silver_dir, version)) if version else None
    return json.loads(text) if text else {}


def pending(spark: SparkSession, bronze_dir: str, silver_dir: str) -> dict[str, str]:
    """Live bronze versions that the newest silver version has not taken, oldest first."""
    taken = consumed(spark, silver_dir)
    return {v: p for v, p in live(spark, bronze_dir).items() if taken.get(v) != p}
