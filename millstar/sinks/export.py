"""Export gold tables through a sink.

``versions="latest"`` exports every table's newest committed version, except those that a run in progress (or one that
failed half-way) wrote: a run is opened under ``_runs/open`` before it touches gold and closed by its manifest
``_runs/done/<version>.json``, which maps each table it wrote to the version.  So the tables of one run appear together,
a table that the run skipped or that was written on its own keeps its own newest version, and no table is left out.  A
table that only an unfinished run has written is exported as it is, and so is a folder of Parquet files that holds no
versions.
``versions="all"`` exports the concatenation of every version, columns and types merged.
``run=<version>`` exports the tables as that run's manifest names them.
Every requested table is resolved before anything is written, so one missing
name writes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from millstar.sinks.base import Sink
from millstar.sources import catalog, fs, snapshots


def _runs(gold_root: str) -> str:
    return f"{gold_root.rstrip('/')}/_runs"


def begin_run(spark: SparkSession, gold_root: str, version: str) -> None:
    """What ``version`` writes from now on is not exported until the run is finished."""
    fs.create_empty(spark, f"{_runs(gold_root)}/open/{version}")


def finish_run(spark: SparkSession, gold_root: str, version: str, tables: Mapping[str, str]) -> None:
    """Commit the run's manifest: all its tables (table -> version) are written."""
    fs.write_text(spark, f"{_runs(gold_root)}/done/{version}.json", json.dumps(dict(tables), sort_keys=True))


def finished_runs(spark: SparkSession, gold_root: str) -> list[str]:
    """Runs with a manifest, oldest first."""
    found = fs.glob_names(spark, f"{_runs(gold_root)}/done/*.json")
    return sorted(p.rsplit("/", 1)[-1].removesuffix(".json") for p in found)


def latest_run(spark: SparkSession, gold_root: str) -> str | None:
    """The newest finished run, or None."""
    done = finished_runs(spark, gold_root)
    return done[-1] if done else None


def manifest(spark: SparkSession, gold_root: str, version: str) -> dict[str, str]:
    """table -> version of a finished run."""
    text = fs.read_text(spark, f"{_runs(gold_root)}/done/{version}.json")
    if text is None:
        raise FileNotFoundError(f"no finished run {version!r} in {gold_root}")
    return json.loads(text)


def unfinished_runs(spark: SparkSession, gold_root: str) -> set[str]:
    opened = {p.rsplit("/", 1)[-1] for p in fs.glob_names(spark, f"{_runs(gold_root)}/open/*")}
    return opened - set(finished_runs(spark, gold_root))


def _resolve(spark: SparkSession, root: str, table: str, versions: str, unfinished: set[str],
             pinned: Mapping[str, str]) -> dict[str, str]:
    """The version folders to export (listings; no data is read)."""
    if versions not in ("latest", "all"):
        raise ValueError("versions must be 'latest' or 'all'")
    table_dir = f"{root.rstrip('/')}/{table}"
    found = snapshots.committed(spark, table_dir)
    if table in pinned:
        if pinned[table] not in found:
            raise FileNotFoundError(f"version {pinned[table]!r} of table {table!r} not found in {root}")
        return {pinned[table]: found[pinned[table]]}
    if not found:
        if table in catalog.list_tables(spark, root) and not catalog.has_versions(spark, table_dir):
            return {"": table_dir}
        raise FileNotFoundError(f"table {table!r} not found in {root}")
    if versions == "all":
        return found
    newest = max([v for v in found if v not in unfinished] or found)
    return {newest: found[newest]}


def _tables(spark: SparkSession, gold_root: str) -> list[str]:
    """Every table but those whose only version was never committed."""
    root = gold_root.rstrip("/")
    return [t for t in catalog.list_tables(spark, root)
            if not catalog.has_versions(spark, f"{root}/{t}") or snapshots.versions(spark, f"{root}/{t}")]


def export_tables(spark: SparkSession, gold_root: str, sink: Sink,
                  tables: Sequence[str] | None = None, versions: str = "latest",
                  parallel_writes: int = 1, run: str | None = None) -> dict[str, str]:
    """Export ``tables`` (default: every table under ``gold_root``, or of the ``run``).

    Every table is resolved before anything is written, so one missing name
    writes nothing; each table is then read and written in its own job
    (``parallel_writes`` of them at a time).
    """
    pinned = manifest(spark, gold_root, run) if run is not None else {}
    names = list(tables) if tables is not None else sorted(pinned) or _tables(spark, gold_root)
    unfinished = unfinished_runs(spark, gold_root)
    resolved = {t: _resolve(spark, gold_root, t, versions, unfinished, pinned) for t in names}

    def one(name):
        return name, sink.write(snapshots.read_folders(spark, resolved[name]), name)

    if parallel_writes > 1 and len(names) > 1:
        with ThreadPoolExecutor(max_workers=parallel_writes) as pool:
            return dict(pool.map(one, names))
    return dict(map(one, names))


def export_table(spark: SparkSession, gold_root: str, table: str, sink: Sink,
                 versions: str = "latest") -> str:
    return export_tables(spark, gold_root, sink, [table], versions)[table]
