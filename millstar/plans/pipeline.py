"""Pipeline jobs (P1-P5): land -> clean -> dimensions -> facts -> export.

Each layer is written, then read back from storage before the next layer uses
it.  That cuts lineage (a lost executor recomputes from the written layer, not
from bronze), makes every consumer share one cleaning pass instead of
recomputing it, and lets the lookups measure each dimension from its files:
small ones are broadcast, the order tables are left to Spark or shuffled.

Writes inside a layer are independent jobs; ``parallel_writes`` submits them
from a thread pool so small tables do not leave the cluster idle.  Facts written
at once share the room that the driver has for broadcast sides (``Room``).
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millstar.operators import cleaning, dimensions, facts
from millstar.operators.lookup import Colocation, hinted_bytes
from millstar.plans.incremental import grown_silver
from millstar.schemas import BRONZE_SCHEMAS, TABLE_IDS
from millstar.sinks.base import Sink
from millstar.sinks.export import begin_run, export_tables, finish_run
from millstar.session import broadcast_room, scratch_path
from millstar.sources import buckets, feed, payload, snapshots


# The tables that F1 and F2 join on the order id.
ORDER_ID = "order_id"
BY_ORDER = ("production_orders", "production_output", "quality_checks", "dim_order")
# A bucket is one task's work: beyond this many rows of the largest table in one, their number doubles.
ROWS_PER_BUCKET = 2_000_000


@dataclass(frozen=True)
class Layout:
    bronze: str
    silver: str
    gold: str
    exports: str | None = None

    @classmethod
    def under(cls, root: str) -> "Layout":
        r = root.rstrip("/")
        return cls(f"{r}/bronze", f"{r}/silver", f"{r}/gold", f"{r}/exports")


@dataclass
class TransformResult:
    version: str
    silver: dict[str, DataFrame] = field(default_factory=dict)
    dimensions: dict[str, DataFrame] = field(default_factory=dict)
    facts: dict[str, DataFrame] = field(default_factory=dict)
    skipped_facts: list[str] = field(default_factory=list)
    written: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def _version(when: dt.datetime | str | None) -> str:
    return when if isinstance(when, str) else snapshots.stamp(when)


class Room:
    """Bytes shared by work done at once; work that needs more than all of them takes them all."""

    def __init__(self, size: int):
        self.size, self.taken, self._changed = size, 0, threading.Condition()

    @contextmanager
    def taking(self, n: int) -> Iterator[None]:
        n = min(n, self.size)
        with self._changed:
            self._changed.wait_for(lambda: self.taken + n <= self.size)
            self.taken += n
        try:
            yield
        finally:
            with self._changed:
                self.taken -= n
                self._changed.notify_all()


def _write_layer(spark: SparkSession, frames: Mapping[str, Callable[[], DataFrame]], root: str,
                 version: str, parallel: int, seconds: dict[str, float] | None = None,
                 order_buckets: int | None = None, counted: Mapping[str, DataFrame] | None = None,
                 broadcasts: Mapping[str, Callable[[], int]] | None = None
                 ) -> tuple[dict[str, str], dict[str, DataFrame]]:
    """Build (lazily, in the worker) and write each table as a new version; read it back.

    ``broadcasts`` measures what a table's broadcast sides take on the driver: tables wait until there is room for them.
    With ``order_buckets`` the tables of BY_ORDER are written in that many buckets of the order id; ``counted`` may
    name frames in which their frequent order ids are cheaper to find.
    """
    room = Room(broadcast_room(spark))

    def one(item):
        name, build = item
        t0 = time.perf_counter()
        with room.taking(broadcasts[name]() if broadcasts else 0):
            path, back = write(name, build())
        if seconds is not None:
            seconds[name] = time.perf_counter() - t0
        return name, path, back

    def write(name, df):
        # Read back with the schema we just wrote: no footer inference per table.
        if order_buckets and name in BY_ORDER and ORDER_ID in df.columns:
            path = snapshots.write_snapshot(df, f"{root.rstrip('/')}/{name}", version, lambda rows, folder: buckets.write(
                rows, folder, ORDER_ID, order_buckets, (counted or {}).get(name)))
            back = buckets.read(spark, path, df.schema)
        else:
            path = snapshots.write_snapshot(df, f"{root.rstrip('/')}/{name}", version)
            back = spark.read.schema(df.schema).parquet(path)
        return path, back

    items = list(frames.items())
    if parallel > 1 and len(items) > 1:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            done = list(pool.map(one, items))
    else:
        done = list(map(one, items))
    return {n: p for n, p, _ in done}, {n: b for n, _, b in done}


def bucket_count(spark: SparkSession, layout: Layout, least: int) -> int:
    """``least`` buckets, doubled until the largest live order table has ROWS_PER_BUCKET rows in each (counted by footers)."""
    found = [feed.live(spark, f"{layout.bronze}/{t}") for t in BY_ORDER if t in TABLE_IDS]
    most, n = max((snapshots.read_folders(spark, f).count() for f in found if f), default=0), least
    while n * ROWS_PER_BUCKET < most:
        n *= 2
    return n


def clean_all(spark: SparkSession, layout: Layout, version: str,
              parallel_writes: int = 4, declared_types: bool = True,
              seconds: dict[str, float] | None = None, only_pending: bool = False,
              incremental: bool = False, order_buckets: int | None = None) -> tuple[dict, dict]:
    """The live bronze versions of each registered table -> one cleaned silver version.

    Live are the newest full extraction and all increments after it (``sources.feed``); they are cleaned together in
    one pass, so repeats across batches go like repeats within one.  The versions taken are logged beside silver.
    ``incremental`` compares and cleans new rows only (``plans.incremental``), with the same result.
    With ``only_pending`` a table whose live versions are all in its newest silver version is not written again.
    """
    cleaned, kept, counted = {}, {}, {}
    for table in TABLE_IDS:
        table_dir, silver_dir = f"{layout.bronze}/{table}", f"{layout.silver}/{table}"
        found = feed.live(spark, table_dir)   # listings; read no data
        if not found:
            continue
        if only_pending and found == feed.consumed(spark, silver_dir):
            written = snapshots.committed(spark, silver_dir)
            kept[table] = buckets.read(spark, written[max(written)])
            continue
        if order_buckets and table in BY_ORDER:
            raw = snapshots.read_folders(spark, found)
            if ORDER_ID in raw.columns:
                counted[table] = raw.select(ORDER_ID)

        def build(t=table, folders=found, table_dir=table_dir, silver_dir=silver_dir):
            if incremental:
                return grown_silver(spark, table_dir, silver_dir, t, version, declared_types)
            feed.record(spark, silver_dir, version, folders)
            return cleaning.clean_table(snapshots.read_folders(spark, folders), t, declared_types, "few")
        cleaned[table] = build
    paths, frames = _write_layer(spark, cleaned, layout.silver, version, parallel_writes, seconds, order_buckets,
                                 counted)
    return paths, {**kept, **frames}


def build_dimensions(spark: SparkSession, silver: Mapping[str, DataFrame], layout: Layout,
                     version: str, date_range: tuple[dt.date, dt.date] | None = None,
                     parallel_writes: int = 4,
                     seconds: dict[str, float] | None = None,
                     order_buckets: int | None = None) -> tuple[dict, dict]:
    """Calendar and hours always; every other dimension when its source exists."""
    start, end = date_range or (dimensions.DEFAULT_START, dimensions.DEFAULT_END)
    dims: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: dimensions.build_dim_date(spark, start, end),
        "dim_time": lambda: dimensions.build_dim_time(spark),
    }
    for name, cfg in dimensions.KEYED_COPIES.items():
        if cfg.table in silver:
            dims[name] = (lambda c=cfg: dimensions.keyed_copy(silver[c.table], c))
    derived: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
        "dim_product": ("production_orders", dimensions.build_dim_product),
        "dim_alert_type": ("alerts", dimensions.build_dim_alert_type),
        "dim_maintenance_type": ("maintenance_logs", dimensions.build_dim_maintenance_type),
    }
    for name, (source, build) in derived.items():
        if source in silver:
            dims[name] = (lambda b=build, s=source: b(silver[s]))
    return _write_layer(spark, dims, layout.gold, version, parallel_writes, seconds, order_buckets)


def build_facts(spark: SparkSession, silver: Mapping[str, DataFrame],
                dims: Mapping[str, DataFrame], layout: Layout, version: str,
                parallel_writes: int = 4,
                seconds: dict[str, float] | None = None,
                sk_from: Mapping[str, str] | None = None,
                dense_keys: bool = False, order_buckets: int | None = None) -> tuple[dict, dict, list[str]]:
    """Each fact whose inputs all exist; the others are skipped and listed.

    ``sk_from`` maps a fact to a source column to use as its key (reproducible)
    instead of ``monotonically_increasing_id``; fact_sensor_readings always uses
    the reading id.  With ``dense_keys`` the other facts number their rows 1..N in
    the order of their columns, the same after every retry and rerun.
    """
    sk_from = dict(sk_from or {})
    built, skipped, broadcasts = {}, [], {}
    for name, (tables, dim_names) in facts.FACT_REQUIREMENTS.items():
        if not all(t in silver for t in tables) or not all(d in dims for d in dim_names):
            skipped.append(name)
            continue
        inputs = {d: dims[d] for d in dim_names}
        inputs.update({t: silver[t] for t in tables[1:]})
        opts = {"sk_from": sk_from[name]} if name in sk_from else {}
        if order_buckets and ORDER_ID in silver[tables[0]].columns and name in ("fact_production", "fact_quality"):
            opts["colocated"] = Colocation(ORDER_ID, order_buckets)
        dense = dense_keys and "sk_from" not in opts and name != "fact_sensor_readings"

        def build(n=name, s=silver[tables[0]], i=inputs, o=opts, dense=dense):
            fact = facts.FACT_BUILDERS[n](s, i, **o)
            return facts.with_dense_key(fact, fact.columns[0]) if dense else fact
        built[name] = build
        broadcasts[name] = (lambda i=inputs, n=name: hinted_bytes(i, facts.FACT_LOOKUPS[n]))
    paths, frames = _write_layer(spark, built, layout.gold, version, parallel_writes, seconds, broadcasts=broadcasts)
    return paths, frames, skipped


def transform(spark: SparkSession, layout: Layout, when: dt.datetime | str | None = None,
              date_range: tuple[dt.date, dt.date] | None = None,
              parallel_writes: int = 4,
              fact_sk_from: Mapping[str, str] | None = None,
              declared_types: bool = True, only_pending: bool = False,
              dense_fact_keys: bool = False, incremental: bool = False,
              order_buckets: int | None = None) -> TransformResult:
    """Bronze -> silver -> gold, one version stamp for the whole run.

    The run is opened before gold is touched and closed by its manifest (table ->
    version) when the last layer is written; export leaves out what open runs wrote.
    ``only_pending``, ``incremental``: see ``clean_all``; ``dense_fact_keys``: see ``build_facts``.
    ``order_buckets`` lays the order tables and the sources of F1 and F2 out in that many buckets of the order id, more
    where they are large (``bucket_count``, ``sources.buckets``): their order lookups then shuffle neither fact nor side, however large both are.  It costs one
    exchange of each table when it is written, so it pays where a written layer feeds several builds.

    ``result.seconds`` holds the write time of every table (exact per table
    when ``parallel_writes == 1``) and of each layer.
    """
    result = TransformResult(_version(when))
    secs = result.seconds
    t0 = time.perf_counter()
    if order_buckets:
        order_buckets = bucket_count(spark, layout, order_buckets)
    paths, result.silver = clean_all(spark, layout, result.version, parallel_writes,
                                     declared_types, seconds=secs, only_pending=only_pending,
                                     incremental=incremental, order_buckets=order_buckets)
    result.written.update({f"silver/{k}": v for k, v in paths.items()})
    t1 = time.perf_counter()
    begin_run(spark, layout.gold, result.version)
    paths, result.dimensions = build_dimensions(spark, result.silver, layout, result.version,
                                                date_range, parallel_writes, seconds=secs,
                                                order_buckets=order_buckets)
    result.written.update({f"gold/{k}": v for k, v in paths.items()})
    t2 = time.perf_counter()
    paths, result.facts, result.skipped_facts = build_facts(
        spark, result.silver, result.dimensions, layout, result.version,
        parallel_writes, seconds=secs, sk_from=fact_sk_from, dense_keys=dense_fact_keys, order_buckets=order_buckets)
    result.written.update({f"gold/{k}": v for k, v in paths.items()})
    t3 = time.perf_counter()
    finish_run(spark, layout.gold, result.version,
               {t: result.version for t in (*result.dimensions, *result.facts)})
    secs.update({"layer_silver": t1 - t0, "layer_dimensions": t2 - t1, "layer_facts": t3 - t2})
    return result


def bronze_payload_schema() -> T.StructType:
    """Payload type carrying every registered bronze table with its declared types."""
    return payload.payload_schema({t: BRONZE_SCHEMAS[t] for t in TABLE_IDS})


def run_pipeline(spark: SparkSession, landed: str | list[str], layout: Layout,
                 when: dt.datetime | str | None = None, sink: Sink | None = None,
                 multi_line: bool = True, payload_types: str = "open",
                 export_versions: str = "latest", parallel_writes: int = 4,
                 declared_types: bool = True,
                 fact_sk_from: Mapping[str, str] | None = None) -> dict:
    """P5: land the payload(s) -> transform -> export every gold table.

    ``payload_types``: ``"open"`` keeps every table and column, with declared types
    where declared; ``"declared"`` reads declared columns only, without an
    inference pass; ``"inferred"`` takes all types from the data.
    """
    version = _version(when)
    landed, multi_line = payload.splittable(spark, landed, multi_line, scratch_path(spark, "pages"))
    schema = payload_types_of(spark, landed, payload_types, multi_line)
    landed_tables = payload.land_payload(spark, landed, layout.bronze, version, schema, multi_line,
                                         parallel_writes=parallel_writes)
    result = transform(spark, layout, version, parallel_writes=parallel_writes,
                       fact_sk_from=fact_sk_from, declared_types=declared_types)
    exported = {}
    if sink is not None:
        exported = export_tables(spark, layout.gold, sink, versions=export_versions,
                                 parallel_writes=parallel_writes)
    return {"version": version, "landed": landed_tables, "transform": result,
            "exported": exported}


def payload_types_of(spark: SparkSession, landed: str | list[str], kind: str,
                     multi_line: bool = True) -> T.StructType | None:
    """The schema ``land_payload`` gets for ``"open"``, ``"declared"`` or ``"inferred"`` types."""
    if kind == "open":
        return payload.open_schema(spark, landed, BRONZE_SCHEMAS, multi_line)
    if kind == "declared":
        return bronze_payload_schema()
    if kind == "inferred":
        return None
    raise ValueError("payload types are 'open', 'declared' or 'inferred'")
