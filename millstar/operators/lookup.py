"""Surrogate-key resolution: one generic chain of left equi-joins.

A fact is its source table plus an ordered list of ``Lookup``s.  Each lookup
joins one dimension (or another silver table) on one or more key pairs and
brings selected columns under fact-side names; later lookups may use columns an
earlier one brought (snowflake hops such as machine -> line).

Semantics kept on purpose: left outer joins (unmatched -> NULL), NULL keys never
match, keys are not de-duplicated (k matches -> k rows).

Physical strategy, per lookup
-----------------------------
* **Broadcast behind a measured bound.**  A side is hinted as broadcast only
  after one aggregate measured it: at most ``max_rows`` rows, and its projected
  bytes (strings by their actual length) together with all sides hinted before
  it in this fact stay under ``BROADCAST_MAX_BYTES``, and what the driver holds
  while it builds them (``driver_bytes``) under ``session.broadcast_room``.  The
  measurement is kept per side.  The fact is then not shuffled and hot keys cost
  nothing.  Callers that build several facts at once let them share that room
  (``hinted_bytes``).
* **Growing sides are never hinted** (``Lookup.growing``: the order lookups).
  While the side measures below Spark's own broadcast threshold the join is left
  to Spark; past it the join is shuffled as below.
* **Bucketed alike, no exchange.**  Where the caller names a ``Colocation`` (fact
  and growing sides written in the same buckets of the key) and no key, NULL
  included, is hot, the lookup on that key is a plain join of the buckets.
* **Otherwise a shuffle join** (sort-merge; AQE may still switch it to a
  broadcast at runtime).  The join key is extended by a salt column so that no
  key can pile up in one reducer:

  - NULL keys cannot match, but hash partitioning would send every NULL-key row
    to one reducer; they get a salt spread over all partitions.
  - Hot keys -- a key that alone would fill more than ``HOT_REDUCER_SLACK``
    average reducers -- are spread over a number of buckets proportional to
    their share; only the side's rows of those keys are replicated.  They are
    found by exact, distributed counts: one probe of the source's key columns
    per fact, before any join.  Keys that earlier lookups bring are counted by
    joining those counts with the small sides, not by re-running the chain.

  Salts are a hash of the row, so recomputing a lost partition reproduces them
  (fact sources are de-duplicated silver tables, so no two rows share a hash
  because they are copies).
  Consecutive shuffle lookups on the same key share the salt column and the
  partitioning (one exchange of the fact, not two).
"""

from __future__ import annotations

import threading
import weakref
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.session import BROADCAST_ROW_BYTES, broadcast_room, shuffle_partitions

# Bounds on hinted sides: rows of one side (override per call with
# ``broadcast_max_rows``) and bytes of all sides hinted in one fact.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
PLAIN = -1
# A key is hot when its share exceeds this many average reducers; no floor, no cap.
HOT_REDUCER_SLACK = 2
HOT_OVERSPLIT = 4             # salt buckets per reducer-share of a key (spares hash collisions)

_sizes: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()
_locks: "weakref.WeakKeyDictionary[DataFrame, threading.Lock]" = weakref.WeakKeyDictionary()
_guard = threading.Lock()   # facts are built from several threads at once


@dataclass(frozen=True)
class Lookup:
    dim: str                                  # name in the dimension mapping
    on: tuple[tuple[str, str], ...]           # (fact column, dimension column) pairs
    take: tuple[tuple[str, str], ...]         # (dimension column, output name) pairs
    growing: bool = False                     # the side grows with the data: never hinted


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int


@dataclass(frozen=True)
class Colocation:
    """The fact and its growing sides lie in as many buckets of this column."""

    column: str
    buckets: int


def measured_size(dim: DataFrame, columns: Sequence[str]) -> SideSize:
    """Rows and bytes of ``columns`` of ``dim``, by one aggregate, remembered per DataFrame."""
    wanted = tuple(dict.fromkeys(columns))
    with _guard:
        known = _sizes.setdefault(dim, {})
        lock = _locks.setdefault(dim, threading.Lock())
    with lock:                                # one measurement per side, even across threads
        if wanted not in known:
            types = {f.name: f.dataType for f in dim.schema.fields}
            fixed, parts = 0, []
            for c in wanted:
                if isinstance(types[c], (T.StringType, T.BinaryType)):
                    parts.append(F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)))
                elif isinstance(types[c], (T.ArrayType, T.MapType, T.StructType)):
                    parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)))
                else:
                    fixed += 8
            varying = reduce(lambda a, b: a + b, parts, F.lit(0)).cast("long")
            row = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(varying).alias("b")).first()
            known[wanted] = SideSize(row["n"], row["n"] * fixed + (row["b"] or 0))
        return known[wanted]


def driver_bytes(size: SideSize) -> int:
    """What a broadcast side takes on the driver: its columns, and a row header and a place in the key map per row."""
    return size.bytes + size.rows * BROADCAST_ROW_BYTES


def _spark_threshold(dim: DataFrame) -> int:
    """Spark's own broadcast threshold in bytes (-1: never)."""
    value = dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = value.rstrip("b")
    return int(float(digits[:-1]) * units[digits[-1]]) if digits[-1:] in units else int(digits or 0)


def _fact_keys(lk: Lookup) -> tuple[str, ...]:
    return tuple(fc for fc, _ in lk.on)


def _sources(dim: DataFrame, lk: Lookup) -> list[str]:
    return [dc for _, dc in lk.on] + [src for src, _ in lk.take]


def key_counts(fact: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
               keys: tuple[str, ...]) -> DataFrame:
    """(keys..., __n): rows per key, by a partial + final aggregate over the source's key columns.

    Keys that an earlier lookup brings are counted by joining the counts of that
    lookup's own keys with its side.
    """
    later = [c for c in keys if c not in fact.columns]
    if not later:
        return fact.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("__n"))
    lk = next(x for x in lookups if later[0] in [out for _, out in x.take])
    outs = {out: src for src, out in lk.take if out in keys}
    needed = tuple(dict.fromkeys([*_fact_keys(lk), *[c for c in keys if c not in outs]]))
    side = dims[lk.dim].select(*[F.col(f"`{dc}`").alias(f"__p{j}") for j, (_, dc) in enumerate(lk.on)],
                               *[F.col(f"`{src}`").alias(out) for out, src in outs.items()])
    cond = [F.col(f"`{fc}`") == F.col(f"__p{j}") for j, fc in enumerate(_fact_keys(lk))]
    return (key_counts(fact, dims, lookups, needed).join(side, _all(cond), "left")
            .groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.sum("__n").alias("__n")))


def hot_keys(fact: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
             key_sets: Sequence[tuple[str, ...]], partitions: int) -> dict[tuple[str, ...], DataFrame]:
    """Hot keys of each key set with their salt bucket counts, as small DataFrames.

    Exact counts; at most ``partitions / HOT_REDUCER_SLACK`` keys of a set can be
    hot, which bounds what is collected.
    """
    total = fact.count()
    if not total or not key_sets:
        return {}
    parts, types = [], {}
    for i, keys in enumerate(key_sets):
        counted = key_counts(fact, dims, lookups, keys)
        types[keys] = {f.name: f.dataType for f in counted.schema.fields}
        parts.append(counted.where(_all([F.col(f"`{k}`").isNotNull() for k in keys])).select(
            F.lit(i).alias("__set"), F.array(*[F.col(f"`{k}`").cast("string") for k in keys]).alias("__key"), "__n"))
    every = reduce(DataFrame.unionByName, parts)
    found = every.where(F.col("__n") * F.lit(partitions) > F.lit(HOT_REDUCER_SLACK * total)).collect()
    spark, out = fact.sparkSession, {}
    for i, keys in enumerate(key_sets):
        rows = [(*r["__key"], max(2, -(-r["__n"] * partitions * HOT_OVERSPLIT // total)))
                for r in found if r["__set"] == i]
        if rows:
            schema = T.StructType([*[T.StructField(k, T.StringType()) for k in keys],
                                   T.StructField("__buckets", T.LongType())])
            out[keys] = spark.createDataFrame(rows, schema).select(
                *[F.col(f"`{k}`").cast(types[keys][k]).alias(k) for k in keys], "__buckets")
    return out


def _salted(fact: DataFrame, keys: Sequence[str], salt: str, partitions: int,
            hot: DataFrame | None) -> DataFrame:
    any_null = _any([F.col(f"`{k}`").isNull() for k in keys])
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    if hot is None:
        return fact.withColumn(salt, F.when(any_null, F.pmod(row_hash, F.lit(partitions)) + 1)
                               .otherwise(F.lit(0)))
    # Hot keys are at most partitions / HOT_REDUCER_SLACK rows.
    tagged = fact.join(F.broadcast(hot), list(keys), "left")
    value = (F.when(any_null, F.pmod(row_hash, F.lit(partitions)) + 1)
             .when(F.col("__buckets").isNotNull(), F.pmod(row_hash, F.col("__buckets")))
             .otherwise(F.lit(0)))
    return tagged.withColumn(salt, value).drop("__buckets").select(*fact.columns, salt)


def _any(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def strategies(dims: Mapping[str, DataFrame], lookups: Sequence[Lookup], max_rows: int) -> list[str]:
    """How each lookup will run: ``"hint"``, ``"spark"`` or ``"salt"``.

    ``max_rows`` 0 salts every lookup; ``PLAIN`` leaves every join to Spark unmeasured.
    """
    if max_rows == PLAIN:
        return ["spark"] * len(lookups)
    chosen, hinted, held, room = [], 0, 0, None
    for lk in lookups:
        dim = dims[lk.dim]
        if max_rows <= 0:
            chosen.append("salt")
            continue
        size = measured_size(dim, _sources(dim, lk))
        if size.rows > max_rows:
            chosen.append("salt")
        elif lk.growing:
            chosen.append("spark" if size.bytes <= _spark_threshold(dim) else "salt")
        else:
            room = broadcast_room(dim.sparkSession) if room is None else room
            fits = hinted + size.bytes <= BROADCAST_MAX_BYTES and held + driver_bytes(size) <= room
            if fits:
                hinted, held = hinted + size.bytes, held + driver_bytes(size)
            chosen.append("hint" if fits else "salt")
    return chosen


def hinted_bytes(dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
                 max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> int:
    """What the hinted sides of one fact take on the driver together."""
    return sum(driver_bytes(measured_size(dims[lk.dim], _sources(dims[lk.dim], lk)))
               for lk, how in zip(lookups, strategies(dims, lookups, max_rows)) if how == "hint")


def evenly_keyed(fact: DataFrame, where: Colocation) -> bool:
    """No key, NULL included, fills more than HOT_REDUCER_SLACK average buckets.

    Counted by the keys' hashes: a grouping by the bucketed column would read each bucket, hot ones too, in one task.
    """
    counts = fact.groupBy(F.xxhash64(F.col(f"`{where.column}`"))).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n").alias("n"), F.sum("n").alias("total")).first()
    return not most["total"] or most["n"] * where.buckets <= HOT_REDUCER_SLACK * most["total"]


def resolve(fact: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup],
            broadcast_max_rows: int | None = None, colocated: Colocation | None = None) -> DataFrame:
    """Apply ``lookups`` in order as left joins."""
    max_rows = DEFAULT_BROADCAST_MAX_ROWS if broadcast_max_rows is None else broadcast_max_rows
    partitions = shuffle_partitions(fact.sparkSession)
    plan = strategies(dims, lookups, max_rows)
    if colocated is not None:
        bucketed = [how == "salt" and lk.growing and _fact_keys(lk) == (colocated.column,)
                    for lk, how in zip(lookups, plan)]
        if any(bucketed) and evenly_keyed(fact, colocated):
            plan = ["spark" if b else how for b, how in zip(bucketed, plan)]
    salted_sets = list(dict.fromkeys(_fact_keys(lk) for lk, how in zip(lookups, plan) if how == "salt"))
    hot_by_keys = hot_keys(fact, dims, lookups, salted_sets, partitions) if salted_sets else {}
    with_salt: set[str] = set()
    for i, (lk, how) in enumerate(zip(lookups, plan)):
        dim = dims[lk.dim]
        key_names = [f"__lk{i}_k{j}" for j in range(len(lk.on))]
        side = dim.select(
            *[F.col(f"`{dc}`").alias(kn) for (_, dc), kn in zip(lk.on, key_names)],
            *[F.col(f"`{src}`").alias(dst) for src, dst in lk.take])
        fact_keys = list(_fact_keys(lk))
        if how != "salt":
            cond = [fact[fc] == side[kn] for fc, kn in zip(fact_keys, key_names)]
            fact = fact.join(F.broadcast(side) if how == "hint" else side, _all(cond), "left").drop(*key_names)
            continue
        salt, hot = f"__salt_{'_'.join(fact_keys)}", hot_by_keys.get(tuple(fact_keys))
        if salt not in with_salt:
            with_salt.add(salt)
            fact = _salted(fact, fact_keys, salt, partitions, hot)
        if hot is None:
            side = side.withColumn("__dim_salt", F.lit(0))
        else:
            # Replicate only the hot keys' dimension rows, once per salt bucket.
            hot_side = hot.select(*[F.col(f"`{fc}`").alias(kn)
                                    for fc, kn in zip(fact_keys, key_names)], "__buckets")
            side = (side.join(F.broadcast(hot_side), key_names, "left")
                    .withColumn("__dim_salt", F.explode(F.sequence(
                        F.lit(0), F.coalesce(F.col("__buckets"), F.lit(1)) - 1)))
                    .drop("__buckets"))
        cond = [fact[fc] == side[kn] for fc, kn in zip(fact_keys, key_names)]
        cond.append(fact[salt] == side["__dim_salt"])
        fact = fact.join(side, _all(cond), "left").drop(*key_names, "__dim_salt")
    return fact.drop(*[c for c in fact.columns if c.startswith("__salt_")])
