"""Mixing sources to target weights by pivotal dependent rounding.

Targets.  Sources in code-point order (null last) carry the weights in turn;
they share ``share`` times all words, no source above ``cap`` times its own
words, the excess being reshared by weight until none is above.  One row per
source holds this state; the driver sees only three sums per round.

Copies.  Every document of a source should be taken ``target / source words``
times.  The whole part is certain; the fractional parts are rounded in pairs:
mass (probability times words) moves from one document to the other, in a
random direction, until one of the two becomes integral.  The words taken stay
equal to the target at every step, and each document's expected copies stay
unchanged.  Documents are dealt by hash into chunks of about ``chunk_rows``
within their source, so a source that holds a third of all rows is spread over
as many tasks as it needs.  Each chunk ends with at most one fractional
document; these residuals meet in groups of ``FAN_IN`` chunks, level by level,
until one is left per source, which goes to the nearer side.  The words taken
from a source thus differ from its target by at most half a document.

Every draw is seeded by source, level and chunk and every chunk is sorted, so
reruns agree whatever the partitioning.

Defined results: null text has size 0; documents without words take no part in
the rounding, add nothing and are kept once; null sources form one source;
repeated rows are rounded one by one; an empty table gives an empty result;
other columns pass through.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import WORD, col, fresh, written
from millstar.operators.dense_key import dense_key

WEIGHTS = (3, 1, 2)
CHUNK_ROWS = 4096
FAN_IN = 256
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """(source, n, source_size, target) per source from units (source, size, rows); n counts units."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    per = per.withColumn("is_null", F.col("source").isNull())
    per = dense_key(per, ["is_null", "source"], "place", sk_type=T.LongType())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = written(per.withColumn("weight", weight), "sources")
    total, all_weights = per.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (total or 0)
    level = goal / all_weights if all_weights else 0.0
    while True:
        capped = level * F.col("weight") > cap * F.col("source_size")
        taken, open_weight = per.agg(F.sum(F.when(capped, F.col("source_size"))),
                                     F.sum(F.when(~capped, F.col("weight")))).first()
        raised = (goal - cap * (taken or 0)) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.lit(level) * F.col("weight"), F.lit(float(cap)) * F.col("source_size"))
    return per.select("source", "n", "source_size", target.cast("double").alias("target"))


def pivotal(sizes, probabilities, draw: random.Random) -> np.ndarray:
    """Round in pairs, keeping sum(size * probability); at most one entry stays fractional."""
    p = [0.0 if x < _EPS else 1.0 if x > 1 - _EPS else float(x) for x in probabilities]
    held = -1
    for i, x in enumerate(p):
        if x in (0.0, 1.0):
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        sa, sb = float(sizes[a]), float(sizes[b])
        up = min(sa * (1 - p[a]), sb * p[b])       # mass that can move from b to a
        down = min(sa * p[a], sb * (1 - p[b]))     # and from a to b
        move = up if draw.random() * (up + down) < down else -down
        for k, q in ((a, p[a] + move / sa), (b, p[b] - move / sb)):
            p[k] = 0.0 if q < _EPS else 1.0 if q > 1 - _EPS else q
        held = a if 0 < p[a] < 1 else b if 0 < p[b] < 1 else -1
    return np.array(p)


def _draw(seed: int, source, level: int, chunk: int) -> random.Random:
    return random.Random(f"{seed}|{source!r}|{level}|{chunk}")


def _name(pdf: pd.DataFrame):
    source = pdf["source"].iloc[0]
    return None if pd.isna(source) else source


def _round_sorted(pdf: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """Largest first, so that what stays fractional at the end tends to be small."""
    pdf = pdf.sort_values(["size", "tie"], ascending=[False, True], kind="stable")
    p = pivotal(pdf["size"].to_numpy(), pdf["p"].to_numpy(),
                _draw(seed, _name(pdf), level, int(pdf["chunk"].iloc[0])))
    return pdf.assign(p=p)


def _rounder(names: list[str], seed: int, level: int, last: bool = False):
    """Rounds one chunk; at the last level what is still fractional goes to the nearer side."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        done = _round_sorted(pdf, seed, level)
        if last:
            done["p"] = (done["p"] >= 0.5).astype(float)
        return done[names]
    return run


def mix_sources(df: DataFrame, source: str = "source", text: str = "text",
                key: str = "doc_id", out: str = "mix", keep: list[str] | None = None,
                weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
                seed: int = 0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Columns ``keep`` (default all) of ``df`` plus struct ``out``: size, source_size, target,
    copies, taken (= copies * size).  The kept columns are shuffled once.
    """
    out = fresh(df, out)
    # Rows equal in source, size and hash of key and text form one unit of ``rows`` rows.
    keyed = df.select(
        col(source).alias("source"),
        F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), col(key), col(text)).alias("tie"),
        F.struct(*[col(c) for c in (keep or df.columns)]).alias("body"))
    same = ["source", "size", "tie"]
    units = written(keyed.groupBy(*same).agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    targets = written(source_targets(units, weights, share, cap), "mix-targets")
    plan = targets.select(
        F.col("source").alias("of"), "source_size", "target",
        F.greatest(F.lit(1), F.ceil(F.col("n") / chunk_rows)).cast("long").alias("chunks"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
         .otherwise(F.lit(0.0)).alias("rate"))
    wanted = F.col("rows") * F.col("rate")
    dealt = (units.where("size > 0").join(plan, F.col("source").eqNullSafe(F.col("of")))
             .select(*same, "rows", F.pmod("tie", "chunks").alias("chunk"),
                     F.floor(wanted + F.lit(_EPS)).cast("long").alias("whole"),
                     F.greatest(F.lit(0.0), wanted - F.floor(wanted + F.lit(_EPS))).alias("p")))
    schema = "source string, size long, tie long, rows long, chunk long, whole long, p double"
    names = [c.split()[0] for c in schema.split(", ")]

    fractional = F.col("p").between(F.lit(_EPS), F.lit(1 - _EPS))
    step = written(dealt.groupBy("source", "chunk").applyInPandas(_rounder(names, seed, 0), schema), "mix-level0")
    settled = step.where(~fractional)
    width = math.ceil((targets.agg(F.max("n")).first()[0] or 0) / chunk_rows)
    level, last = 0, False
    while not last:
        level, width = level + 1, math.ceil(width / FAN_IN)
        last = width <= 1
        up = F.lit(0) if last else F.floor(F.col("chunk") / FAN_IN)
        step = written(step.where(fractional).withColumn("chunk", up.cast("long"))
                       .groupBy("source", "chunk")
                       .applyInPandas(_rounder(names, seed, level, last), schema), f"mix-level{level}")
        settled = settled.unionByName(step.where(~fractional))

    # A unit's copies go round its rows: the first rows get one more where they don't divide evenly.
    copies_of = settled.select(F.col("source").alias("s2"), F.col("size").alias("z2"),
                               F.col("tie").alias("t2"), "rows",
                               (F.col("whole") + F.round("p").cast("long")).alias("all_copies"))
    numbered = keyed.withColumn(
        "nth", F.row_number().over(Window.partitionBy(*same).orderBy("tie")))
    joined = (numbered.join(plan, F.col("source").eqNullSafe(F.col("of")))
              .join(copies_of, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2"))
                    & (F.col("tie") == F.col("t2")), "left"))
    each = F.floor(F.col("all_copies") / F.col("rows"))
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        each + (F.col("nth") <= F.col("all_copies") - each * F.col("rows")).cast("long")).cast("long")
    return joined.select("body.*", F.struct(
        "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken")).alias(out))


def repeated(df: DataFrame, mix: str = "mix") -> DataFrame:
    """Each row as often as its copies say (none for 0), without the ``mix`` column."""
    at = fresh(df, "copy")
    times = F.array_repeat(F.lit(1), col(mix)["copies"].cast("int"))
    return df.withColumn(at, F.explode(times)).drop(at, mix)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix_sources(docs.select("doc_id", "source", "text"), keep=["doc_id"])
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


QUERIES = {"op4_mixing": op4_mixing}
ORACLE: dict[str, str] = {}
