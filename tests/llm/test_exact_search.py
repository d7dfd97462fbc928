"""Exact search against all inner products."""
from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import exact_search as es

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=3, k=5):
    kept = [(key, [math.floor(256 * x) for x in v]) for key, v, _ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (key, v) in enumerate(kept):
        if key is None or key % every:
            continue
        hits = sorted((-sum(a * b for a, b in zip(v, w)), other is None, other or 0)
                      for j, (other, w) in enumerate(kept) if j != i and len(w) == len(v))
        out += [(key, r + 1, None if absent else other, -s) for r, (s, absent, other) in enumerate(hits[:k])]
    return sorted(out, key=str)


def found(spark, rows, every=3, k=5):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, es.top_k(df, F.col("vec_id") % every == 0, k=k).collect()), key=str)


def cloud(seed, n=200, dims=12):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dims)) / 3
    return [(i, (centres[i % 6] + rnd.normal(size=dims) * rnd.choice([0, .01, .3])).tolist(), 0) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 12, 64])
def test_equals_brute_force_over_many_blocks(spark, monkeypatch, dims):
    monkeypatch.setattr(es, "ROW_BLOCK", 32)
    monkeypatch.setattr(es, "QUERY_BLOCK", 16)
    rows = cloud(dims, dims=dims)
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(es, "ROW_BLOCK", 8)
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([-.5, 0.0, .25]) for _ in range(4)], 0) for i in range(60)]   # many ties
    rows += [rows[0], rows[0], rows[3], (6, [1.0, 1.0, 1.0, 1.0], 1), (None, [.25] * 4, 0), (None, [.25] * 4, 0),
             (300, None, 0), (303, [1.0, None, 0.0, 0.0], 0), (306, [float("nan")] * 4, 0),
             (309, [float("inf")] * 4, 0), (312, [], 0), (315, [], 0), (318, [.5, .5], 0), (321, [.25, -1e-9], 0),
             (324, [1e4] * 3, 0)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:4], every=1) == brute(rows[:4], every=1)  # fewer than k others
    assert found(spark, []) == []


def test_bounds_never_fall_below_the_product():
    rnd = np.random.default_rng(2)
    for dims in (2, 5, 33):
        q, x = (es.Resolutions(rnd.integers(-400, 400, (40, dims))) for _ in range(2))
        exact = q.vectors @ x.vectors.T
        coarse = None
        for level in q.segments:
            bound = q.level(level) @ x.level(level).T
            assert (bound >= exact - 1e-6).all()
            assert coarse is None or level & (level - 1) or dims % level or bound.sum() <= coarse + 1e-3
            coarse = bound.sum()


def test_large_components_stay_exact(spark):
    rows = [(i, [float(900_000 + i), float(-800_000 + 7 * i), 1.0], 0) for i in range(12)]
    assert found(spark, rows) == brute(rows)


def test_clashing_columns(spark):
    rows = cloud(5, n=40)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("rid", "key", "dims", "vector", "asks", "rank", "score"):
        df = df.withColumn(name, F.lit(1))
    got = sorted(map(tuple, es.top_k(df, F.col("vec_id") % 3 == 0).collect()), key=str)
    assert got == brute(rows)
