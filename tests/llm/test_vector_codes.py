"""Vector codes against k-means by comparing everything."""
from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(k, [math.floor(1024 * float(np.float32(x))) for x in v], label) for k, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    dims = len(kept[0][1]) if kept else 0
    if not dims or dims % parts:
        return [], None
    kept = [r for r in kept if len(r[1]) == dims]
    width = dims // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for i, members in groups.items():
                books[p][i] = [sum(x) // len(members) for x in zip(*members)]
    out = []
    for (key, _, label), c in zip(kept, cut):
        hits = [nearest(p, c[p]) for p in range(parts)]
        out.append((key, label, "".join(f"{i:02x}" for _, i in hits), sum(d for d, _ in hits)))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(out, key=str), hashlib.sha256(flat.encode()).hexdigest()


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    coded, books = vc.compress_vectors(df, extra={"label": F.col("label")}, **options)
    return sorted(((r["key"], r["label"], r["code"], r["error"]) for r in coded.collect()), key=str), books.sha256()


def cloud(seed, n, dims):
    rnd = np.random.default_rng(seed)
    return [(i, (rnd.normal(size=dims) * rnd.choice([.02, .3])).tolist(), int(rnd.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("n,entries,dims", [(120, 16, 8), (300, 256, 8), (90, 7, 12), (5, 256, 4)])
def test_equals_brute_force(spark, n, entries, dims):
    rows = cloud(n, n, dims)
    assert found(spark, rows, entries=entries) == brute(rows, entries=entries)


def test_nulls_ties_and_repeats(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(40), [rnd.choice([0.0, .5, -.5]) for _ in range(4)], rnd.choice([0, None])) for _ in range(80)]
    rows += [rows[0], (None, [.5] * 4, None), (None, [.25] * 4, 1), (1000, None, 0), (1001, [1.0, None, 0.0, 0.0], 0),
             (1002, [float("nan")] * 4, 0), (1003, [float("-inf")] * 4, 0), (1004, [1.0] * 8, 0), (1005, [], 0)]
    for entries in (4, 256):
        assert found(spark, rows, entries=entries) == brute(rows, entries=entries)


def test_empty_and_odd_tables(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0, 3.0], 0), (2, [1.0] * 4, 0)], [(1, [], 0)]):
        assert found(spark, rows)[0] == []


def test_orchard_visits_few_and_finds_the_lowest_index():
    rnd = np.random.default_rng(1)
    for width, size in ((1, 50), (2, 256), (16, 256)):
        book = rnd.integers(-40, 40, (size, width))
        book[size // 2] = book[3]                       # two equal entries
        points = np.vstack([rnd.integers(-60, 60, (500, width)), book])
        index, distance = vc.Neighbours(book).nearest(points)
        gaps = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        assert (index == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()


def test_query_sums_errors_by_label(spark, tmp_root):
    rows = cloud(8, 60, 8) + [(100 + i, [.1 * i] * 8, None) for i in range(5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_root}/embeddings.parquet")
    got = vc.op13_vector_codes(spark, tmp_root).collect()
    want, digest = brute(rows)
    total = {}
    for _, label, _, error in want:
        total[label] = total.get(label, 0) + error
    label = {r[0]: r[2] for r in rows}
    assert {(r["vec_id"], r["code"], r["error"]) for r in got} == {(k, c, e) for k, _, c, e in want}
    assert all(r["label_error"] == total[label[r["vec_id"]]] and r["codebooks_sha256"] == digest for r in got)
