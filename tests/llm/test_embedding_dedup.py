import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import embedding_dedup as ed
from llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n, part = len(rows), list(range(len(rows)))
    links = [0] * n

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    vec = [np.array(np.float32(r[1]), dtype=np.float64) if sound(r[1]) and r[2] is not None else None for r in rows]
    for i in range(n):
        for j in range(i):
            a, b = vec[i], vec[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine or (a == b).all():
                links[i] += 1
                links[j] += 1
                part[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[root(i)] = min(low.get(root(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], low.get(root(i))) for i in range(n)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def got(df):
    return ordered([(r["vec_id"], r["n_links"], r["component_id"]) for r in ed.near_duplicates(df).collect()])


def cloud(seed, n=150):
    rnd = np.random.default_rng(seed)
    rows, centre = [], None
    for i in range(n):
        if centre is None or rnd.random() < .25:
            centre = rnd.normal(size=12)
        v = centre + rnd.normal(size=12) * rnd.choice([0.02, 0.06, 0.1, 0.5])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rnd.integers(0, 2))))
    return rows


@pytest.mark.parametrize("cell,block,leaf", [(2048, 4096, 24), (20, 4096, 3), (10, 7, 2)])
def test_matches_all_pairs(spark, monkeypatch, cell, block, leaf):
    monkeypatch.setattr(ed, "CELL_ROWS", cell)
    monkeypatch.setattr(ed, "BLOCK_ROWS", block)
    monkeypatch.setattr(ed, "LEAF", leaf)
    rows = cloud(cell + block)
    copies = [(1000 + i, *rows[i][1:]) for i in range(0, 40, 2)]
    odd = [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 12, 1), (2003, [1.0, None] + [0.0] * 10, 1),
           (2004, [float("nan")] * 12, 1), (2005, [float("inf")] + [0.0] * 11, 1), (2006, rows[0][1], None),
           (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (None, rows[1][1], rows[1][2]),
           (2**60 + 1, rows[3][1], rows[3][2]), (2**60 + 3, [9.0] + [0.0] * 11, 1)]
    every = rows + copies + odd
    random.Random(1).shuffle(every)
    df = spark.createDataFrame(every, SCHEMA).repartition(4)
    assert got(df) == ordered(brute(every))


def test_one_cluster_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK_ROWS", 9)
    rnd = np.random.default_rng(3)
    centre = rnd.normal(size=8)
    rows = [(i, [float(x) for x in (centre + rnd.normal(size=8) * 0.03).astype(np.float32)], 1) for i in range(60)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == ordered(brute(rows))


def test_cover_tree_nests_and_covers():
    rnd = np.random.default_rng(5)
    points = rnd.normal(size=(300, 6))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = ed.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(300))
    for node, kids in enumerate(tree.children):
        members = tree.order[slice(*tree.span[node])]
        gap = np.linalg.norm(points[members] - points[tree.centre[node]], axis=1)
        assert gap.max() <= tree.radius[node] + 1e-9
        if kids is not None:
            assert sorted(np.concatenate([tree.order[slice(*tree.span[k])] for k in kids])) == sorted(members)
            assert tree.centre[node] in tree.centre[kids]
            assert max(tree.radius[k] for k in kids) <= tree.radius[node] / 2 + 1e-9


def test_points_far_apart_stay_in_one_leaf():
    points = np.random.default_rng(2).normal(size=(1500, 64))
    tree = ed.CoverTree(points / np.linalg.norm(points, axis=1, keepdims=True))
    assert len(tree.centre) < 150  # not a node, and a pass over all others, for every point


def test_heads_bound_products_and_leave_few_pairs():
    rnd = np.random.default_rng(4)
    points = rnd.normal(size=(800, 64)) * np.linspace(0, 2, 64)
    points[1] = points[0] + rnd.normal(size=64) * 0.01
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    heads = ed._heads(unit)
    assert (heads.astype(np.float64) @ heads.astype(np.float64).T >= unit @ unit.T - ed._HEAD_SLACK).all()
    touched = np.zeros(800, dtype=bool)
    ed.near_any(heads, np.arange(800), np.arange(800), True, np.float32(0.98 - ed._HEAD_SLACK), touched)
    assert touched[:2].all() and touched.sum() < 40


def test_doubles_and_long_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK_BYTES", 12 * 8 * 11)
    rows = cloud(12)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == got(df.withColumn("embedding", F.col("embedding").cast("array<double>"))) == ordered(brute(rows))


def test_columns_and_empty_table(spark):
    rows = cloud(9, 30)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit(1)).withColumn("name", F.lit("n"))
    out = ed.near_duplicates(df)
    assert out.columns == [*df.columns, "n_links", "component_id", "_kept"]
    assert all(r["_kept"] == (r["vec_id"] == r["component_id"]) for r in out.collect())
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_components_match_union_find(spark):
    rnd = random.Random(8)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    edges += [(5, 5), (None, 3)]
    part = list(range(400))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, b in edges:
        if a is not None:
            part[max(root(a), root(b))] = min(root(a), root(b))
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((n, root(n)) for n in nodes)
