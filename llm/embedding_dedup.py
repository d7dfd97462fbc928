"""Exact embedding near-duplicates by dual traversal of cover trees.

Vectors are compared on the unit sphere, where cosine >= c is Euclidean
distance <= sqrt(2 - 2c) = r.

1. Equal vectors of one label collapse to a class with a count (partial aggregate).
2. The top of the tree is a net of centres per label (one per ``CELL_ROWS``
   classes, at most ``MAX_CENTRES``).  A class lives in the cell of its nearest
   centre and visits every earlier cell whose border it is within r of: the
   distance to the border between centres x and y is
   (|p-y|^2 - |p-x|^2) / 2|x-y|.  Every linked pair meets in the cell of lower
   number, so nothing is missed and no pair is met twice.
3. A cell with more rows than a block takes is dealt into blocks and every pair
   of blocks is a task of its own, so no task grows with the data.
4. Each task first screens its pairs: in an orthonormal basis whose first
   ``HEAD`` directions hold most of the spread, the product of two vectors is
   at most that of their heads plus that of the lengths of their tails, one
   matrix product of HEAD + 1 columns.  Vectors with no such bound near the
   cosine link with nothing in this task (nothing linked is lost).
5. Of the others it builds a cover tree per block (nested levels, radii halving,
   each node with its true covering radius) and walks the two trees together.  A
   pair of nodes further apart than both radii and r is pruned; one wholly
   within r is counted as a whole; leaves are compared by matrix products, and
   products within 1e-9 of the bound are recomputed as dot / (norm * norm).  A
   node whose members lie about as far from each other as from its centre would
   fall into single points; it stays a leaf.
6. Tasks return counts and a local root per class, never pairs; components of
   the roots are found by ``components``.

Where data has no structure (random directions in many dimensions) the cells
prune little and the screen within a label is quadratic in its classes: about
two nanoseconds a pair.  Vectors travel in four bytes a component where they came so.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
values, and rows with a null label, link with nothing and are their own
component; vectors of different lengths are not compared; repeated rows are
copies and link with each other; a null vec_id counts as a vector but cannot
name a component; an empty table gives an empty result.  Classes are named by a
64-bit hash of label and vector.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import col, fresh, written
from llm.components import components

CELL_ROWS = 32768
MAX_CENTRES = 1024
# Rows of a block, fewer where a vector is longer than BLOCK_BYTES / BLOCK_ROWS bytes; rows that meet the centres in one go.
BLOCK_ROWS = 32768
BLOCK_BYTES = 16 << 20
SHARD_ROWS = 4096
LEAF = 128
HEAD = 16
CHUNK = 1024
_SLACK = 1e-9
_HEAD_SLACK = 1e-5   # of sums of HEAD + 1 products in single precision


def _unit(column: pd.Series, dims: int) -> tuple[np.ndarray, np.ndarray]:
    packed = b"".join(column)
    raw = np.frombuffer(packed, dtype=f"<f{len(packed) // (len(column) * dims)}").astype(np.float64).reshape(-1, dims)
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class CoverTree:
    """Nested nets over unit vectors: node = centre, covering radius, slice of ``order``, children."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.zeros(len(points), dtype=np.int64)
        self.centre, self.radius, self.span, self.children = [], [], [], []
        if len(points):
            distance = self._from(0, np.arange(len(points)))
            self._build(np.arange(len(points)), distance, 0, float(distance.max()))
        self.centre = np.array(self.centre, dtype=np.int64)
        self.radius = np.array(self.radius)
        self.span = np.array(self.span, dtype=np.int64).reshape(-1, 2)

    def _from(self, centre: int, members: np.ndarray) -> np.ndarray:
        gap = self.points[members] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _node(self, centre: int, members: np.ndarray, distance: np.ndarray, at: int) -> int:
        self.centre.append(int(centre))
        self.radius.append(float(distance.max()))
        self.span.append((at, at + len(members)))
        self.children.append(None)
        self.order[at:at + len(members)] = members
        return len(self.centre) - 1

    def _build(self, members: np.ndarray, distance: np.ndarray, at: int, scale: float) -> None:
        """Iterative: each pending node is split into children of half its scale."""
        root = self._node(members[int(distance.argmin())], members, distance, at)
        pending = [(root, members, distance, scale)]
        while pending:
            node, members, distance, scale = pending.pop()
            if len(members) <= LEAF or self.radius[node] == 0.0:
                continue
            half = min(scale, self.radius[node]) / 2
            left, gaps = members, distance
            centre, place = self.centre[node], self.span[node][0]
            parts, most = [], max(LEAF, len(members) // 16)
            while len(left) and len(parts) <= most:
                near = gaps <= half
                parts.append((centre, left[near], gaps[near]))
                left = left[~near]
                if len(left):
                    centre = left[0]
                    gaps = self._from(centre, left)
            if len(left):
                continue
            kids = []
            for centre, part, gaps in parts:
                kids.append((self._node(centre, part, gaps, place), part, gaps))
                place += len(part)
            self.children[node] = np.array([k for k, _, _ in kids])
            pending += [(k, m, d, half) for k, m, d in kids]


class _Links:
    """Counts and a union-find over the task's classes."""

    def __init__(self, raw, unit, weight, visitor, cosine: float):
        self.raw, self.unit, self.weight, self.visitor = raw, unit, weight, visitor
        self.cosine = cosine
        self.norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        self.links = np.zeros(len(weight), dtype=np.int64)
        self.parent = list(range(len(weight)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _join(self, x: np.ndarray, y: np.ndarray) -> None:
        for i, j in zip(x.tolist(), y.tolist()):
            i, j = self.root(i), self.root(j)
            if i != j:
                self.parent[max(i, j)] = min(i, j)

    def compare(self, x: np.ndarray, y: np.ndarray, same: bool, allowed: np.ndarray | None = None) -> None:
        """All pairs of members x and y (``same``: each unordered pair of x once), or the allowed ones."""
        for a in range(0, len(x), CHUNK):
            for b in range(a if same else 0, len(y), CHUNK):
                self._compare(x[a:a + CHUNK], y[b:b + CHUNK], same and a == b,
                              None if allowed is None else allowed[a:a + CHUNK, b:b + CHUNK])

    def _compare(self, x: np.ndarray, y: np.ndarray, same: bool, allowed: np.ndarray | None) -> None:
        dots = self.unit[x] @ self.unit[y].T
        linked = dots >= self.cosine
        close = np.argwhere(np.abs(dots - self.cosine) <= _SLACK)
        for i, j in close.tolist():
            a, b = x[i], y[j]
            linked[i, j] = float(self.raw[a] @ self.raw[b]) / float(self.norm[a] * self.norm[b]) >= self.cosine
        if allowed is not None:
            linked &= allowed
        self._record(x, y, linked, same)

    def whole(self, x: np.ndarray, y: np.ndarray, same: bool) -> None:
        for a in range(0, len(x), CHUNK):
            for b in range(a if same else 0, len(y), CHUNK):
                i, j = x[a:a + CHUNK], y[b:b + CHUNK]
                self._record(i, j, np.ones((len(i), len(j)), dtype=bool), same and a == b)

    def _record(self, x, y, linked, same) -> None:
        linked &= ~(self.visitor[x][:, None] & self.visitor[y][None, :])
        if same:
            linked &= np.tri(len(x), dtype=bool).T
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        np.add.at(self.links, x, linked @ self.weight[y])
        np.add.at(self.links, y, self.weight[x] @ linked)
        # Each row's and each column's first hit; then what is still apart, once for each two roots.
        hit_rows, hit_columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        self._join(x[hit_rows], y[linked.argmax(axis=1)[hit_rows]])
        self._join(x[linked.argmax(axis=0)[hit_columns]], y[hit_columns])
        i, j = np.nonzero(linked)
        of_x, of_y = (np.array([self.root(k) for k in z.tolist()]) for z in (x, y))
        of_x, of_y = of_x[i], of_y[j]
        apart = of_x != of_y
        if apart.any():
            self._join(*np.unique(np.stack([of_x[apart], of_y[apart]]), axis=1))


def dual_traversal(a: CoverTree, ia: np.ndarray, b: CoverTree, ib: np.ndarray, same: bool, reach: float,
                   links: _Links) -> None:
    """Visit all node pairs that may hold points within ``reach``; ia, ib map points to classes."""
    if not len(ia) or not len(ib):
        return

    def members(tree, index, node):
        lo, hi = tree.span[node]
        return index[tree.order[lo:hi]]

    def parts(tree, node):
        kids = tree.children[node]
        return np.array([node]) if kids is None else kids

    pending = [(0, 0)]
    while pending:
        m, n = pending.pop()
        if a.children[m] is None and b.children[n] is None:
            links.compare(members(a, ia, m), members(b, ib, n), same and m == n)
            continue
        x, y = parts(a, m), parts(b, n)
        for lo in range(0, len(x), 512):
            xs = x[lo:lo + 512]
            dots = a.points[a.centre[xs]] @ b.points[b.centre[y]].T
            gap = np.sqrt(np.maximum(0.0, 2 - 2 * dots))
            radii = a.radius[xs][:, None] + b.radius[y][None, :]
            alive = gap <= radii + reach + 1e-7
            if same and m == n:
                alive &= np.arange(lo, lo + len(xs))[:, None] <= np.arange(len(y))[None, :]
            # Pairs of single points need no further visit: they are compared as one block.
            one_x = a.span[xs, 1] - a.span[xs, 0] == 1
            one_y = b.span[y, 1] - b.span[y, 0] == 1
            if one_x.any() and one_y.any():
                allowed = alive[np.ix_(one_x, one_y)]
                if same and m == n:
                    allowed &= xs[one_x][:, None] != y[one_y][None, :]
                if allowed.any():
                    links.compare(ia[a.centre[xs[one_x]]], ib[b.centre[y[one_y]]], False, allowed)
                alive[np.ix_(one_x, one_y)] = False
            inside = alive & (gap + radii <= reach - 1e-7)
            for i, j in np.argwhere(inside).tolist():
                links.whole(members(a, ia, xs[i]), members(b, ib, y[j]), same and xs[i] == y[j])
            alive &= ~inside
            i, j = np.nonzero(alive)
            pending += list(zip(xs[i].tolist(), y[j].tolist()))


def _heads(unit: np.ndarray) -> np.ndarray:
    """Unit vectors as HEAD + 1 single-precision columns whose products are at least the products of the vectors.

    The first columns are coordinates along orthonormal directions of large spread (two power steps over a sample;
    any orthonormal directions give valid bounds), the last is the length of the rest.
    """
    sample = unit[:: -(-len(unit) // CHUNK)]
    sample = sample - sample.mean(axis=0)
    basis = np.linalg.qr(np.random.default_rng(0).normal(size=(unit.shape[1], min(HEAD, unit.shape[1]))))[0]
    for _ in range(2):
        basis = np.linalg.qr(sample.T @ (sample @ basis) + 1e-6 * basis)[0]
    head = unit @ basis
    rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", head, head)))
    return np.column_stack([head, rest]).astype(np.float32)


def near_any(heads: np.ndarray, x: np.ndarray, y: np.ndarray, same: bool, bound: float, touched: np.ndarray) -> None:
    """Set ``touched`` for members of x and y that have a pair whose bound reaches ``bound`` (``same``: x is y)."""
    wide = 4 * CHUNK
    for a in range(0, len(x), wide):
        left = heads[x[a:a + wide]]
        for b in range(a if same else 0, len(y), wide):
            products = left @ heads[y[b:b + wide]].T
            if same and a == b:
                np.fill_diagonal(products, -2)
            rows = np.flatnonzero(products.max(axis=1) >= bound)
            if len(rows):
                touched[x[a + rows]] = True
                touched[y[b + np.flatnonzero(products[rows].max(axis=0) >= bound)]] = True


def _task(cosine: float):
    reach = math.sqrt(2 - 2 * cosine)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raw, unit = _unit(pdf["vector"], int(pdf["dims"].iloc[0]))
        visitor, touched = pdf["visitor"].to_numpy(dtype=bool), np.zeros(len(pdf), dtype=bool)
        low, one = (pdf["block"] == pdf["low"]).to_numpy(), pdf["low"].iloc[0] == pdf["high"].iloc[0]
        heads, bound = _heads(unit), np.float32(cosine - _HEAD_SLACK)
        at, guests = np.flatnonzero(low & ~visitor), np.flatnonzero(low & visitor)
        if one:
            near_any(heads, at, at, True, bound, touched)
            near_any(heads, at, guests, False, bound, touched)
        else:
            near_any(heads, at, np.flatnonzero(~low), False, bound, touched)
            near_any(heads, guests, np.flatnonzero(~low & ~visitor), False, bound, touched)
        links = _Links(raw[touched], unit[touched], pdf["copies"].to_numpy()[touched], visitor[touched], cosine)
        left, right = np.flatnonzero(low[touched]), np.flatnonzero(~low[touched])
        if one:
            tree = CoverTree(links.unit)
            dual_traversal(tree, left, tree, left, True, reach, links)
        else:
            dual_traversal(CoverTree(links.unit[left]), left, CoverTree(links.unit[right]), right, False, reach, links)
        found = np.flatnonzero(links.links)
        name = pdf["name"].to_numpy()[touched]
        return pd.DataFrame({"name": name[found], "links": links.links[found],
                             "root": name[[links.root(int(i)) for i in found]] if len(found) else name[:0]})
    return run


def _cells(reach: float):
    """Home cell and visited cells of a shard's classes, against all centres of the label."""
    def run(points: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        columns = ["label", "dims", "cell", "name", "copies", "vector", "visitor"]
        if points.empty:
            return pd.DataFrame({c: [] for c in columns})
        if centres.empty or len(centres) == 1:
            return points.assign(cell=0, visitor=False)[columns]
        centres = centres.sort_values("c_name")
        dims = int(points["dims"].iloc[0])
        _, p = _unit(points["vector"], dims)
        _, c = _unit(centres["c_vector"], dims)
        gap2 = np.maximum(0.0, 2 - 2 * (p @ c.T))
        home = gap2.argmin(axis=1)
        between = np.sqrt(np.maximum(0.0, 2 - 2 * (c @ c.T)))
        border = (gap2 - gap2[np.arange(len(p)), home][:, None]) <= 2 * between[home] * reach + 1e-7
        visits = border & (np.arange(len(c))[None, :] < home[:, None])
        i, j = np.nonzero(visits)
        at = np.concatenate([np.arange(len(p)), i])
        return points.iloc[at].assign(cell=np.concatenate([home, j]),
                                      visitor=np.arange(len(at)) >= len(p))[columns]
    return run


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = 0.98) -> DataFrame:
    """``df`` plus n_links, component_id and kept (in fresh names where these are taken)."""
    reach = math.sqrt(2 - 2 * cosine)
    name = fresh(df, "e_name")
    v = col(vector)
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                                 & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))
    sound = (col(label).isNotNull() & v.isNotNull() & finite
             & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    doubles = v.cast("array<double>")
    # Single-precision components are doubles too, in half the bytes.
    single = isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    named = df.withColumn(name, F.when(sound, F.xxhash64(col(label), doubles)))
    valid = named.where(col(name).isNotNull()).select(
        col(label).cast("string").alias("label"), F.size(v).alias("dims"), col(name).alias("name"),
        (v if single else doubles).alias("vector"), col(key).cast("long").alias("key"))
    classes = written(
        valid.groupBy("label", "dims", "name").agg(
            F.count(F.lit(1)).alias("copies"), F.min("key").alias("key"), F.first("vector").alias("vector"))
        .mapInArrow(_packed("<f4" if single else "<f8"), "label string, dims int, name long, copies long, key long, vector binary"),
        "embedding-classes")
    sizes = classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "dims", F.least(F.lit(MAX_CENTRES), F.ceil(F.col("n") / CELL_ROWS)).cast("long").alias("centres"),
        F.ceil(F.col("n") / SHARD_ROWS).cast("long").alias("shards"),
        (F.col("n").cast("double")).alias("n"))
    sized = classes.join(sizes, ["label", "dims"])
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("name", F.lit(1)), "shards"))
    # A hash draw of about ``centres`` classes; which ones are drawn affects work, not results.
    draw = F.pmod(F.xxhash64("name", F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    centres = sized.where(draw < F.col("centres") / F.col("n")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    keys = ["label", "dims", "shard"]
    cells = written(
        dealt.select(*keys, "name", "copies", "vector").groupBy(*keys)
        .cogroup(centres.select(*[F.col(c).alias(f"c_{c}") for c in (*keys, "name", "vector")])
                 .groupBy(*[f"c_{c}" for c in keys]))
        .applyInPandas(_cells(reach), "label string, dims int, cell long, name long, copies long, "
                                      "vector binary, visitor boolean"), "embedding-cells")
    block_rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dims")))))
    blocks = cells.groupBy("label", "dims", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "dims", "cell", F.ceil(F.col("n") / block_rows).cast("long").alias("blocks"))
    placed = cells.join(blocks, ["label", "dims", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("name", F.lit(3)), "blocks"))
    tasks = (placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
             .select("label", "dims", "cell", "low", "high", "block", "name", "copies", "vector", "visitor"))
    found = written(tasks.groupBy("label", "dims", "cell", "low", "high").applyInPandas(
        _task(cosine), "name long, links long, root long"), "embedding-links")
    groups = components(found.select(F.col("name").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("name").agg(F.sum("links").alias("links"))
    light = classes.select("name", "copies", "key")
    placed = light.join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn(
        "component", F.coalesce("component", "name"))
    lowest = placed.groupBy("component").agg(F.min("key").alias("lowest"))
    result = written(placed.join(lowest, "component").join(links, "name", "left").select(
        "name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "lowest"), "embedding-result")
    n1, n2, n3 = fresh(named, "n_links"), fresh(named, "component_id"), fresh(named, "kept")
    joined = named.alias("d").join(result.alias("r"), F.col(f"d.{name}") == F.col("r.name"), "left")
    component = F.when(F.col("r.name").isNull(), F.col(f"d.`{key}`")).otherwise(F.col("r.lowest"))
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns],
                         F.coalesce("r.links", F.lit(0)).cast("long").alias(n1),
                         component.alias(n2),
                         F.coalesce(F.col(f"d.`{key}`") == component, F.lit(True)).alias(n3))


def _packed(kind: str):
    """The last column, a list of numbers, as little-endian bytes; the others as they are."""
    def run(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(kind)
            packed = pa.array([flat[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=batch.schema.names)
    return run


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")


QUERIES = {"op10_embedding_dedup": op10_embedding_dedup}
ORACLE = {"op10_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL
                       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
      AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.98),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""}
