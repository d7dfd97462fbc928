"""Exact top-k search by inner product with multi-resolution segment statistics.

Components become integers floor(scale * x).  A vector is read at several resolutions: cut into 1, 2, 4, ... segments,
each segment known by its mean and its deviation.  For a query q and a row x with segments of length L

    squared distance(q, x) >= sum over segments of L * ((mean q - mean x)**2 + (dev q - dev x)**2),

which is the same as  q . x <= sum of L * (mean q * mean x + dev q * dev x)  once both lengths are known (Cauchy-
Schwarz within each segment), so a bound for a block of queries and a block of rows is one matrix product of small
width.  A pair of blocks goes coarse to fine: pairs whose bound falls below the query's threshold are out, rows and
queries without any pair left are no longer looked at, and what survives the finest level gets its exact product.

Work split: rows are dealt by a hash of their number into blocks of about ROW_BLOCK, queries into blocks of about
QUERY_BLOCK.  Every query block first meets one row block, which gives each query a threshold (the k-th best score
found there); then it meets all others, one pair of blocks in memory at a time.  A task returns at most k rows for a
query and row block, those at or above the threshold; Spark ranks them.

Scores are exact: products of integers, in 64-bit floats where all sums stay below 2**53 and in integers beyond.
Bounds get a slack above their rounding error, so rounding never drops a row.

Defined results: vectors that are null or hold null or non-finite components take no part, neither as query nor as
row; vectors of different lengths never meet; an empty vector scores 0 with other empty ones.  A query leaves out its
own row only: repeated rows and rows of equal keys are found like others, and every repeated query row is answered.
Ties go to the smaller key, null keys last.  With fewer than k other rows all are returned.  Scaled components beyond
2**28 raise ValueError, and so do scores that may not fit in 64 bits.  Empty tables give empty results; columns of other names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import written
from llm.vectors import integer_vectors, matrix

SCALE, K = 256.0, 5
ROW_BLOCK, QUERY_BLOCK = 4096, 1024
_EXACT = float(1 << 53)
_LAST_KEY = (1 << 63) - 1
_HITS = "dims int, query_block long, query int, query_id long, key long, score long"


class Resolutions:
    """Segment means and deviations of the rows of a matrix, times the root of the segment length."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.dims = vectors.shape[1]
        self.segments = []
        while (1 << len(self.segments)) < self.dims:
            self.segments.append(1 << len(self.segments))
        self._known: dict[int, np.ndarray] = {}

    def level(self, segments: int) -> np.ndarray:
        if segments not in self._known:
            at = np.arange(segments) * self.dims // segments
            length = np.diff(np.append(at, self.dims))
            x = self.vectors.astype(np.float64)
            total = np.add.reduceat(x, at, axis=1)
            square = np.add.reduceat(x * x, at, axis=1)
            spread = np.sqrt(np.maximum(0.0, square - total * total / length))
            self._known[segments] = np.hstack([total / np.sqrt(length), spread])
        return self._known[segments]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, as int64."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if reach >= 2.0 ** 63:
        raise ValueError("inner products may lie beyond 64 bits")
    return a @ b.T


def above(queries: Resolutions, rows: Resolutions, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of all pairs that score at least the query's threshold."""
    q, r = np.arange(len(queries.vectors)), np.arange(len(rows.vectors))
    longest = [np.sqrt(np.square(x.vectors.astype(np.float64)).sum(axis=1)).max(initial=0.0) for x in (queries, rows)]
    slack = 1e-9 * longest[0] * longest[1] + 0.5
    alive = np.ones((len(q), len(r)), dtype=bool)
    for segments in queries.segments:
        bound = queries.level(segments)[q] @ rows.level(segments)[r].T
        alive &= bound + slack >= threshold[q][:, None]
        some_q, some_r = alive.any(axis=1), alive.any(axis=0)
        q, r, alive = q[some_q], r[some_r], alive[np.ix_(some_q, some_r)]
        if not alive.size:
            break
    i, j = np.nonzero(alive)
    if len(i) * 4 < alive.size and float(longest[0] * longest[1]) < 2.0 ** 62:
        score = np.empty(len(i), dtype=np.int64)
        for lo in range(0, len(i), 1 << 16):
            run = slice(lo, lo + (1 << 16))
            score[run] = np.einsum("ij,ij->i", queries.vectors[q[i[run]]], rows.vectors[r[j[run]]])
    else:
        score = _products(queries.vectors[q], rows.vectors[r])[i, j]
    good = score >= threshold[q[i]]
    return q[i[good]], r[j[good]], score[good]


def _best(query: np.ndarray, key: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best hits of every query, by query, falling score and key."""
    order = np.lexsort((key, -score, query))
    first = np.flatnonzero(np.append(True, query[order][1:] != query[order][:-1]))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def _keys(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST_KEY).to_numpy(zero_copy_only=False).astype(np.int64)


def _pack(table: pa.Table, block: str, name: str) -> pa.Table:
    """One row of a block: its rows' numbers, keys and vectors side by side."""
    table = table.sort_by("rid").combine_chunks()
    vectors = b"".join(table.column("vector").to_pylist())
    row = {"dims": [table.column("dims")[0].as_py()], block: [table.column(block)[0].as_py()],
           f"{name}rids": [table.column("rid").to_numpy().astype("<i8").tobytes()],
           f"{name}keys": [_keys(table.column("key").combine_chunks()).astype("<i8").tobytes()],
           f"{name}vectors": [vectors]}
    return pa.table(row, schema=pa.schema([("dims", pa.int32()), (block, pa.int64()), (f"{name}rids", pa.binary()),
                                           (f"{name}keys", pa.binary()), (f"{name}vectors", pa.binary())]))


def _blocks(rows: DataFrame, size: int, block: str, name: str) -> DataFrame:
    """Rows dealt into blocks of about ``size`` of one length, one row each; also ``{block}s``, how many there are."""
    counts = rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias(f"{block}s"))
    dealt = rows.join(counts, "dims").withColumn(block, F.pmod(F.xxhash64("rid"), F.col(f"{block}s")))
    packed = (dealt.select("dims", block, "rid", "key", "vector").groupBy("dims", block)
              .applyInArrow(lambda t: _pack(t, block, name), f"dims int, {block} long, {name}rids binary, "
                                                             f"{name}keys binary, {name}vectors binary"))
    return written(packed, f"search-{block}s")


def _hits(k: int):
    def run(batches):
        held = None
        for batch in batches:
            for row in batch.to_pylist():
                at = (row["dims"], row["row_block"])
                if held is None or held[0] != at:
                    held = (at, Resolutions(_unpacked(row["vectors"], row["dims"], row["keys"])),
                            np.frombuffer(row["rids"], "<i8"), np.frombuffer(row["keys"], "<i8"))
                _, rows, rids, keys = held
                mine, names = np.frombuffer(row["q_rids"], "<i8"), np.frombuffer(row["q_keys"], "<i8")
                least = (np.full(len(mine), np.iinfo(np.int64).min) if row["least"] is None
                         else np.frombuffer(row["least"], "<i8"))
                q, r, score = above(Resolutions(_unpacked(row["q_vectors"], row["dims"], row["q_keys"])), rows, least)
                other = mine[q] != rids[r]
                q, r, score = q[other], r[other], score[other]
                chosen = _best(q, keys[r], score, k)
                q, key, score = q[chosen], keys[r[chosen]], score[chosen]
                n = len(q)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["dims"], np.int32)), pa.array(np.full(n, row["query_block"], np.int64)),
                     pa.array(q.astype(np.int32)), pa.array(names[q]), pa.array(key, mask=key == _LAST_KEY),
                     pa.array(score)], names=["dims", "query_block", "query", "query_id", "key", "score"])
    return run


def _unpacked(vectors: bytes, dims: int, keys: bytes) -> np.ndarray:
    return np.frombuffer(vectors, "<i4").astype(np.int64).reshape(len(keys) // 8, dims)


def _thresholds(k: int):
    """The k-th best score of every query of a block, as bytes; the lowest number where fewer were found."""
    def run(table: pa.Table) -> pa.Table:
        query, score = (table.column(c).to_numpy() for c in ("query", "score"))
        size = table.column("n")[0].as_py()
        least = np.full(size, np.iinfo(np.int64).min)
        order = np.lexsort((-score, query))
        first = np.flatnonzero(np.append(True, query[order][1:] != query[order][:-1]))
        full = np.diff(np.append(first, len(order))) >= k
        least[query[order][first[full]]] = score[order][first[full] + k - 1]
        return pa.table({"dims": table.column("dims")[:1], "query_block": table.column("query_block")[:1],
                         "least": [least.astype("<i8").tobytes()]},
                        schema=pa.schema([("dims", pa.int32()), ("query_block", pa.int64()), ("least", pa.binary())]))
    return run


def top_k(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K,
          scale: float = SCALE) -> DataFrame:
    """(query_id, rank, key, score): the k best other rows of every row for which ``queries`` holds."""
    vectors = integer_vectors(df, key, vector, scale, {"asks": F.coalesce(queries, F.lit(False))})
    rows = _blocks(vectors, ROW_BLOCK, "row_block", "")
    asked = _blocks(vectors.where("asks"), QUERY_BLOCK, "query_block", "q_")
    many = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("row_blocks"))
    asked = asked.join(many, "dims").withColumn("home", F.pmod(F.col("query_block"), F.col("row_blocks")))

    def met(pairs: DataFrame) -> DataFrame:
        columns = ["dims", "row_block", "rids", "keys", "vectors", "query_block", "q_rids", "q_keys", "q_vectors", "least"]
        return pairs.join(rows, ["dims", "row_block"]).select(*columns).mapInArrow(_hits(k), _HITS)

    near = written(met(asked.withColumn("row_block", F.col("home")).withColumn("least", F.lit(None).cast("binary"))),
                   "search-first")
    sizes = asked.select("dims", "query_block", (F.length("q_rids") / 8).cast("int").alias("n"))
    least = near.join(sizes, ["dims", "query_block"]).groupBy("dims", "query_block").applyInArrow(
        _thresholds(k), "dims int, query_block long, least binary")
    rest = (asked.join(least, ["dims", "query_block"], "left")
            .withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)))
            .where("row_block != home"))
    found = near.unionByName(met(rest))
    order = Window.partitionBy("dims", "query_block", "query").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "key", "score"))


def op12_exact_search(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table, F.col("vec_id") % 50 == 0).withColumnRenamed("key", "vec_id")


QUERIES = {"op12_exact_search": op12_exact_search}
# The same by scoring every pair.
ORACLE = {"op12_exact_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e)::BIGINT AS score
      FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.e) = len(x.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""}
