"""Vector codes: product quantisation whose nearest entries are found by Orchard's search.

Components become integers floor(scale * x); every vector is cut into equal consecutive parts, each part position
has a codebook.  A round assigns every part to its nearest entry (squared Euclidean distance, ties to the lower
index) and replaces each used entry by the componentwise floor of its parts' mean; entries that nothing uses stay.

Orchard's search: each entry has a list of all entries by distance.  A point starts at some entry, walks down the
list of its best entry so far, jumps to the list of every entry that improves on it, marks what it has visited and
stops where the list lies beyond twice its current distance (all further entries are farther away by the triangle
inequality; at exactly twice they may tie and are still visited).  Points of a batch walk side by side.

Per round every task returns one row of counts and sums for each used entry, Spark adds them up, and at most
parts * entries rows reach the driver.  The books (the same bound) travel with the tasks.

Defined results: vectors that are null or hold null or non-finite components are dropped; so are vectors whose
length is not that of the smallest kept key's vector, or all of them where that length is no positive multiple of
the number of parts.  Null keys come last; equal keys are ordered by their vectors' bytes.  Repeated rows count each.
With fewer kept rows than entries the books are shorter.  Scaled components beyond 2**28 raise ValueError.  Empty
tables give empty results; columns of other names do not matter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import col, written
from llm.vectors import integer_vectors, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
WALK_ROWS = 4096
#: Groups of equal labels that may be broadcast (a long and a label each).
BROADCAST_LABELS = 100_000


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


class Neighbours:
    """The entries of one codebook, each with all entries in order of distance."""

    def __init__(self, book: np.ndarray):
        self.book = book
        gap = _squares((book[:, None, :] - book[None, :, :]).reshape(-1, book.shape[1])).reshape(len(book), len(book))
        self.order = np.argsort(gap, axis=1, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, axis=1)
        total = book.sum(axis=1)
        self.by_total = np.argsort(total, kind="stable")
        self.total = total[self.by_total]

    def _start(self, points: np.ndarray) -> np.ndarray:
        """An entry whose components have nearly the same sum."""
        at = np.searchsorted(self.total, points.sum(axis=1))
        return self.by_total[np.minimum(at, len(self.total) - 1)]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of every point."""
        n, k = len(points), len(self.book)
        best = self._start(points)
        distance = _squares(points - self.book[best])
        visited = np.zeros((n, k), dtype=bool)
        visited[np.arange(n), best] = True
        place = np.zeros(n, dtype=np.int64)  # in the list of the best entry
        live = np.arange(n)
        while len(live):
            entry, at = best[live], place[live]
            near = self.gap[entry, at] <= 4 * distance[live]
            live, other = live[near], self.order[entry[near], at[near]]
            place[live] += 1
            fresh = ~visited[live, other]
            who, other = live[fresh], other[fresh]
            visited[who, other] = True
            found = _squares(points[who] - self.book[other])
            better = (found < distance[who]) | ((found == distance[who]) & (other < best[who]))
            who = who[better]
            best[who], distance[who], place[who] = other[better], found[better], 0
            live = live[place[live] < k]
        return best, distance


@dataclass(frozen=True)
class Codebooks:
    """Integer entries [part][entry][position]."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def lists(self) -> list[Neighbours]:
        return [Neighbours(book) for book in self.entries]


def _walks(lists: list[Neighbours], vectors: np.ndarray):
    """(part, indexes, squared distances, points) of every part position, a few thousand rows at a time."""
    width = vectors.shape[1] // len(lists)
    for lo in range(0, len(vectors), WALK_ROWS):
        rows = vectors[lo:lo + WALK_ROWS]
        for part, near in enumerate(lists):
            points = np.ascontiguousarray(rows[:, part * width:(part + 1) * width])
            yield lo, part, *near.nearest(points), points


def _sums(entries: np.ndarray, dims: int):
    parts, k, width = entries.shape

    def run(batches):
        lists = Codebooks(entries).lists()
        count = np.zeros((parts, k), dtype=np.int64)
        total = np.zeros((parts, k, width), dtype=np.int64)
        for batch in batches:
            for _, part, best, _, points in _walks(lists, matrix(batch.column(0), dims)):
                np.add.at(total[part], best, points)
                count[part] += np.bincount(best, minlength=k)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
             *[pa.array(np.ascontiguousarray(total[part, entry, i])) for i in range(width)]],
            names=["part", "entry", "n", *[f"s{i}" for i in range(width)]])
    return run


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> tuple[DataFrame, int, Codebooks]:
    """(rows that take part, their length, books) of a table of ``integer_vectors``."""
    first = vectors.orderBy(F.col("key").asc_nulls_last(), "vector").limit(1).collect()
    dims = first[0]["dims"] if first else 0
    if not dims or dims % parts:
        return vectors.where(F.lit(False)), 0, Codebooks(np.zeros((parts, 0, 0), dtype=np.int64))
    vectors = vectors.where(F.col("dims") == dims)
    # At most ``entries`` vectors reach the driver.
    start = vectors.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    width = dims // parts
    book = (np.array([np.frombuffer(r["vector"], "<i4") for r in start], dtype=np.int64)
            .reshape(-1, parts, width).transpose(1, 0, 2).copy())
    sums = [f"s{i}" for i in range(width)]
    for _ in range(rounds):
        schema = "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums)
        found = (vectors.select("vector").mapInArrow(_sums(book, dims), schema)
                 .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).collect())
        book = book.copy()
        for row in found:
            book[row["part"], row["entry"]] = [row[s] // row["n"] for s in sums]
    return vectors, dims, Codebooks(book)


def encoded_vectors(vectors: DataFrame, dims: int, books: Codebooks) -> DataFrame:
    """``vectors`` with code (two hex digits a part) and error (squared distances summed over the parts)
    in place of dims and vector."""
    names = [f.name for f in vectors.schema.fields if f.name not in ("dims", "vector")]
    entries = books.entries
    digits = max(2, len(f"{max(0, entries.shape[1] - 1):x}"))

    def run(batches):
        lists = Codebooks(entries).lists()
        for batch in batches:
            rows = matrix(batch.column(batch.num_columns - 1), dims)
            index = np.zeros((len(rows), len(lists)), dtype=np.int64)
            error = np.zeros(len(rows), dtype=np.int64)
            for lo, part, best, distance, _ in _walks(lists, rows):
                index[lo:lo + len(best), part] = best
                error[lo:lo + len(best)] += distance
            code = ["".join(f"{i:0{digits}x}" for i in row) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(code, pa.string()), pa.array(error)],
                                             names=[*names, "code", "error"])
    kinds = ", ".join(f"`{n}` {vectors.schema[n].dataType.simpleString()}" for n in names)
    return vectors.select(*[col(n) for n in names], "vector").mapInArrow(run, f"{kinds}, code string, error long")


def compress_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
                     extra: dict[str, Column] | None = None, parts: int = PARTS, entries: int = ENTRIES,
                     rounds: int = ROUNDS, scale: float = SCALE) -> tuple[DataFrame, Codebooks]:
    """(key, *extra, code, error of every row that takes part; the final books)."""
    vectors = integer_vectors(df, key, vector, scale, extra or {})
    vectors, dims, books = fit_codebooks(vectors, parts, entries, rounds)
    return encoded_vectors(vectors, dims, books).drop("rid"), books


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    coded, books = compress_vectors(table, extra={"label": F.col("label")})
    coded = written(coded, "vector-codes")
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _oracle() -> str:
    """Assignment by comparing every part with every entry, one pair of CTEs a round."""
    ctes = ["""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
      FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            """p AS MATERIALIZED (SELECT vec_id, label, part, e[part * len(e) // 4 + 1:(part + 1) * len(e) // 4] AS e
      FROM v, unnest(range(4)) AS u(part))""",
            """b0 AS MATERIALIZED (SELECT part, entry, e FROM (SELECT part, e, row_number() OVER
      (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 256)"""]
    for r in range(5):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, part, e, nearest.entry AS entry, nearest.d AS d FROM (
      SELECT p.vec_id, any_value(p.label) AS label, p.part, any_value(p.e) AS e, min({{'d': list_sum(list_transform(
      list_zip(p.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'entry': b.entry}}) AS nearest
      FROM p JOIN b{r} b USING (part) GROUP BY p.vec_id, p.part))""")
        if r < 4:
            ctes.append(f"""s{r} AS MATERIALIZED (SELECT part, entry, list(m ORDER BY i) AS e FROM (
      SELECT part, entry, i, floor(sum(e[i]) / count(*))::BIGINT AS m FROM a{r}, unnest(range(1, len(e) + 1)) AS u(i)
      GROUP BY part, entry, i) GROUP BY part, entry)""")
            ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(s.e, b.e) AS e
      FROM b{r} b LEFT JOIN s{r} s USING (part, entry))""")
    return ("WITH " + ",\n".join(ctes) + """,
c AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{:02x}', entry), '' ORDER BY part) AS code,
      sum(d)::BIGINT AS error FROM a4 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       sha256((SELECT string_agg(array_to_string(e, ','), ',' ORDER BY part, entry) FROM b4)) AS codebooks_sha256 FROM c""")


QUERIES = {"op13_vector_codes": op13_vector_codes}
ORACLE = {"op13_vector_codes": _oracle()}
