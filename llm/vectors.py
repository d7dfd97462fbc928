"""Integer vectors for the searches and codes: kept rows written once, components scaled and floored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import col, written

#: Scaled components beyond this size are refused: squares and inner products must stay exact in 64 bits.
LARGEST = 1 << 28
_FIELDS = "rid long, key long, dims int, vector binary"


def sound(vector: Column) -> Column:
    """The vector is not null and holds neither nulls nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _packed(scale: float):
    def run(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            at = lists.offsets.to_numpy()
            flat = np.floor(lists.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            if len(flat) and np.abs(flat).max() > LARGEST:
                raise ValueError(f"a component times {scale:g} lies beyond {LARGEST}")
            whole = flat.astype("<i4")
            vectors = pa.array([whole[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
            sizes = pa.array(np.diff(at).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], sizes, vectors, *batch.columns[2:-1]],
                                             names=["rid", "key", "dims", "vector", *batch.schema.names[2:-1]])
    return run


def integer_vectors(df: DataFrame, key: str, vector: str, scale: float, extra: dict[str, Column]) -> DataFrame:
    """(rid, key, dims, vector, *extra) of the sound rows, written to scratch.

    ``vector`` holds floor(scale * x) of every component as little-endian 32-bit integers; ``rid`` names a row and
    is fixed by the write; ``extra`` are further columns, named by the caller.
    """
    rows = df.where(sound(col(vector))).select(
        F.monotonically_increasing_id().alias("rid"), col(key).cast("long").alias("key"),
        *[c.alias(n) for n, c in extra.items()], col(vector).cast("array<double>").alias("vector"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:-1])
    return written(rows.mapInArrow(_packed(scale), _FIELDS + (", " + kinds if kinds else "")), "integer-vectors")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Packed vectors of one length as rows of int64."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column) or not dims:
        return np.zeros((len(column), dims), dtype=np.int64)
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64)[column.offset]
    return (np.frombuffer(data, "<i4", count=len(column) * dims, offset=int(first)).astype(np.int64)
            .reshape(len(column), dims))
