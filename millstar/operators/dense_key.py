"""Dense surrogate keys 1..N in key order, NULL keys first.

The textbook form ``row_number().over(Window.orderBy(keys))`` moves every row
into one task (``Exchange SinglePartition``).  Here the same numbers are
produced without any single-task step over the data:

1. range-partition the distinct keys and sort inside each partition;
2. tag each row with its partition and a within-partition position
   (``monotonically_increasing_id`` is ``partition << 33 | position``);
3. cut lineage with a reliable checkpoint, so the range bounds (which Spark
   samples afresh on every evaluation) are fixed once for both uses below;
4. count rows per partition -- one row per partition, a proven size bound --
   and turn the counts into offsets with a running sum;
5. broadcast the offsets (at most ``partitions`` rows) and add them.

The checkpoint keeps the range partitioning, so step 5 is a map-only
broadcast hash join and the output is evenly partitioned by key range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.session import ensure_checkpoint_dir, shuffle_partitions

_PART = "__dk_part"
_POS = "__dk_pos"


def dense_key(df: DataFrame, order_by: Sequence[str], sk_name: str,
              partitions: int | None = None, sk_type: T.DataType = T.LongType()) -> DataFrame:
    """Add ``sk_name`` = 1-based rank of each row by ``order_by`` (ascending, NULLs first).

    Rows are expected to be distinct on ``order_by`` (callers pass the output of
    ``distinct``); ties would get distinct, arbitrary-order numbers, like
    ``row_number``.  ``sk_name`` is placed first.  The key is a long unless ``sk_type``
    says otherwise (the small derived dimensions number in int).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or shuffle_partitions(spark)
    order = [F.col(c).asc_nulls_first() for c in order_by]

    numbered = (df.repartitionByRange(n, *order)
                  .sortWithinPartitions(*order)
                  .withColumn(_PART, F.spark_partition_id())
                  .withColumn(_POS, F.monotonically_increasing_id())
                  .checkpoint(eager=True))

    per_part = numbered.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("__dk_n"),
        F.min(_POS).alias("__dk_first"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        _PART, "__dk_first",
        F.coalesce(F.sum("__dk_n").over(before), F.lit(0)).alias("__dk_before"))

    sk = (F.col("__dk_before") + (F.col(_POS) - F.col("__dk_first")) + 1).cast(sk_type)
    data_cols = [F.col(f"`{c}`") for c in df.columns]
    return (numbered.join(F.broadcast(offsets), _PART)
                    .select(sk.alias(sk_name), *data_cols))


def dense_key_window(df: DataFrame, order_by: Sequence[str], sk_name: str,
                     sk_type: T.DataType = T.LongType()) -> DataFrame:
    """The single-partition window form, kept as the reference shape for tests."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.select(F.row_number().over(w).cast(sk_type).alias(sk_name), *df.columns)
