"""Temporal column helpers.

Date/time columns can reach an operator as ``string``, ``date``, ``timestamp``
or ``timestamp_ntz`` (JSON has no temporal type).  These helpers normalise any
of the four into a session-time-zone ``timestamp`` with built-in expressions,
so everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column ``name`` of ``df`` as a ``timestamp``.

    Strings accept both ``yyyy-MM-dd HH:mm:ss`` and the ISO ``T`` form and fail
    the job on malformed input (ANSI), as the casts they stand for do.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, T.StringType):
        return F.to_timestamp(c)
    return c.cast(T.TimestampType())


def date_key(ts: Column) -> Column:
    """``yyyyMMdd`` as an int, computed arithmetically (no string round trip)."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast(T.IntegerType())


def hour_key(ts: Column) -> Column:
    return F.hour(ts)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch (floor), as ``unix_timestamp`` gives."""
    return F.unix_timestamp(ts)
