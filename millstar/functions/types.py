"""Least common types of columns that changed type between versions, and casts to them.

Numbers widen (integers to the wider one, any of them with a float to double, decimals to a decimal that holds both),
dates widen to timestamps, structs, arrays and maps are merged part by part; whatever else differs becomes text,
nested values as JSON.  Nothing is dropped: a column that only some versions have reads NULL in the others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Integer types from narrow to wide, with their decimal digits.
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = (3, 5, 10, 20)


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[_INTEGERS.index(type(kind))], 0) if type(kind) in _INTEGERS else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    floats = (T.FloatType, T.DoubleType)
    if isinstance(a, (T.NumericType,)) and isinstance(b, (T.NumericType,)):
        if isinstance(a, floats) or isinstance(b, floats):
            return T.DoubleType()
        one, two = _decimal(a), _decimal(b)
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    moments = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(a, moments) and isinstance(b, moments):
        either = {type(a), type(b)}
        return T.TimestampNTZType() if either == {T.TimestampNTZType, T.DateType} else T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    return T.StringType()


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Every column of any schema, in order of appearance, with the least common type."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            found[f.name] = common_type(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def same_types(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for what may be null."""
    return a.simpleString() == b.simpleString()


def widened(value: Column, kind: T.DataType, to: T.DataType) -> Column:
    """``value`` of type ``kind`` as the common type ``to``."""
    if same_types(kind, to):
        return value
    if isinstance(to, T.StructType):
        parts = [widened(value.getField(f.name), kind[f.name].dataType, f.dataType) if f.name in kind.names
                 else F.lit(None).cast(f.dataType) for f in to.fields]
        return F.when(value.isNotNull(), F.struct(*[p.alias(f.name) for p, f in zip(parts, to.fields)]))
    if isinstance(to, T.ArrayType):
        return F.transform(value, lambda x: widened(x, kind.elementType, to.elementType))
    if isinstance(to, T.MapType):
        keys = F.transform_keys(value, lambda k, _: widened(k, kind.keyType, to.keyType))
        return F.transform_values(keys, lambda _, v: widened(v, kind.valueType, to.valueType))
    if isinstance(to, T.StringType) and isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(to)
