"""Bronze -> silver cleaning.

Fixed step order: exact whole-row de-duplication, drop rows with a NULL id,
cast to the declared types, then the table's rules (fills and derived columns).
Rules are data, so the ten tables without rules share one code path.

Scale notes
-----------
* ``dropDuplicates()`` plans as partial + final HashAggregate around one hash
  exchange on all columns: copies are collapsed map-side before the shuffle,
  so even a group of identical rows that holds a third of the table sends at
  most one row per map task to the reducer that owns it.
* Written layers take ``drop_few_duplicates`` instead: rows that are mostly distinct
  cost one shuffle of 64-bit row hashes and no shuffle of rows; only rows whose hash
  occurs twice or more are compared whole.
* The id filter is pushed below the aggregate and into the Parquet scan by
  Catalyst (``PushedFilters: [IsNotNull(id)]``).
* Fills are ``coalesce`` / ``CASE`` projections fused into the same codegen
  stage as the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.schemas import BRONZE_SCHEMAS, KEY_COLUMNS, TABLE_IDS
from millstar.session import BROADCAST_ROW_BYTES, broadcast_room, scratch_path

# Hashes of repeated rows that may be broadcast; with more of them, or with more than the driver has room for while it
# cleans other tables, all rows are compared whole.
FEW_COPIES = 1_000_000
CLEANED_AT_ONCE = 4
_ROW_HASH = "__row_hash"


# --- rule vocabulary --------------------------------------------------------

@dataclass(frozen=True)
class Fill:
    """``column := value`` where the column is NULL."""
    column: str
    value: object

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, F.coalesce(F.col(self.column), F.lit(self.value)))


@dataclass(frozen=True)
class FillFrom:
    """``column := source`` where the column is NULL (and the source is not)."""
    column: str
    source: str

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, F.coalesce(F.col(self.column), F.col(self.source)))


@dataclass(frozen=True)
class Derive:
    """A new (or replaced) column computed from the row."""
    column: str
    expr: Callable[[], Column]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, self.expr())


Rule = Fill | FillFrom | Derive


@dataclass(frozen=True)
class CleaningSpec:
    id_column: str
    rules: tuple[Rule, ...] = field(default_factory=tuple)


def _alert_status() -> Column:
    resolved = F.col("resolved_at").isNotNull()
    acknowledged = F.col("acknowledged_at").isNotNull()
    return (F.when(resolved, F.lit("resolved"))
            .when(acknowledged, F.lit("acknowledged"))
            .otherwise(F.lit("pending")))


# Per-table default texts and the alert status labels.
CLEANING_RULES: dict[str, tuple[Rule, ...]] = {
    "alerts": (
        FillFrom("acknowledged_at", "resolved_at"),
        Fill("resolved_by", "unknown"),
        Derive("alert_status", _alert_status),
    ),
    "quality_checks": (Fill("notes", "No notes provided"),),
    "defects": (Fill("corrective_action", "Corrective action not taken"),),
    "maintenance_logs": (Fill("parts_replaced", "No parts replaced"),),
}


def cleaning_spec(table: str) -> CleaningSpec:
    """The registry lookup (id column + rules) for one bronze table."""
    if table not in TABLE_IDS:
        raise KeyError(f"no cleaning registered for table {table!r}")
    return CleaningSpec(TABLE_IDS[table], CLEANING_RULES.get(table, ()))


# --- steps ------------------------------------------------------------------

def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Remove rows identical in every column."""
    return df.dropDuplicates()


def drop_few_duplicates(df: DataFrame) -> DataFrame:
    """C1 with the same result, cheap where few rows have copies.

    ``df`` is read more than once, so it must give the same rows every time (files do).  The hashes that occur more than
    once are found at once and kept in scratch space.  Rows of any other hash are distinct and are not shuffled.
    """
    if not df.columns or not all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
                                                         T.TimestampNTZType, T.BinaryType))
                                 or f.dataType == T.StringType() for f in df.schema.fields):
        return drop_exact_duplicates(df)
    spark = df.sparkSession
    # Equal as C1 holds them: -0.0 is 0.0.
    rows = df.select([(F.col(f"`{f.name}`") + F.lit(0.0)).cast(f.dataType).alias(f.name)
                      if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                      for f in df.schema.fields])
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    path = scratch_path(spark, "copies")
    (rows.groupBy(row_hash.alias(_ROW_HASH)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_ROW_HASH)
     .write.parquet(path))
    copies = spark.read.schema(f"{_ROW_HASH} long").parquet(path)
    n = copies.count()
    if n == 0:
        return rows
    if n > min(FEW_COPIES, broadcast_room(spark) // (CLEANED_AT_ONCE * (8 + BROADCAST_ROW_BYTES))):
        return drop_exact_duplicates(df)
    # At most FEW_COPIES numbers.
    hashed, copies = rows.withColumn(_ROW_HASH, row_hash), F.broadcast(copies)
    single = hashed.join(copies, _ROW_HASH, "left_anti").drop(_ROW_HASH)
    return single.unionByName(drop_exact_duplicates(hashed.join(copies, _ROW_HASH, "left_semi").drop(_ROW_HASH)))


def drop_null_ids(df: DataFrame, id_column: str) -> DataFrame:
    """Keep rows whose id is present."""
    return df.filter(F.col(id_column).isNotNull())


def standardize_types(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Cast each declared column that is present to its declared type.

    Id and foreign-key columns that arrive as text stay text.  Columns the schema
    does not declare are left alone; declared columns that are missing are not
    invented.  Order of columns is kept.
    """
    if schema is None:
        return df
    declared = {f.name: f.dataType for f in schema.fields}
    cols = []
    for f in df.schema.fields:
        target = declared.get(f.name)
        if (target is None or target == f.dataType
                or (f.name in KEY_COLUMNS and isinstance(f.dataType, T.StringType))):
            cols.append(F.col(f"`{f.name}`"))
        else:
            cols.append(F.col(f"`{f.name}`").cast(target).alias(f.name))
    return df.select(cols)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """C4: table rules in order."""
    for rule in rules:
        df = rule.apply(df)
    return df


# How C1 is done: rows may have any number of copies, few have some, or an earlier step left none.
DISTINCT_BY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "any": drop_exact_duplicates,
    "few": drop_few_duplicates,
    "none": lambda df: df,
}


def clean(df: DataFrame, spec: CleaningSpec, schema: T.StructType | None = None,
          copies: str = "any") -> DataFrame:
    """The cleaning pipeline for one table."""
    df = DISTINCT_BY[copies](df)
    df = drop_null_ids(df, spec.id_column)
    df = standardize_types(df, schema)
    return apply_rules(df, spec.rules)


def clean_table(df: DataFrame, table: str, declared_types: bool = True, copies: str = "any") -> DataFrame:
    """Clean a bronze table by name through the registry (``copies``: see ``DISTINCT_BY``)."""
    schema = BRONZE_SCHEMAS.get(table) if declared_types else None
    return clean(df, cleaning_spec(table), schema, copies)
