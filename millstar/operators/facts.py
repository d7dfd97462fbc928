"""Silver + dimensions -> gold facts.

Every fact is one row per source row (absent key fan-out), surrogate keys
resolved by the left-join chain in ``lookup.resolve`` and metrics computed with
built-in column expressions.  All five plans are map-only over the fact source
when the dimensions pass the broadcast size check; the order lookups of F1/F2
are the only ones whose build side grows with the data, and past the bound they
become shuffle joins with NULL keys spread over all reducers.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.functions.temporal import as_timestamp, date_key, epoch_seconds, hour_key
from millstar.functions.text import first_digit_run
from millstar.operators.dense_key import dense_key
from millstar.operators.lookup import Colocation, Lookup, resolve

# Fixed value: minutes in an 8-hour shift, used by cycle_time_avg.
SHIFT_MINUTES = 480


def fact_key(sk_from: str | None) -> Column:
    """The fact's own key.

    Default is ``monotonically_increasing_id`` (unique per write, not
    contiguous); ``sk_from`` names a source column to use instead, which makes
    the key reproducible.
    """
    if sk_from is None:
        return F.monotonically_increasing_id()
    return F.col(sk_from).cast(T.LongType())


def with_dense_key(fact: DataFrame, sk_name: str, partitions: int | None = None) -> DataFrame:
    """R14, stable: the fact with ``sk_name`` = 1..N in the order of all its other columns (ascending, NULLs first).

    The key depends on the rows only, not on partitions, task attempts or the order in which they came; equal rows get
    adjacent numbers.  Costs one range shuffle and a checkpoint (``dense_key``).  Copies of one row are spread over
    ranges by a draw that orders after all columns, so many of them do not fill one task.
    """
    columns = [c for c in fact.columns if c != sk_name]
    spread = "__dk_spread"
    rows = fact.select(*[F.col(f"`{c}`") for c in columns], F.rand(0).alias(spread))
    return dense_key(rows, [*columns, spread], sk_name, partitions).select(sk_name, *columns)


def _date_lookup() -> Lookup:
    return Lookup("dim_date", (("date_key", "date_sk"),), (("date_sk", "date_sk"),))


def _time_lookup() -> Lookup:
    return Lookup("dim_time", (("hour_key", "hour_of_day"),), (("time_sk", "time_sk"),))


def _machine_line_lookups() -> list[Lookup]:
    return [
        Lookup("dim_machine", (("machine_id", "machine_id"),),
               (("machine_sk", "machine_sk"), ("line_id", "machine_line_id"))),
        Lookup("dim_production_line", (("machine_line_id", "line_id"),),
               (("line_sk", "line_sk"),)),
    ]


# --- F1 --------------------------------------------------------------------

# Which dimension resolves which key, here and in the lists below.
# The two order_id lookups (the only ones that grow with the data) come first and
# together, so as shuffle joins they share one exchange of the fact.
FACT_PRODUCTION_LOOKUPS = [
    Lookup("production_orders", (("order_id", "order_id"),),
           (("product_code", "order_product_code"), ("quantity_ordered", "target_units")), growing=True),
    Lookup("dim_order", (("order_id", "order_id"),), (("order_sk", "order_sk"),), growing=True),
    _date_lookup(),
    Lookup("dim_shift", (("shift_id", "shift_id"),), (("shift_sk", "shift_sk"),)),
    Lookup("dim_product", (("order_product_code", "product_code"),),
           (("product_sk", "product_sk"),)),
    Lookup("dim_production_line", (("line_id", "line_id"),),
           (("line_sk", "line_sk"), ("factory_id", "line_factory_id"))),
    Lookup("dim_factory", (("line_factory_id", "factory_id"),),
           (("factory_sk", "factory_sk"),)),
]


def build_fact_production(production_output: DataFrame, dims: Mapping[str, DataFrame],
                          sk_from: str | None = None,
                          broadcast_max_rows: int | None = None,
                          colocated: Colocation | None = None) -> DataFrame:
    """F1.  ``dims`` also holds silver ``production_orders`` (target units, product)."""
    src = production_output.withColumn(
        "date_key", date_key(as_timestamp(production_output, "production_date")))
    out = resolve(src, dims, FACT_PRODUCTION_LOOKUPS, broadcast_max_rows, colocated)
    units = F.col("units_produced")
    cycle = F.when(units > 0, (F.lit(SHIFT_MINUTES) - F.col("downtime_minutes")) / units)
    return out.select(
        fact_key(sk_from).alias("production_sk"),
        "date_sk",
        F.col("date_key").alias("time_sk"),
        "factory_sk", "line_sk", "product_sk", "shift_sk", "order_sk",
        "units_produced", "units_defective", "downtime_minutes", "efficiency_percentage",
        "target_units",
        cycle.alias("cycle_time_avg"),
    )


# --- F2 --------------------------------------------------------------------

# dim_order (the lookup that grows with the data) first: as a shuffle join it then
# probes and shuffles the fact before any lookup has widened it.
FACT_QUALITY_LOOKUPS = [
    Lookup("dim_order", (("order_id", "order_id"),),
           (("order_sk", "order_sk"), ("product_code", "order_product_code")), growing=True),
    _date_lookup(),
    Lookup("dim_production_line", (("line_id", "line_id"),), (("line_sk", "line_sk"),)),
    Lookup("dim_operator", (("inspector_id", "operator_id"),),
           (("operator_sk", "operator_sk"),)),
    Lookup("dim_product", (("order_product_code", "product_code"),),
           (("product_sk", "product_sk"),)),
]


def build_fact_quality(quality_checks: DataFrame, dims: Mapping[str, DataFrame],
                       sk_from: str | None = None,
                       broadcast_max_rows: int | None = None,
                       colocated: Colocation | None = None) -> DataFrame:
    """F2."""
    src = quality_checks.withColumn(
        "date_key", date_key(as_timestamp(quality_checks, "check_date")))
    out = resolve(src, dims, FACT_QUALITY_LOOKUPS, broadcast_max_rows, colocated)
    sample = F.col("sample_size")
    rate = F.when(sample > 0, F.col("defects_found") / sample * 100).otherwise(F.lit(0.0))
    passed = F.coalesce(F.lower(F.col("result")) == "pass", F.lit(False))
    return out.select(
        fact_key(sk_from).alias("quality_sk"),
        "date_sk", "line_sk", "product_sk", "order_sk", "operator_sk",
        "sample_size", "defects_found",
        rate.cast(T.DoubleType()).alias("defect_rate_pct"),
        passed.alias("check_passed"),
    )


# --- F3 --------------------------------------------------------------------

FACT_SENSOR_READINGS_LOOKUPS = [
    _date_lookup(),
    _time_lookup(),
    Lookup("dim_sensor", (("sensor_id", "sensor_id"),), (("sensor_sk", "sensor_sk"),)),
    *_machine_line_lookups(),
]


def build_fact_sensor_readings(sensor_readings: DataFrame, dims: Mapping[str, DataFrame],
                               broadcast_max_rows: int | None = None) -> DataFrame:
    """F3.  The key is the reading id, so the whole fact is reproducible."""
    ts = as_timestamp(sensor_readings, "timestamp")
    src = (sensor_readings.withColumn("reading_ts", ts)
           .withColumn("date_key", date_key(F.col("reading_ts")))
           .withColumn("hour_key", hour_key(F.col("reading_ts"))))
    out = resolve(src, dims, FACT_SENSOR_READINGS_LOOKUPS, broadcast_max_rows)
    return out.select(
        F.col("reading_id").cast(T.LongType()).alias("sensor_reading_sk"),
        "date_sk", "time_sk", "sensor_sk", "machine_sk", "line_sk",
        F.col("reading_ts").alias("timestamp"),
        F.col("value").cast(T.DoubleType()).alias("value"),
        F.col("is_anomaly").cast(T.BooleanType()).alias("is_anomaly"),
        F.col("quality_score").cast(T.IntegerType()).alias("quality_score"),
    )


# --- F4 --------------------------------------------------------------------

FACT_MAINTENANCE_LOOKUPS = [
    _date_lookup(),
    *_machine_line_lookups(),
    Lookup("dim_maintenance_type", (("maintenance_type", "maint_type_name"),),
           (("maint_type_sk", "maintenance_type_sk"),)),
    Lookup("dim_operator", (("technician_id", "operator_id"),),
           (("operator_sk", "operator_sk"),)),
]


def build_fact_maintenance(maintenance_logs: DataFrame, dims: Mapping[str, DataFrame],
                           sk_from: str | None = None,
                           broadcast_max_rows: int | None = None) -> DataFrame:
    """F4.  The technician is the first digit run in ``performed_by``."""
    src = (maintenance_logs
           .withColumn("date_key", date_key(as_timestamp(maintenance_logs, "performed_date")))
           .withColumn("technician_id", first_digit_run(F.col("performed_by"))))
    out = resolve(src, dims, FACT_MAINTENANCE_LOOKUPS, broadcast_max_rows)
    return out.select(
        fact_key(sk_from).alias("maintenance_sk"),
        "date_sk", "machine_sk", "line_sk", "maintenance_type_sk", "operator_sk",
        F.col("cost").alias("cost_amount"),
        "downtime_hours",
        F.coalesce(F.col("downtime_hours"), F.lit(0)).alias("labor_hours"),
    )


# --- F5 --------------------------------------------------------------------

FACT_ALERTS_LOOKUPS = [
    _date_lookup(),
    _time_lookup(),
    Lookup("dim_sensor", (("sensor_id", "sensor_id"),), (("sensor_sk", "sensor_sk"),)),
    *_machine_line_lookups(),
    Lookup("dim_alert_type", (("alert_type", "alert_type_name"), ("severity", "severity_level")),
           (("alert_type_sk", "alert_type_sk"),)),
]


def build_fact_alerts(alerts: DataFrame, dims: Mapping[str, DataFrame],
                      sk_from: str | None = None,
                      broadcast_max_rows: int | None = None) -> DataFrame:
    """F5.  Resolution time in minutes from whole seconds; NULL while unresolved."""
    triggered = as_timestamp(alerts, "triggered_at")
    resolved = as_timestamp(alerts, "resolved_at")
    src = (alerts.withColumn("date_key", date_key(triggered))
           .withColumn("hour_key", hour_key(triggered))
           .withColumn("resolution_time_min",
                       F.when(resolved.isNotNull(),
                              (epoch_seconds(resolved) - epoch_seconds(triggered)) / 60))
           .withColumn("acknowledged_flag", F.col("acknowledged_at").isNotNull()))
    out = resolve(src, dims, FACT_ALERTS_LOOKUPS, broadcast_max_rows)
    return out.select(
        fact_key(sk_from).alias("alert_sk"),
        "date_sk", "time_sk", "sensor_sk", "machine_sk", "line_sk", "alert_type_sk",
        F.col("resolution_time_min").cast(T.DoubleType()).alias("resolution_time_min"),
        "acknowledged_flag",
        F.col("severity").alias("severity_level"),
    )


FACT_BUILDERS = {
    "fact_production": build_fact_production,
    "fact_quality": build_fact_quality,
    "fact_sensor_readings": build_fact_sensor_readings,
    "fact_maintenance": build_fact_maintenance,
    "fact_alerts": build_fact_alerts,
}

FACT_LOOKUPS = {
    "fact_production": FACT_PRODUCTION_LOOKUPS,
    "fact_quality": FACT_QUALITY_LOOKUPS,
    "fact_sensor_readings": FACT_SENSOR_READINGS_LOOKUPS,
    "fact_maintenance": FACT_MAINTENANCE_LOOKUPS,
    "fact_alerts": FACT_ALERTS_LOOKUPS,
}

# Inputs each fact needs (silver tables, then dimensions); a fact whose inputs are
# not all present is skipped.
FACT_REQUIREMENTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "fact_production": (("production_output", "production_orders"),
                        ("dim_date", "dim_shift", "dim_factory", "dim_production_line",
                         "dim_product", "dim_order")),
    "fact_quality": (("quality_checks",),
                     ("dim_date", "dim_production_line", "dim_product", "dim_order",
                      "dim_operator")),
    "fact_sensor_readings": (("sensor_readings",),
                             ("dim_date", "dim_time", "dim_sensor", "dim_machine",
                              "dim_production_line")),
    "fact_maintenance": (("maintenance_logs",),
                         ("dim_date", "dim_machine", "dim_production_line",
                          "dim_maintenance_type", "dim_operator")),
    "fact_alerts": (("alerts",),
                    ("dim_date", "dim_time", "dim_sensor", "dim_machine",
                     "dim_production_line", "dim_alert_type")),
}

# Fact -> its source table.
FACT_SOURCE = {
    "fact_production": "production_output",
    "fact_quality": "quality_checks",
    "fact_sensor_readings": "sensor_readings",
    "fact_maintenance": "maintenance_logs",
    "fact_alerts": "alerts",
}

