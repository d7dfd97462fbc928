"""Adapter: the driver's test tables -> the 14 bronze sensor tables.

The driver's parquet holds no sensor data, so each bronze table is a projection
of one driver table.  Every expression is valid in both Spark SQL and DuckDB, so
the same text feeds the Spark query (``selectExpr``) and the oracle (a CTE).
Injected on purpose: NULL ids and optional fields, orphan foreign keys, zero
divisors, dates outside the calendar, NULL dimension members and several
digit-run shapes in free text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Expressions shared by several tables.
_SHIFTED = ("CASE WHEN {k} % 50 = 0 THEN CAST({d} AS DATE) "
            "ELSE CAST(CAST({d} AS DATE) + INTERVAL 9497 DAY AS DATE) END")
_ORDER_ID = "CASE WHEN l_orderkey % 97 = 0 THEN l_orderkey + 10000000 ELSE l_orderkey END"

# Table -> (driver table, [(column, expression), ...]).
ADAPTER: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "factories": ("region", [
        ("factory_id", "r_regionkey"),
        ("factory_name", "r_name"),
        ("location", "r_name"),
        ("region", "r_name"),
        ("manager_name", "concat('Manager ', r_regionkey)"),
        ("total_area_sqm", "(r_regionkey + 1) * 1000"),
    ]),
    "production_lines": ("nation", [
        ("line_id", "n_nationkey"),
        ("factory_id", "n_regionkey"),
        ("line_name", "n_name"),
        ("line_type", "CASE WHEN n_nationkey % 2 = 0 THEN 'assembly' ELSE 'packing' END"),
        ("capacity_units_hour", "100 + n_nationkey"),
        ("installed_date", "DATE '2015-01-01'"),
        ("status", "'active'"),
    ]),
    "machines": ("supplier", [
        ("machine_id", "s_suppkey"),
        ("line_id", "s_nationkey"),
        ("machine_name", "s_name"),
        ("machine_type", "concat('type_', s_suppkey % 5)"),
        ("manufacturer", "concat('maker_', s_suppkey % 7)"),
        ("model", "concat('m', s_suppkey % 11)"),
        ("serial_number", "s_name"),
        ("installation_date", "DATE '2018-06-01'"),
        ("operating_hours", "s_acctbal"),
        ("is_active", "s_acctbal > 0"),
    ]),
    "sensors": ("part", [
        ("sensor_id", "p_partkey"),
        ("sensor_name", "p_name"),
        ("sensor_type", "p_type"),
        ("unit", "'C'"),
        ("min_threshold", "CAST(0 AS DOUBLE)"),
        ("max_threshold", "p_retailprice"),
        ("machine_name", "concat('machine_', p_partkey % 100)"),
        ("is_active", "p_size > 5"),
    ]),
    "operators": ("customer", [
        ("operator_id", "c_custkey"),
        ("full_name", "c_name"),
        ("employee_code", "concat('E', c_custkey)"),
        ("certification_level", "c_mktsegment"),
        ("role_type", "'operator'"),
        ("hire_date", "DATE '2019-03-01'"),
    ]),
    "production_orders": ("orders", [
        ("order_id", "o_orderkey"),
        ("product_code", "concat('PROD-', o_orderkey % 40)"),
        ("quantity_ordered", "o_orderkey % 900 + 100"),
        ("start_date", _SHIFTED.format(k="o_orderkey", d="o_orderdate")),
        ("target_end_date", "CAST(" + _SHIFTED.format(k="o_orderkey", d="o_orderdate")
         + " + INTERVAL 14 DAY AS DATE)"),
        ("priority", "o_orderpriority"),
        ("status", "o_orderstatus"),
    ]),
    "production_output": ("lineitem", [
        ("output_id", "l_orderkey * 10 + l_linenumber"),
        ("order_id", _ORDER_ID),
        ("line_id", "l_suppkey % 30"),
        ("shift_id", "l_linenumber % 4"),
        ("production_date", _SHIFTED.format(k="l_orderkey", d="l_shipdate")),
        ("units_produced",
         "CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END"),
        ("units_defective", "l_linenumber % 5"),
        ("downtime_minutes", "l_partkey % 120"),
        ("efficiency_percentage", "100 * (1 - l_discount)"),
    ]),
    "quality_checks": ("lineitem", [
        ("check_id",
         "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END"),
        ("order_id", _ORDER_ID),
        ("line_id", "l_suppkey % 30"),
        ("inspector_id", "l_partkey % 1600"),
        ("check_date", _SHIFTED.format(k="l_orderkey", d="l_shipdate")),
        ("result", "CASE l_returnflag WHEN 'A' THEN 'PASS' WHEN 'N' THEN 'pass' ELSE NULL END"),
        ("defects_found", "l_linenumber % 5"),
        ("sample_size",
         "CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END"),
        ("notes", "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_linestatus END"),
    ]),
    "defects": ("lineitem", [
        ("defect_id",
         "CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END"),
        ("defect_type",
         "CASE l_returnflag WHEN 'A' THEN 'crack' WHEN 'N' THEN 'scratch' ELSE 'dent' END"),
        ("corrective_action", "CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'replaced' END"),
    ]),
    "maintenance_logs": ("orders", [
        ("log_id", "CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE o_orderkey END"),
        ("machine_id", "o_orderkey % 110"),
        ("performed_by",
         "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'Technician' "
         "WHEN o_orderkey % 13 = 0 THEN concat('Tech 00', o_custkey, ' and 5') "
         "ELSE concat('Technician ', o_custkey) END"),
        ("maintenance_type",
         "CASE o_orderstatus WHEN 'F' THEN 'preventive' WHEN 'O' THEN 'corrective' ELSE NULL END"),
        ("performed_date", _SHIFTED.format(k="o_orderkey", d="o_orderdate")),
        ("downtime_hours",
         "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 48 AS DOUBLE) / 2 END"),
        ("parts_replaced", "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'belt,filter' END"),
        ("cost", "o_totalprice"),
    ]),
    # Shift 0 of the output rows stays an orphan: its id is NULL here.
    "shifts": ("lineitem", [
        ("shift_id", "CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linenumber % 4 END"),
        ("shift_name",
         "CASE l_linenumber % 4 WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' WHEN 3 THEN 'Night' END"),
        ("start_time",
         "CASE l_linenumber % 4 WHEN 1 THEN '06:00' WHEN 2 THEN '14:00' WHEN 3 THEN '22:00' END"),
        ("end_time",
         "CASE l_linenumber % 4 WHEN 1 THEN '14:00' WHEN 2 THEN '22:00' WHEN 3 THEN '06:00' END"),
        ("shift_duration_hrs", "8"),
    ]),
    "maintenance_schedules": ("nation", [
        ("schedule_id", "n_nationkey"),
        ("machine_id", "n_nationkey * 4"),
        ("frequency", "'monthly'"),
    ]),
    "alerts": ("events", [
        ("alert_id", "CASE WHEN event_id % 53 = 0 THEN NULL ELSE event_id END"),
        ("sensor_id", "user_id * 15"),
        ("machine_id", "event_id % 110"),
        ("alert_type",
         "CASE event_type WHEN 'click' THEN 'threshold_exceeded' WHEN 'view' THEN 'quality_drop' "
         "WHEN 'signup' THEN 'machine_offline' WHEN 'error' THEN 'sensor_offline' "
         "ELSE 'manual' END"),
        ("severity",
         "CASE event_id % 5 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' "
         "WHEN 3 THEN 'low' ELSE NULL END"),
        ("triggered_at", "ts"),
        ("acknowledged_at",
         "CASE WHEN event_id % 4 IN (0, 1) THEN ts + INTERVAL 5 MINUTE ELSE NULL END"),
        ("resolved_at",
         "CASE WHEN event_id % 4 IN (1, 2) THEN ts + INTERVAL 20 MINUTE "
         "+ (event_id % 600) * INTERVAL 1 SECOND ELSE NULL END"),
        ("resolved_by",
         "CASE WHEN event_id % 8 = 1 THEN concat('worker_', user_id) ELSE NULL END"),
    ]),
    "sensor_readings": ("events", [
        ("reading_id", "event_id"),
        ("sensor_id", "user_id * 15"),
        ("machine_id", "event_id % 110"),
        ("timestamp", "CAST(date_trunc('second', ts) AS STRING)"),
        ("value", "value"),
        ("unit", "'C'"),
        ("quality_score", "event_id % 101"),
        ("is_anomaly", "value > 100"),
    ]),
}

# Tables that are the distinct rows of their projection.
DISTINCT = frozenset({"shifts"})

BRONZE_TABLES = sorted(ADAPTER)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One adapter table as a Spark DataFrame."""
    source, cols = ADAPTER[table]
    out = driver_table(spark, sf_dir, source).selectExpr(*[f"{expr} AS `{name}`" for name, expr in cols])
    return out.distinct() if table in DISTINCT else out


def bronze_sql(table: str) -> str:
    """The same adapter table as a SQL SELECT (for the oracle)."""
    source, cols = ADAPTER[table]
    return (f"SELECT {'DISTINCT ' if table in DISTINCT else ''}"
            + ", ".join(f'{expr} AS "{name}"' for name, expr in cols) + f" FROM {source}")
