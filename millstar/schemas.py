"""Declared bronze schemas, the table registry and the gold column contracts.

JSON carries no types, so a bronze table can arrive with an all-NULL column
typed as an integer, or with dates as strings.  The cleaner's type step casts
every declared column that is present to the type below (ANSI casts: malformed
values fail the job rather than turning into NULL).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze table -> its id column (the cleaning registry).
TABLE_IDS: dict[str, str] = {
    "alerts": "alert_id",
    "defects": "defect_id",
    "factories": "factory_id",
    "machines": "machine_id",
    "maintenance_logs": "log_id",
    "maintenance_schedules": "schedule_id",
    "operators": "operator_id",
    "production_lines": "line_id",
    "production_orders": "order_id",
    "production_output": "output_id",
    "quality_checks": "check_id",
    "sensor_readings": "reading_id",
    "sensors": "sensor_id",
    "shifts": "shift_id",
}


# Columns that name a row of this or another table.  Such a column that arrives as
# text stays text ("A001"): ids are compared, never computed with.
KEY_COLUMNS: frozenset[str] = frozenset(TABLE_IDS.values()) | {"inspector_id"}


_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(),
          "DOUBLE": T.DoubleType(), "DATE": T.DateType(), "BOOLEAN": T.BooleanType(),
          "TIMESTAMP": T.TimestampType()}


def _schema(spec: str) -> T.StructType:
    """``"name TYPE, ..."`` with flat primitive types -> StructType (no session needed)."""
    fields = []
    for part in spec.split(","):
        name, type_name = part.split()
        fields.append(T.StructField(name, _TYPES[type_name], True))
    return T.StructType(fields)


# Declared bronze column types (our choice; the names are the contract).
BRONZE_SCHEMAS: dict[str, T.StructType] = {
    "factories": _schema(
        "factory_id BIGINT, factory_name STRING, location STRING, region STRING, "
        "manager_name STRING, total_area_sqm BIGINT"),
    "production_lines": _schema(
        "line_id BIGINT, factory_id BIGINT, line_name STRING, line_type STRING, "
        "capacity_units_hour BIGINT, installed_date DATE, status STRING"),
    "machines": _schema(
        "machine_id BIGINT, line_id BIGINT, machine_name STRING, machine_type STRING, "
        "manufacturer STRING, model STRING, serial_number STRING, installation_date DATE, "
        "operating_hours DOUBLE, is_active BOOLEAN"),
    "sensors": _schema(
        "sensor_id BIGINT, sensor_name STRING, sensor_type STRING, unit STRING, "
        "min_threshold DOUBLE, max_threshold DOUBLE, machine_name STRING, is_active BOOLEAN"),
    "shifts": _schema(
        "shift_id BIGINT, shift_name STRING, start_time STRING, end_time STRING, "
        "shift_duration_hrs BIGINT"),
    "operators": _schema(
        "operator_id BIGINT, full_name STRING, employee_code STRING, "
        "certification_level STRING, role_type STRING, hire_date DATE"),
    "production_orders": _schema(
        "order_id BIGINT, product_code STRING, quantity_ordered BIGINT, start_date DATE, "
        "target_end_date DATE, priority STRING, status STRING"),
    "production_output": _schema(
        "output_id BIGINT, order_id BIGINT, line_id BIGINT, shift_id BIGINT, "
        "production_date DATE, units_produced BIGINT, units_defective BIGINT, "
        "downtime_minutes BIGINT, efficiency_percentage DOUBLE"),
    "quality_checks": _schema(
        "check_id BIGINT, order_id BIGINT, line_id BIGINT, inspector_id BIGINT, "
        "check_date DATE, result STRING, defects_found BIGINT, sample_size BIGINT, "
        "notes STRING"),
    "defects": _schema(
        "defect_id BIGINT, defect_type STRING, corrective_action STRING"),
    "maintenance_logs": _schema(
        "log_id BIGINT, machine_id BIGINT, performed_by STRING, maintenance_type STRING, "
        "performed_date DATE, downtime_hours DOUBLE, parts_replaced STRING, cost DOUBLE"),
    "maintenance_schedules": _schema(
        "schedule_id BIGINT, machine_id BIGINT, frequency STRING"),
    "alerts": _schema(
        "alert_id BIGINT, sensor_id BIGINT, machine_id BIGINT, alert_type STRING, "
        "severity STRING, triggered_at TIMESTAMP, acknowledged_at TIMESTAMP, "
        "resolved_at TIMESTAMP, resolved_by STRING"),
    # The reading time stays a string in silver; the fact parses it.
    "sensor_readings": _schema(
        "reading_id BIGINT, sensor_id BIGINT, machine_id BIGINT, timestamp STRING, "
        "value DOUBLE, unit STRING, quality_score BIGINT, is_anomaly BOOLEAN"),
}

# Gold output contracts, column order of every dimension and fact.
GOLD_COLUMNS: dict[str, list[str]] = {
    "dim_date": ["date_sk", "date_actual", "day_of_week", "day_name", "week_of_year",
                 "month_number", "month_name", "quarter", "year", "is_weekend",
                 "is_holiday", "fiscal_period"],
    "dim_time": ["time_sk", "hour_of_day", "minute_of_hour", "time_of_day",
                 "period_am_pm", "hour_band", "is_peak_hour"],
    "dim_product": ["product_sk", "product_code", "product_name", "unit_of_measure",
                    "priority_default"],
    "dim_alert_type": ["alert_type_sk", "alert_type_name", "severity_level", "category",
                       "requires_ack"],
    "dim_maintenance_type": ["maint_type_sk", "maint_type_name"],
    "fact_production": ["production_sk", "date_sk", "time_sk", "factory_sk", "line_sk",
                        "product_sk", "shift_sk", "order_sk", "units_produced",
                        "units_defective", "downtime_minutes", "efficiency_percentage",
                        "target_units", "cycle_time_avg"],
    "fact_quality": ["quality_sk", "date_sk", "line_sk", "product_sk", "order_sk",
                     "operator_sk", "sample_size", "defects_found", "defect_rate_pct",
                     "check_passed"],
    "fact_sensor_readings": ["sensor_reading_sk", "date_sk", "time_sk", "sensor_sk",
                             "machine_sk", "line_sk", "timestamp", "value", "is_anomaly",
                             "quality_score"],
    "fact_maintenance": ["maintenance_sk", "date_sk", "machine_sk", "line_sk",
                         "maintenance_type_sk", "operator_sk", "cost_amount",
                         "downtime_hours", "labor_hours"],
    "fact_alerts": ["alert_sk", "date_sk", "time_sk", "sensor_sk", "machine_sk", "line_sk",
                    "alert_type_sk", "resolution_time_min", "acknowledged_flag",
                    "severity_level"],
}
