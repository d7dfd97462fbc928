"""DuckDB oracle SQL for every registered query.

Written independently of the DataFrame code: only the adapter expressions and
the declared column types are shared (they define the inputs, not the logic
under test).  DuckDB differences handled here: NULLs sort last by default
(Spark: first), ``dayofweek`` is 0-based, ``epoch`` replaces ``unix_timestamp``.
"""

from __future__ import annotations

from harness.adapter import ADAPTER, bronze_sql
from millstar.schemas import BRONZE_SCHEMAS, GOLD_COLUMNS, TABLE_IDS

_DUCK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "int": "INTEGER"}


def q(name: str) -> str:
    return f'"{name}"'


def _columns(table: str) -> list[str]:
    return [c for c, _ in ADAPTER[table][1]]


def _cast_list(table: str, text: tuple[str, ...] = ()) -> str:
    declared = {f.name: f.dataType.simpleString() for f in BRONZE_SCHEMAS[table].fields}
    declared.update({c: "string" for c in text})
    return ", ".join(f"CAST({q(c)} AS {_DUCK_TYPES[declared[c]]}) AS {q(c)}"
                     for c in _columns(table))


# Table rules in SQL (applied after DISTINCT, id filter and casts; no second DISTINCT).
def _rules(table: str, base: str) -> str:
    if table == "alerts":
        return (
            "SELECT alert_id, sensor_id, machine_id, alert_type, severity, triggered_at, "
            "COALESCE(acknowledged_at, resolved_at) AS acknowledged_at, resolved_at, "
            "COALESCE(resolved_by, 'unknown') AS resolved_by, "
            "CASE WHEN resolved_at IS NOT NULL THEN 'resolved' "
            "WHEN acknowledged_at IS NOT NULL THEN 'acknowledged' "
            f"ELSE 'pending' END AS alert_status FROM ({base}) AS r")
    fills = {"quality_checks": ("notes", "No notes provided"),
             "defects": ("corrective_action", "Corrective action not taken"),
             "maintenance_logs": ("parts_replaced", "No parts replaced")}
    if table in fills:
        col, text = fills[table]
        cols = ", ".join(f"COALESCE({q(c)}, '{text}') AS {q(c)}" if c == col else q(c)
                         for c in _columns(table))
        return f"SELECT {cols} FROM ({base}) AS r"
    return base


def silver_sql(table: str, bronze: str | None = None, text: tuple[str, ...] = ()) -> str:
    b = bronze or bronze_sql(table)
    idc = TABLE_IDS[table]
    base = (f"SELECT {_cast_list(table, text)} FROM (SELECT DISTINCT * FROM ({b}) AS b) AS d "
            f"WHERE {q(idc)} IS NOT NULL")
    return _rules(table, base)


# --- dimensions ---------------------------------------------------------------

def dim_date_sql(start: str = "DATE '2020-01-01'", end: str = "DATE '2030-12-31'",
                 bounds_from: str | None = None) -> str:
    """The calendar between ``start`` and ``end`` (expressions over ``bounds_from``)."""
    src = f"FROM {bounds_from}" if bounds_from else ""
    days = (f"SELECT CAST(unnest(generate_series(CAST({start} AS DATE), CAST({end} AS DATE), "
            f"INTERVAL 1 DAY)) AS DATE) AS d {src}")
    return (
        "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS date_actual, "
        "CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, "
        "CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number, "
        "monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS \"quarter\", "
        "CAST(year(d) AS INTEGER) AS \"year\", dayofweek(d) IN (0, 6) AS is_weekend, "
        "false AS is_holiday, "
        "'FY' || CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS fiscal_period "
        f"FROM ({days}) AS days")


DIM_TIME_SQL = (
    "SELECT CAST(h AS INTEGER) AS time_sk, CAST(h AS BIGINT) AS hour_of_day, "
    "0 AS minute_of_hour, "
    "CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon' "
    "ELSE 'Evening' END AS time_of_day, "
    "CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS period_am_pm, "
    "lpad(CAST(h AS VARCHAR), 2, '0') || ':00 - ' || lpad(CAST(h AS VARCHAR), 2, '0') || ':59' "
    "AS hour_band, (h BETWEEN 6 AND 9) OR (h BETWEEN 17 AND 20) AS is_peak_hour "
    "FROM range(0, 24) AS t(h)")

# Simple dimension columns (key first), as the gold contract lists them.
SIMPLE_DIMS_SQL = {
    "dim_factory": ("factories", "factory_sk", "factory_id",
                    ["factory_id", "factory_name", "location", "region", "manager_name",
                     "total_area_sqm"]),
    "dim_production_line": ("production_lines", "line_sk", "line_id",
                            ["line_id", "factory_id", "line_name", "line_type",
                             "capacity_units_hour", "installed_date", "status"]),
    "dim_machine": ("machines", "machine_sk", "machine_id",
                    ["machine_id", "line_id", "machine_name", "machine_type", "manufacturer",
                     "model", "serial_number", "installation_date", "operating_hours",
                     "is_active"]),
    "dim_sensor": ("sensors", "sensor_sk", "sensor_id",
                   ["sensor_id", "sensor_name", "sensor_type", "unit", "min_threshold",
                    "max_threshold", "machine_name", "is_active"]),
    "dim_shift": ("shifts", "shift_sk", "shift_id",
                  ["shift_id", "shift_name", "start_time", "end_time", "shift_duration_hrs"]),
    "dim_operator": ("operators", "operator_sk", "operator_id",
                     ["operator_id", "full_name", "employee_code", "certification_level",
                      "role_type", "hire_date"]),
    "dim_order": ("production_orders", "order_sk", "order_id",
                  ["order_id", "product_code", "quantity_ordered", "start_date",
                   "target_end_date", "priority", "status"]),
}


def simple_dim_sql(name: str, silver: str | None = None) -> str:
    table, sk, nk, cols = SIMPLE_DIMS_SQL[name]
    src = silver or silver_sql(table)
    return f"SELECT {q(nk)} AS {sk}, {', '.join(q(c) for c in cols)} FROM ({src}) AS s"


def dim_product_sql(orders_silver: str | None = None) -> str:
    src = orders_silver or silver_sql("production_orders")
    return ("SELECT CAST(row_number() OVER (ORDER BY product_code NULLS FIRST) AS INTEGER) "
            "AS product_sk, product_code, product_code AS product_name, "
            "'units' AS unit_of_measure, 'medium' AS priority_default "
            f"FROM (SELECT DISTINCT product_code FROM ({src}) AS s) AS p")


def dim_alert_type_sql() -> str:
    src = silver_sql("alerts")
    return (
        "SELECT CAST(row_number() OVER (ORDER BY alert_type NULLS FIRST, severity NULLS FIRST) "
        "AS INTEGER) AS alert_type_sk, alert_type AS alert_type_name, "
        "severity AS severity_level, "
        "CASE WHEN contains(alert_type, 'threshold') THEN 'Quality' "
        "WHEN contains(alert_type, 'quality') THEN 'Environmental' "
        "WHEN contains(alert_type, 'machine') THEN 'Mechanical' "
        "WHEN contains(alert_type, 'offline') THEN 'Electrical' ELSE 'Operational' END AS category, "
        "COALESCE(severity IN ('critical', 'high'), false) AS requires_ack "
        f"FROM (SELECT DISTINCT alert_type, severity FROM ({src}) AS s) AS p")


def dim_maintenance_type_sql() -> str:
    src = silver_sql("maintenance_logs")
    return ("SELECT CAST(row_number() OVER (ORDER BY maintenance_type NULLS FIRST) AS INTEGER) "
            "AS maint_type_sk, maintenance_type AS maint_type_name "
            f"FROM (SELECT DISTINCT maintenance_type FROM ({src}) AS s) AS p")


def dim_sql(name: str) -> str:
    if name == "dim_date":
        return dim_date_sql()
    if name == "dim_time":
        return DIM_TIME_SQL
    if name in SIMPLE_DIMS_SQL:
        return simple_dim_sql(name)
    return {"dim_product": dim_product_sql, "dim_alert_type": dim_alert_type_sql,
            "dim_maintenance_type": dim_maintenance_type_sql}[name]()


def _with(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def _yyyymmdd(expr: str) -> str:
    return f"CAST(strftime(CAST({expr} AS DATE), '%Y%m%d') AS INTEGER)"


# --- facts ----------------------------------------------------------------------

def fact_sensor_readings_sql() -> str:
    ctes = {"r": silver_sql("sensor_readings"), "dd": dim_sql("dim_date"),
            "dt": DIM_TIME_SQL, "ds": dim_sql("dim_sensor"), "dm": dim_sql("dim_machine"),
            "dl": dim_sql("dim_production_line")}
    ts = 'CAST(r."timestamp" AS TIMESTAMP)'
    body = (
        "SELECT CAST(r.reading_id AS BIGINT) AS sensor_reading_sk, dd.date_sk, dt.time_sk, "
        "ds.sensor_sk, dm.machine_sk, dl.line_sk, "
        f"{ts} AS \"timestamp\", CAST(r.value AS DOUBLE) AS value, "
        "CAST(r.is_anomaly AS BOOLEAN) AS is_anomaly, "
        "CAST(r.quality_score AS INTEGER) AS quality_score "
        "FROM r "
        f"LEFT JOIN dd ON {_yyyymmdd(ts)} = dd.date_sk "
        f"LEFT JOIN dt ON hour({ts}) = dt.hour_of_day "
        "LEFT JOIN ds ON r.sensor_id = ds.sensor_id "
        "LEFT JOIN dm ON r.machine_id = dm.machine_id "
        "LEFT JOIN dl ON dm.line_id = dl.line_id")
    return _with(ctes, body)


def fact_alerts_body(select: str) -> str:
    ctes = {"a": silver_sql("alerts"), "dd": dim_sql("dim_date"), "dt": DIM_TIME_SQL,
            "ds": dim_sql("dim_sensor"), "dm": dim_sql("dim_machine"),
            "dl": dim_sql("dim_production_line"), "dat": dim_alert_type_sql()}
    body = (
        f"SELECT {select} FROM a "
        f"LEFT JOIN dd ON {_yyyymmdd('a.triggered_at')} = dd.date_sk "
        "LEFT JOIN dt ON hour(a.triggered_at) = dt.hour_of_day "
        "LEFT JOIN ds ON a.sensor_id = ds.sensor_id "
        "LEFT JOIN dm ON a.machine_id = dm.machine_id "
        "LEFT JOIN dl ON dm.line_id = dl.line_id "
        "LEFT JOIN dat ON a.alert_type = dat.alert_type_name AND a.severity = dat.severity_level")
    return _with(ctes, body)


FACT_ALERTS_COLS = (
    "dd.date_sk, dt.time_sk, ds.sensor_sk, dm.machine_sk, dl.line_sk, dat.alert_type_sk, "
    "CASE WHEN a.resolved_at IS NOT NULL THEN "
    "(floor(epoch(a.resolved_at)) - floor(epoch(a.triggered_at))) / 60 END "
    "AS resolution_time_min, "
    "a.acknowledged_at IS NOT NULL AS acknowledged_flag, a.severity AS severity_level")


def fact_quality_body(select: str) -> str:
    ctes = {"c": silver_sql("quality_checks"), "dd": dim_sql("dim_date"),
            "dl": dim_sql("dim_production_line"), "dord": dim_sql("dim_order"),
            "dop": dim_sql("dim_operator"), "dp": dim_product_sql()}
    body = (
        f"SELECT {select} FROM c "
        f"LEFT JOIN dd ON {_yyyymmdd('c.check_date')} = dd.date_sk "
        "LEFT JOIN dl ON c.line_id = dl.line_id "
        "LEFT JOIN dord ON c.order_id = dord.order_id "
        "LEFT JOIN dop ON c.inspector_id = dop.operator_id "
        "LEFT JOIN dp ON dord.product_code = dp.product_code")
    return _with(ctes, body)


FACT_QUALITY_COLS = (
    "dd.date_sk, dl.line_sk, dp.product_sk, dord.order_sk, dop.operator_sk, c.sample_size, "
    "c.defects_found, CASE WHEN c.sample_size > 0 THEN c.defects_found / c.sample_size * 100 "
    "ELSE 0.0 END AS defect_rate_pct, "
    "COALESCE(lower(c.result) = 'pass', false) AS check_passed")


def fact_maintenance_body(select: str) -> str:
    ctes = {"m": silver_sql("maintenance_logs"), "dd": dim_sql("dim_date"),
            "dm": dim_sql("dim_machine"), "dl": dim_sql("dim_production_line"),
            "dmt": dim_maintenance_type_sql(), "dop": dim_sql("dim_operator")}
    tech = ("CASE WHEN regexp_matches(m.performed_by, '\\d+') THEN "
            "CAST(regexp_extract(m.performed_by, '(\\d+)', 1) AS BIGINT) END")
    body = (
        f"SELECT {select} FROM m "
        f"LEFT JOIN dd ON {_yyyymmdd('m.performed_date')} = dd.date_sk "
        "LEFT JOIN dm ON m.machine_id = dm.machine_id "
        "LEFT JOIN dl ON dm.line_id = dl.line_id "
        "LEFT JOIN dmt ON m.maintenance_type = dmt.maint_type_name "
        f"LEFT JOIN dop ON {tech} = dop.operator_id")
    return _with(ctes, body)


FACT_MAINTENANCE_COLS = (
    "dd.date_sk, dm.machine_sk, dl.line_sk, dmt.maint_type_sk AS maintenance_type_sk, "
    "dop.operator_sk, m.cost AS cost_amount, m.downtime_hours, "
    "COALESCE(m.downtime_hours, 0) AS labor_hours")


def fact_production_body(select: str, orders_bronze: str | None = None) -> str:
    orders = silver_sql("production_orders", orders_bronze)
    ctes = {"o": silver_sql("production_output"), "po": orders, "dd": dim_sql("dim_date"),
            "dsh": dim_sql("dim_shift"), "dp": dim_product_sql(orders),
            "dord": simple_dim_sql("dim_order", orders), "dl": dim_sql("dim_production_line"),
            "df": dim_sql("dim_factory")}
    body = (
        f"SELECT {select} FROM o "
        "LEFT JOIN po ON o.order_id = po.order_id "
        f"LEFT JOIN dd ON {_yyyymmdd('o.production_date')} = dd.date_sk "
        "LEFT JOIN dsh ON o.shift_id = dsh.shift_id "
        "LEFT JOIN dp ON po.product_code = dp.product_code "
        "LEFT JOIN dord ON o.order_id = dord.order_id "
        "LEFT JOIN dl ON o.line_id = dl.line_id "
        "LEFT JOIN df ON dl.factory_id = df.factory_id")
    return _with(ctes, body)


FACT_PRODUCTION_COLS = (
    f"dd.date_sk, {_yyyymmdd('o.production_date')} AS time_sk, df.factory_sk, dl.line_sk, "
    "dp.product_sk, dsh.shift_sk, dord.order_sk, o.units_produced, o.units_defective, "
    "o.downtime_minutes, o.efficiency_percentage, po.quantity_ordered AS target_units, "
    "CASE WHEN o.units_produced > 0 THEN (480 - o.downtime_minutes) / o.units_produced END "
    "AS cycle_time_avg")

_SK_CHECK = "count(*) AS n_rows, count(*) AS n_distinct_sk, count(*) AS n_non_null_sk"


def _clean_sql(table: str) -> str:
    b = bronze_sql(table)
    return silver_sql(table, f"{b} UNION ALL {b}")


ORACLE: dict[str, str] = {
    "fact_sensor_readings": fact_sensor_readings_sql(),
    "fact_alerts": fact_alerts_body(FACT_ALERTS_COLS),
    "fact_alerts_sk": fact_alerts_body(_SK_CHECK),
    "fact_quality": fact_quality_body(FACT_QUALITY_COLS),
    "fact_quality_sk": fact_quality_body(_SK_CHECK),
    "fact_maintenance": fact_maintenance_body(FACT_MAINTENANCE_COLS),
    "fact_maintenance_sk": fact_maintenance_body(_SK_CHECK),
    "fact_production": fact_production_body(FACT_PRODUCTION_COLS),
    "fact_production_sk": fact_production_body(_SK_CHECK),
    "fact_production_fanout": fact_production_body(
        FACT_PRODUCTION_COLS,
        orders_bronze=(f"{bronze_sql('production_orders')} UNION ALL "
                       f"SELECT order_id, product_code, quantity_ordered, start_date, "
                       f"target_end_date, priority, 'X' AS status "
                       f"FROM ({bronze_sql('production_orders')}) AS b "
                       f"WHERE priority = '1-URGENT'")),
    "clean_dedup": f"SELECT DISTINCT * FROM ({bronze_sql('defects')}) AS b",
    "clean_null_id": f"SELECT * FROM ({bronze_sql('defects')}) AS b WHERE defect_id IS NOT NULL",
    "clean_base": (f"SELECT DISTINCT * FROM ({bronze_sql('production_output')} UNION ALL "
                   f"{bronze_sql('production_output')}) AS b WHERE output_id IS NOT NULL"),
    "clean_typed_all_null": silver_sql(
        "alerts",
        "SELECT alert_id, sensor_id, machine_id, alert_type, severity, triggered_at, "
        "acknowledged_at, resolved_at, CAST(NULL AS INTEGER) AS resolved_by "
        f"FROM ({bronze_sql('alerts')}) AS b"),
    "dim_date": dim_date_sql(
        start="min_d", end="max_d",
        bounds_from=("(SELECT min(production_date) AS min_d, max(production_date) AS max_d "
                     f"FROM ({silver_sql('production_output')}) AS s) AS bounds")),
    "dim_time": (f"SELECT * FROM ({DIM_TIME_SQL}) AS t WHERE hour_of_day IN "
                 f"(SELECT DISTINCT hour(CAST(\"timestamp\" AS TIMESTAMP)) "
                 f"FROM ({silver_sql('sensor_readings')}) AS s)"),
    "dense_sk_range": ("SELECT CAST(row_number() OVER (ORDER BY p_name NULLS FIRST) AS BIGINT) "
                       "AS name_sk, p_name FROM (SELECT DISTINCT p_name FROM part) AS p"),
    "dense_sk_lineitem": ("SELECT CAST(row_number() OVER (ORDER BY l_orderkey NULLS FIRST, "
                          "l_linenumber NULLS FIRST) AS BIGINT) AS line_sk, l_orderkey, "
                          "l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber "
                          "FROM lineitem) AS p"),
}
for _f in ("fact_sensor_readings", "fact_alerts", "fact_quality", "fact_maintenance",
           "fact_production"):
    ORACLE[f"{_f}_shuffle_joins"] = ORACLE[_f]
for _f in ("fact_production", "fact_quality"):
    ORACLE[f"{_f}_bucketed"] = ORACLE[_f]
ORACLE["fact_alerts_keyed"] = fact_alerts_body(
    "CAST(a.alert_id AS BIGINT) AS alert_sk, " + FACT_ALERTS_COLS)
ORACLE["fact_quality_keyed"] = fact_quality_body(
    "CAST(c.check_id AS BIGINT) AS quality_sk, " + FACT_QUALITY_COLS)
ORACLE["fact_maintenance_keyed"] = fact_maintenance_body(
    "CAST(m.log_id AS BIGINT) AS maintenance_sk, " + FACT_MAINTENANCE_COLS)
ORACLE["fact_production_keyed"] = fact_production_body(
    "CAST(o.output_id AS BIGINT) AS production_sk, " + FACT_PRODUCTION_COLS)
for _t in ("alerts", "quality_checks", "defects", "maintenance_logs", "factories",
           "production_lines", "machines", "sensors", "operators", "production_orders",
           "production_output", "sensor_readings", "maintenance_schedules", "shifts"):
    ORACLE[f"clean_{_t}"] = _clean_sql(_t)
for _d in ("dim_factory", "dim_production_line", "dim_machine", "dim_sensor", "dim_operator",
           "dim_order", "dim_product", "dim_alert_type", "dim_maintenance_type", "dim_shift"):
    ORACLE[_d] = dim_sql(_d)


# --- storage, landing, export, pipeline -------------------------------------

def _orders_version_sql(i: int) -> str:
    return ("SELECT order_id, product_code, quantity_ordered, start_date, target_end_date, "
            f"priority, status || '-v{i}' AS status, {'product_code' if i == 1 else 'NULL'} AS note "
            f"FROM ({bronze_sql('production_orders')}) AS b")


ORACLE["snapshot_latest"] = _orders_version_sql(1)
ORACLE["snapshot_all_versions"] = " UNION ALL ".join(_orders_version_sql(i) for i in range(3))
ORACLE["payload_explode"] = f"SELECT {_cast_list('machines')} FROM ({bronze_sql('machines')}) AS b"
ORACLE["streaming_landing"] = ORACLE["payload_explode"]
ORACLE["csv_roundtrip"] = fact_sensor_readings_sql()


def _pipeline_counts_sql() -> str:
    parts = {
        "dim_date": f"SELECT count(*) FROM ({dim_date_sql()}) AS x",
        "dim_time": f"SELECT count(*) FROM ({DIM_TIME_SQL}) AS x",
        "dim_product": f"SELECT count(*) FROM ({dim_product_sql()}) AS x",
        "dim_alert_type": f"SELECT count(*) FROM ({dim_alert_type_sql()}) AS x",
        "dim_maintenance_type": f"SELECT count(*) FROM ({dim_maintenance_type_sql()}) AS x",
        "fact_alerts": fact_alerts_body("count(*)"),
        "fact_quality": fact_quality_body("count(*)"),
        "fact_maintenance": fact_maintenance_body("count(*)"),
        "fact_production": fact_production_body("count(*)"),
        "fact_sensor_readings": f"SELECT count(*) FROM ({fact_sensor_readings_sql()}) AS x",
    }
    for name in SIMPLE_DIMS_SQL:
        parts[name] = f"SELECT count(*) FROM ({simple_dim_sql(name)}) AS x"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(({sql}) AS BIGINT) AS n_rows"
        for name, sql in sorted(parts.items()))


ORACLE["pipeline_counts"] = _pipeline_counts_sql()
ORACLE["pipeline_run"] = fact_alerts_body(FACT_ALERTS_COLS)


# --- ids as text -------------------------------------------------------------------

# Table -> (id column, prefix) of the queries with text ids.
TEXT_IDS = {"alerts": ("alert_id", "A"), "defects": ("defect_id", "D"), "maintenance_logs": ("log_id", "L")}


def _text_bronze_sql(table: str, prefixes: dict[str, str]) -> str:
    cols = ", ".join(f"'{prefixes[c]}' || {q(c)} AS {q(c)}" if c in prefixes else q(c) for c in _columns(table))
    return f"SELECT {cols} FROM ({bronze_sql(table)}) AS b"


for _t, (_id, _prefix) in TEXT_IDS.items():
    ORACLE[f"clean_{_t}_string_id"] = silver_sql(_t, _text_bronze_sql(_t, {_id: _prefix}), (_id,))
ORACLE["fact_alerts_string_keys"] = fact_alerts_body(
    FACT_ALERTS_COLS.replace("ds.sensor_sk", "'S' || ds.sensor_sk AS sensor_sk")
    .replace("dm.machine_sk", "'M' || dm.machine_sk AS machine_sk"))

# --- open payload, storage, sinks ----------------------------------------------------

ORACLE["payload_open"] = (
    "SELECT 'machines' AS table_name, CAST(s_suppkey AS BIGINT) AS id, s_acctbal AS amount, "
    "'tag-' || s_suppkey AS note FROM supplier UNION ALL "
    "SELECT 'energy_usage', CAST(n_nationkey AS BIGINT), n_nationkey + 0.5, n_name FROM nation")
ORACLE["parquet_write_modes"] = (
    f"SELECT {_cast_list('production_orders')} FROM ({bronze_sql('production_orders')} UNION ALL "
    f"{bronze_sql('production_orders')}) AS b")
ORACLE["csv_empty_strings"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS id, CAST(l_linenumber AS BIGINT) AS line, "
    "CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' a,\"' || l_linestatus || '\" ' END AS note "
    "FROM lineitem")
ORACLE["payload_one_document"] = (f"SELECT {_cast_list('production_output')} "
                                  f"FROM ({bronze_sql('production_output')}) AS b")
for _f in ("fact_alerts", "fact_production", "fact_maintenance", "fact_quality"):
    _order = ", ".join(f"{q(c)} ASC NULLS FIRST" for c in GOLD_COLUMNS[_f][1:])
    ORACLE[f"{_f}_dense"] = (f"SELECT row_number() OVER (ORDER BY {_order}) AS {GOLD_COLUMNS[_f][0]}, * "
                             f"FROM ({ORACLE[_f]}) AS f")
ORACLE["silver_increments"] = ORACLE["clean_quality_checks"]
ORACLE["landing_batches"] = ORACLE["clean_machines"]
ORACLE["snapshot_replaced"] = _orders_version_sql(1)
ORACLE["csv_one_column"] = (
    "SELECT CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '  ' WHEN 4 THEN '\\N' "
    "ELSE l_linestatus || chr(10) END AS note FROM lineitem")
_DRIFT = ("CAST(order_id AS BIGINT) AS order_id, CAST(quantity_ordered AS INTEGER) AS quantity, "
          f"CAST(start_date AS DATE) AS started FROM ({bronze_sql('production_orders')}) AS b")
ORACLE["snapshot_type_drift"] = (
    "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(quantity AS DOUBLE) AS quantity, "
    f"CAST(started AS TIMESTAMP) AS started, NULL::VARCHAR AS note FROM (SELECT {_DRIFT}) AS v1 UNION ALL "
    f"SELECT 'P' || order_id, quantity + 0.5, CAST(started AS TIMESTAMP), 'late' FROM (SELECT {_DRIFT}) AS v2")
ORACLE["export_every_table"] = (
    f"SELECT 'fact_alerts' AS table_name, CAST(sensor_sk AS BIGINT) AS id, severity_level AS note "
    f"FROM ({ORACLE['fact_alerts']}) AS f UNION ALL "
    f"SELECT 'dim_machine', machine_id, machine_name FROM ({dim_sql('dim_machine')}) AS m WHERE machine_id % 2 = 0 "
    f"UNION ALL SELECT 'dim_operator', operator_id, upper(full_name) FROM ({dim_sql('dim_operator')}) AS o")
ORACLE["export_one"] = ORACLE["dim_order"]
ORACLE["csv_write_all"] = (
    f"SELECT 'dim_machine' AS table_name, count(*) AS n, CAST(sum(machine_sk) AS BIGINT) AS s "
    f"FROM ({dim_sql('dim_machine')}) AS a UNION ALL "
    f"SELECT 'dim_operator', count(*), CAST(sum(operator_sk) AS BIGINT) FROM ({dim_sql('dim_operator')}) AS b")
ORACLE["parquet_sink"] = ORACLE["dim_sensor"]

# --- what the pipeline wrote ----------------------------------------------------------

for _d in ("dim_factory", "dim_production_line", "dim_machine", "dim_sensor", "dim_operator", "dim_order",
           "dim_shift", "dim_product", "dim_alert_type", "dim_maintenance_type"):
    ORACLE[f"gold_{_d}"] = ORACLE[_d]
ORACLE["gold_dim_time"] = ORACLE["dim_time"]
ORACLE["gold_dim_date"] = (f"SELECT * FROM ({dim_date_sql()}) AS d WHERE date_sk IN "
                           f"(SELECT date_sk FROM ({ORACLE['fact_production']}) AS f)")
ORACLE["gold_fact_sensor_readings"] = ORACLE["fact_sensor_readings"]
for _f in ("fact_alerts", "fact_quality", "fact_maintenance", "fact_production"):
    ORACLE[f"gold_{_f}"] = ORACLE[f"{_f}_keyed"]
