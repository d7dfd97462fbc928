"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through the adapter and runs the library
over the whole tables.  Fact keys made by ``monotonically_increasing_id`` are not
reproducible by any other engine, so the fact queries leave them out and the
``*_sk`` queries check their uniqueness (row count == distinct key count).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.adapter import BRONZE_TABLES, bronze, driver_table
from harness.landing import one_document, pack_pages
from millstar.operators import cleaning, dimensions, facts
from millstar.operators.dense_key import dense_key
from millstar.plans.pipeline import Layout, TransformResult, clean_all, run_pipeline, transform
from millstar.schemas import BRONZE_SCHEMAS, GOLD_COLUMNS
from millstar.session import scratch_path
from millstar.sinks.csv import CsvSink, read_csv_export
from millstar.sinks.base import ParquetSink
from millstar.sinks.export import export_table, export_tables
from millstar.sources import feed, payload, snapshots

Query = Callable[[SparkSession, str], DataFrame]


# --- building blocks ---------------------------------------------------------

def silver(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return cleaning.clean_table(bronze(spark, sf, table), table)


def dimension(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name == "dim_date":
        return dimensions.build_dim_date(spark)
    if name == "dim_time":
        return dimensions.build_dim_time(spark)
    if name in dimensions.KEYED_COPIES:
        cfg = dimensions.KEYED_COPIES[name]
        return dimensions.keyed_copy(silver(spark, sf, cfg.table), cfg)
    if name == "dim_product":
        return dimensions.build_dim_product(silver(spark, sf, "production_orders"))
    if name == "dim_alert_type":
        return dimensions.build_dim_alert_type(silver(spark, sf, "alerts"))
    if name == "dim_maintenance_type":
        return dimensions.build_dim_maintenance_type(silver(spark, sf, "maintenance_logs"))
    raise KeyError(name)


# Source id used as the reproducible fact key by the *_keyed queries.
KEYED_FACTS = {"fact_alerts": "alert_id", "fact_quality": "check_id",
               "fact_maintenance": "log_id", "fact_production": "output_id"}

_runs: dict[tuple[str, str], TransformResult] = {}


def pipeline_layers(spark: SparkSession, sf: str) -> TransformResult:
    """Bronze -> silver -> gold over all adapter tables, run once per session and input.

    Facts take their keys from the source ids, so every written value can be compared.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _runs:
        layout, version = Layout.under(scratch_path(spark, "layers")), "20260101T000000"
        for t in BRONZE_TABLES:
            snapshots.write_snapshot(bronze(spark, sf, t), f"{layout.bronze}/{t}", version)
        _runs[key] = transform(spark, layout, version, fact_sk_from=KEYED_FACTS)
    return _runs[key]


def fact(spark: SparkSession, sf: str, name: str,
         broadcast_max_rows: int | None = None, sk_from: str | None = None) -> DataFrame:
    """One fact built from the written silver and gold layers, as the pipeline builds it."""
    layers = pipeline_layers(spark, sf)
    tables, dim_names = facts.FACT_REQUIREMENTS[name]
    dims = {d: layers.dimensions[d] for d in dim_names}
    dims.update({t: layers.silver[t] for t in tables[1:]})
    opts = {"sk_from": sk_from} if sk_from else {}
    return facts.FACT_BUILDERS[name](layers.silver[facts.FACT_SOURCE[name]], dims,
                                     broadcast_max_rows=broadcast_max_rows, **opts)


def _without_sk(df: DataFrame, name: str) -> DataFrame:
    return df.select(GOLD_COLUMNS[name][1:])


def _sk_check(df: DataFrame, sk: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(sk).alias("n_distinct_sk"),
                  F.count(sk).alias("n_non_null_sk"))


# --- queries ----------------------------------------------------------------

def q_fact_sensor_readings(spark, sf):
    return fact(spark, sf, "fact_sensor_readings")


def _fact_query(name: str) -> Query:
    def run(spark, sf):
        return _without_sk(fact(spark, sf, name), name)
    run.__name__ = f"q_{name}"
    return run


def _fact_sk_query(name: str) -> Query:
    def run(spark, sf):
        return _sk_check(fact(spark, sf, name), GOLD_COLUMNS[name][0])
    run.__name__ = f"q_{name}_sk"
    return run


def _fact_shuffle_query(name: str) -> Query:
    """The same fact with every lookup forced to a shuffle join (broadcast bound 0)."""
    def run(spark, sf):
        df = fact(spark, sf, name, broadcast_max_rows=0)
        return df if name == "fact_sensor_readings" else _without_sk(df, name)
    run.__name__ = f"q_{name}_shuffle_joins"
    return run


def _fact_keyed_query(name: str) -> Query:
    """The fact with its key taken from the source id: every column comparable."""
    def run(spark, sf):
        return fact(spark, sf, name, sk_from=KEYED_FACTS[name])
    run.__name__ = f"q_{name}_keyed"
    return run


def q_fact_production_fanout(spark, sf):
    """Urgent orders landed twice (second version, other status): their facts fan out k*k."""
    orders = bronze(spark, sf, "production_orders")
    extra = orders.where(F.col("priority") == "1-URGENT").withColumn("status", F.lit("X"))
    doubled = orders.unionByName(extra)
    tables, dim_names = facts.FACT_REQUIREMENTS["fact_production"]
    dims = {d: dimension(spark, sf, d) for d in dim_names if d not in ("dim_order", "dim_product")}
    orders_silver = cleaning.clean_table(doubled, "production_orders")
    dims["production_orders"] = orders_silver
    dims["dim_order"] = dimensions.keyed_copy(
        orders_silver, dimensions.KEYED_COPIES["dim_order"])
    dims["dim_product"] = dimensions.build_dim_product(orders_silver)
    src = silver(spark, sf, "production_output")
    return _without_sk(facts.build_fact_production(src, dims), "fact_production")


def _clean_query(table: str) -> Query:
    def run(spark, sf):
        b = bronze(spark, sf, table)
        # The same extraction landed twice: every row has an exact copy.
        return cleaning.clean_table(b.unionByName(b), table)
    run.__name__ = f"q_clean_{table}"
    return run


def q_clean_dedup(spark, sf):
    return cleaning.drop_exact_duplicates(bronze(spark, sf, "defects"))


def q_clean_null_id(spark, sf):
    return cleaning.drop_null_ids(bronze(spark, sf, "defects"), "defect_id")


def q_clean_base(spark, sf):
    """C5 as-is (no declared types, no rules) on production_output landed twice."""
    b = bronze(spark, sf, "production_output")
    return cleaning.clean(b.unionByName(b), cleaning.CleaningSpec("output_id"))


def q_clean_typed_all_null(spark, sf):
    """An all-NULL column lands as an integer; the declared type makes it a string."""
    b = bronze(spark, sf, "alerts").withColumn("resolved_by", F.lit(None).cast("int"))
    return cleaning.clean_table(b, "alerts")


def _dim_query(name: str) -> Query:
    def run(spark, sf):
        return dimension(spark, sf, name)
    run.__name__ = f"q_{name}"
    return run


def q_dim_date(spark, sf):
    """D1 over the calendar span the production data covers."""
    po = cleaning.clean_table(bronze(spark, sf, "production_output"), "production_output")
    bounds = po.agg(F.min("production_date").alias("start_date"),
                    F.max("production_date").alias("end_date"))
    return dimensions.calendar_from_bounds(bounds)


def q_dim_time(spark, sf):
    """D2 members referenced by sensor readings (hours present in the data)."""
    readings = silver(spark, sf, "sensor_readings")
    hours = readings.select(F.hour(F.to_timestamp("timestamp")).alias("h")).distinct()
    dt = dimensions.build_dim_time(spark)
    return dt.join(hours, dt["hour_of_day"] == hours["h"], "left_semi")


def q_dense_sk_lineitem(spark, sf):
    """D14 at large N: every distinct (order, line) pair of lineitem."""
    pairs = driver_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return dense_key(pairs, ["l_orderkey", "l_linenumber"], "line_sk")


def q_dense_sk_range(spark, sf):
    names = driver_table(spark, sf, "part").select("p_name").distinct()
    return dense_key(names, ["p_name"], "name_sk")


QUERIES: dict[str, Query] = {
    "fact_sensor_readings": q_fact_sensor_readings,
}
for _f in ("fact_alerts", "fact_quality", "fact_maintenance", "fact_production"):
    QUERIES[_f] = _fact_query(_f)
    QUERIES[f"{_f}_sk"] = _fact_sk_query(_f)
for _f in facts.FACT_BUILDERS:
    QUERIES[f"{_f}_shuffle_joins"] = _fact_shuffle_query(_f)
for _f in KEYED_FACTS:
    QUERIES[f"{_f}_keyed"] = _fact_keyed_query(_f)
QUERIES["fact_production_fanout"] = q_fact_production_fanout
QUERIES["clean_dedup"] = q_clean_dedup
QUERIES["clean_null_id"] = q_clean_null_id
QUERIES["clean_base"] = q_clean_base
QUERIES["clean_typed_all_null"] = q_clean_typed_all_null
for _t in ("alerts", "quality_checks", "defects", "maintenance_logs", "factories",
           "production_lines", "machines", "sensors", "operators", "production_orders",
           "production_output", "sensor_readings", "maintenance_schedules", "shifts"):
    QUERIES[f"clean_{_t}"] = _clean_query(_t)
QUERIES["dim_date"] = q_dim_date
QUERIES["dim_time"] = q_dim_time
for _d in ("dim_factory", "dim_production_line", "dim_machine", "dim_sensor",
           "dim_operator", "dim_order", "dim_product", "dim_alert_type",
           "dim_maintenance_type", "dim_shift"):
    QUERIES[_d] = _dim_query(_d)
QUERIES["dense_sk_range"] = q_dense_sk_range
QUERIES["dense_sk_lineitem"] = q_dense_sk_lineitem


# --- storage, landing, export, pipeline -------------------------------------


# Version stamps written out of order; the newest is the second one.
SNAPSHOT_STAMPS = ["20260101T100000", "20260103T150000", "20260102T120000"]


def _orders_version(spark, sf, i: int) -> DataFrame:
    b = bronze(spark, sf, "production_orders")
    out = b.withColumn("status", F.concat(F.col("status"), F.lit(f"-v{i}")))
    # Version 1, the newest, has a column more than the others.
    return out.withColumn("note", F.col("product_code")) if i == 1 else out


def _write_order_versions(spark, sf) -> str:
    table_dir = scratch_path(spark, "snapshots") + "/production_orders"
    for i, s in enumerate(SNAPSHOT_STAMPS):
        snapshots.write_snapshot(_orders_version(spark, sf, i), table_dir, s)
    return table_dir


def q_snapshot_latest(spark, sf):
    return snapshots.read_latest(spark, _write_order_versions(spark, sf))


def q_snapshot_all_versions(spark, sf):
    return snapshots.read_all_versions(spark, _write_order_versions(spark, sf))


def q_payload_explode(spark, sf):
    """Supplier-derived machines packed into JSON pages, landed, read back from bronze."""
    root = scratch_path(spark, "payload")
    pages = pack_pages(bronze(spark, sf, "machines"), "machines",
                       empty_tables=("maintenance_schedules",))
    pages.write.mode("overwrite").text(f"{root}/landing")
    schema = payload.payload_schema({t: BRONZE_SCHEMAS[t]
                                     for t in ("machines", "maintenance_schedules")})
    landed = payload.land_payload(spark, f"{root}/landing", f"{root}/bronze",
                                  "20260101T000000", schema, multi_line=False)
    if "maintenance_schedules" in landed:
        raise AssertionError("an empty table must not be landed")
    return snapshots.read_latest(spark, f"{root}/bronze/machines")


def q_streaming_landing(spark, sf):
    """Machines as one JSON document per file, landed by the streaming query with its default
    arguments; the newest version holds them all."""
    from millstar.streaming.landing import start_landing
    root = scratch_path(spark, "stream")
    (pack_pages(bronze(spark, sf, "machines"), "machines", page_rows=16)
     .write.option("maxRecordsPerFile", 1).text(f"{root}/landing"))
    schema = payload.payload_schema({"machines": BRONZE_SCHEMAS["machines"]})
    start_landing(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", schema).awaitTermination()
    return snapshots.read_latest(spark, f"{root}/bronze/machines")


def q_payload_open(spark, sf):
    """A payload with an undeclared table and an undeclared column: both are landed."""
    root = scratch_path(spark, "open")
    machines = bronze(spark, sf, "machines").withColumn(
        "asset_tag", F.concat(F.lit("tag-"), F.col("machine_id").cast("string")))
    energy = driver_table(spark, sf, "nation").selectExpr(
        "n_nationkey AS meter_id", "n_nationkey + 0.5D AS kwh", "n_name AS site")
    pack_pages(machines, "machines").unionByName(pack_pages(energy, "energy_usage")).write.text(f"{root}/landing")
    schema = payload.open_schema(spark, f"{root}/landing", BRONZE_SCHEMAS, multi_line=False)
    payload.land_payload(spark, f"{root}/landing", f"{root}/bronze", "20260101T000000", schema, multi_line=False)
    landed = snapshots.read_latest(spark, f"{root}/bronze/machines").selectExpr(
        "'machines' AS table_name", "machine_id AS id", "operating_hours AS amount", "asset_tag AS note")
    return landed.unionByName(snapshots.read_latest(spark, f"{root}/bronze/energy_usage").selectExpr(
        "'energy_usage' AS table_name", "meter_id AS id", "kwh AS amount", "site AS note"))


def q_parquet_write_modes(spark, sf):
    """Overwrite, then append the same rows, then read the folder."""
    path = scratch_path(spark, "modes") + "/orders"
    orders = cleaning.standardize_types(bronze(spark, sf, "production_orders"), BRONZE_SCHEMAS["production_orders"])
    snapshots.write_parquet(orders, path)
    snapshots.write_parquet(orders, path, "overwrite")
    snapshots.write_parquet(orders, path, "append")
    return snapshots.read_parquet(spark, path)


def q_csv_empty_strings(spark, sf):
    """NULL, the empty string and quoted text in one column survive the CSV round trip."""
    df = driver_table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS BIGINT) AS id", "CAST(l_linenumber AS BIGINT) AS line",
        "CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE concat(' a,\"', l_linestatus, '\" ') END AS note")
    path = CsvSink(scratch_path(spark, "csv-empty")).write(df, "notes")
    return read_csv_export(spark, path, df.schema)


def q_export_one(spark, sf):
    """One gold table exported by name."""
    root = scratch_path(spark, "one")
    df = dimension(spark, sf, "dim_order")
    snapshots.write_snapshot(df, f"{root}/gold/dim_order", "20260101T000000")
    return read_csv_export(spark, export_table(spark, f"{root}/gold", "dim_order", CsvSink(f"{root}/exports")),
                           df.schema)


def q_csv_write_all(spark, sf):
    """Several DataFrames through one CSV sink, counted and summed after reading back."""
    frames = {n: dimension(spark, sf, n) for n in ("dim_machine", "dim_operator")}
    paths = CsvSink(scratch_path(spark, "all"), ";").write_all(frames)
    parts = [read_csv_export(spark, paths[n], frames[n].schema, ";").agg(
        F.count(F.lit(1)).alias("n"), F.sum(frames[n].columns[0]).alias("s")).select(
        F.lit(n).alias("table_name"), "n", "s") for n in frames]
    return parts[0].unionByName(parts[1])


def q_parquet_sink(spark, sf):
    """The Parquet sink behind the same interface."""
    path = ParquetSink(scratch_path(spark, "sink")).write(dimension(spark, sf, "dim_sensor"), "dim_sensor")
    return snapshots.read_parquet(spark, path)


def q_csv_roundtrip(spark, sf):
    """fact_sensor_readings -> gold version -> CSV export -> read back with its schema."""
    root = scratch_path(spark, "csv")
    df = fact(spark, sf, "fact_sensor_readings")
    snapshots.write_snapshot(df, f"{root}/gold/fact_sensor_readings", "20260101T000000")
    out = export_tables(spark, f"{root}/gold", CsvSink(f"{root}/exports", compression="gzip"),
                        tables=["fact_sensor_readings"])
    return read_csv_export(spark, out["fact_sensor_readings"], df.schema)


def q_pipeline_counts(spark, sf):
    """Land all 14 adapter tables, run bronze -> silver -> gold, count every gold table."""
    layout = Layout.under(scratch_path(spark, "pipeline"))
    version = "20260101T000000"
    for t in BRONZE_TABLES:
        snapshots.write_snapshot(bronze(spark, sf, t), f"{layout.bronze}/{t}", version)
    result = transform(spark, layout, version)
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"),
                                                                "n_rows")
             for name, df in sorted({**result.dimensions, **result.facts}.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_pipeline_run(spark, sf):
    """P5 end to end: all 14 tables as JSON pages -> land -> transform -> CSV export;
    fact_alerts read back from its CSV export (key column left out, see fact_alerts)."""
    root = scratch_path(spark, "run")
    landing = [f"{root}/landing/{t}" for t in BRONZE_TABLES]
    for t, path in zip(BRONZE_TABLES, landing):
        pack_pages(bronze(spark, sf, t), t).write.option("compression", "gzip").text(path)
    layout = Layout.under(f"{root}/lake")
    out = run_pipeline(spark, landing, layout, "20260101T000000",
                       sink=CsvSink(layout.exports, compression="gzip"), multi_line=False)
    schema = out["transform"].facts["fact_alerts"].schema
    return _without_sk(read_csv_export(spark, out["exported"]["fact_alerts"], schema),
                       "fact_alerts")


def q_landing_batches(spark, sf):
    """Machines landed in three streaming batches (default arguments; the third repeats rows of the first two), then
    cleaned: silver holds the rows of all batches, repeats once."""
    from millstar.streaming.landing import start_landing
    layout = Layout.under(scratch_path(spark, "batches"))
    machines, part = bronze(spark, sf, "machines"), F.pmod("machine_id", F.lit(3))
    landing = f"{layout.bronze}-landing"
    for rows in (machines.where(part == 0), machines.where(part == 1), machines.where((part == 2) | part.isNull())
                 .unionByName(machines.where(F.pmod("machine_id", F.lit(2)) == 0))):
        pack_pages(rows, "machines").write.mode("append").option("maxRecordsPerFile", 1).text(landing)
        start_landing(spark, landing, layout.bronze, f"{layout.bronze}-checkpoint",
                      declared=BRONZE_SCHEMAS).awaitTermination()
    return clean_all(spark, layout, "20990101T000000")[1]["machines"]


def q_export_every_table(spark, sf):
    """Run 1 writes fact_alerts, run 2 lacks its source and skips it, dim_operator is then written on its own: the
    export holds all three, read back with their sidecars."""
    layout = Layout.under(scratch_path(spark, "runs"))
    stamps = ("20260101T000000", "20260102T000000", "20260103T000000")
    for t in ("alerts", "sensors", "machines", "production_lines", "operators"):
        snapshots.write_snapshot(bronze(spark, sf, t), f"{layout.bronze}/{t}", stamps[0])
    transform(spark, layout, stamps[0])
    later = Layout(f"{layout.bronze}-2", f"{layout.silver}-2", layout.gold)
    snapshots.write_snapshot(bronze(spark, sf, "machines").where("machine_id % 2 = 0"), f"{later.bronze}/machines",
                             stamps[1])
    transform(spark, later, stamps[1])
    own = dimension(spark, sf, "dim_operator").withColumn("full_name", F.upper("full_name"))
    snapshots.write_snapshot(own, f"{layout.gold}/dim_operator", stamps[2])
    out = export_tables(spark, layout.gold, CsvSink(layout.exports))
    shown = (("fact_alerts", "sensor_sk", "severity_level"), ("dim_machine", "machine_id", "machine_name"),
             ("dim_operator", "operator_id", "full_name"))
    parts = [read_csv_export(spark, out[t]).select(
        F.lit(t).alias("table_name"), F.col(key).cast("long").alias("id"), F.col(note).alias("note"))
        for t, key, note in shown]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_snapshot_type_drift(spark, sf):
    """Order ids that are numbers in version 1 and text in version 2, quantities that widen, a date that becomes a
    timestamp: all versions together get the least common types."""
    orders = bronze(spark, sf, "production_orders").selectExpr(
        "CAST(order_id AS BIGINT) AS order_id", "CAST(quantity_ordered AS INT) AS quantity",
        "CAST(start_date AS DATE) AS started")
    table_dir = scratch_path(spark, "drift") + "/orders"
    snapshots.write_snapshot(orders, table_dir, "20260101T000000")
    snapshots.write_snapshot(orders.selectExpr(
        "concat('P', order_id) AS order_id", "quantity + 0.5D AS quantity",
        "CAST(started AS TIMESTAMP) AS started", "'late' AS note"), table_dir, "20260102T000000")
    return snapshots.read_all_versions(spark, table_dir)


def q_snapshot_replaced(spark, sf):
    """A stamp written three times: its newest complete copy is read."""
    table_dir = scratch_path(spark, "replaced") + "/orders"
    for i in (0, 2, 1):
        snapshots.write_snapshot(_orders_version(spark, sf, i), table_dir, SNAPSHOT_STAMPS[0])
    return snapshots.read_all_versions(spark, table_dir)


def q_csv_one_column(spark, sf):
    """One text column of NULLs, empty strings, blanks and the usual NULL text survives the CSV round trip."""
    df = driver_table(spark, sf, "lineitem").selectExpr(
        "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '  ' WHEN 4 THEN '\\\\N' "
        "ELSE concat(l_linestatus, '\n') END AS note")
    return read_csv_export(spark, CsvSink(scratch_path(spark, "csv-one")).write(df, "notes"))


def q_payload_one_document(spark, sf):
    """All production output as one multi-line JSON document in one file, cut by byte ranges and landed."""
    root = scratch_path(spark, "document")
    rows = bronze(spark, sf, "production_output")
    one_document(rows, "production_output").write.text(f"{root}/landing")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        pages, multi_line = payload.splittable(spark, f"{root}/landing", True, f"{root}/pages")
        payload.land_payload(spark, pages, f"{root}/bronze", "20260101T000000", payload.payload_schema(
            {"production_output": BRONZE_SCHEMAS["production_output"]}), multi_line)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return snapshots.read_latest(spark, f"{root}/bronze/production_output")


def _fact_dense_query(name: str) -> Query:
    """The fact with its key numbered by row order: every column comparable, key included."""
    def run(spark, sf):
        return facts.with_dense_key(fact(spark, sf, name), GOLD_COLUMNS[name][0])
    run.__name__ = f"q_{name}_dense"
    return run


QUERIES["payload_one_document"] = q_payload_one_document
for _f in ("fact_alerts", "fact_production", "fact_maintenance", "fact_quality"):
    QUERIES[f"{_f}_dense"] = _fact_dense_query(_f)
def _fact_bucketed_query(name: str) -> Query:
    """The fact over order tables written in buckets of order_id (no exchange on its order lookups)."""
    def run(spark, sf):
        layout, version = Layout.under(scratch_path(spark, "buckets")), "20260101T000000"
        for t in ("production_orders", "production_output", "quality_checks", "production_lines", "factories",
                  "shifts", "operators"):
            snapshots.write_snapshot(bronze(spark, sf, t), f"{layout.bronze}/{t}", version)
        return _without_sk(transform(spark, layout, version, order_buckets=8).facts[name], name)
    run.__name__ = f"q_{name}_bucketed"
    return run


for _f in ("fact_production", "fact_quality"):
    QUERIES[f"{_f}_bucketed"] = _fact_bucketed_query(_f)


def q_silver_increments(spark, sf):
    """Quality checks in three increments, cleaned after each: rows that an earlier one brought are not added again."""
    layout = Layout.under(scratch_path(spark, "increments"))
    rows, part = bronze(spark, sf, "quality_checks"), F.pmod(F.coalesce("order_id", F.lit(0)), F.lit(5))
    for k, keep in enumerate((part < 3, part.isin(1, 3), part.isin(0, 4))):
        version = f"2026010{k + 1}T000000"
        feed.mark_increment(spark, f"{layout.bronze}/quality_checks", version)
        snapshots.write_snapshot(rows.where(keep), f"{layout.bronze}/quality_checks", version)
        silver = clean_all(spark, layout, version, incremental=True)[1]["quality_checks"]
    return silver


QUERIES["silver_increments"] = q_silver_increments
QUERIES["landing_batches"] = q_landing_batches
QUERIES["export_every_table"] = q_export_every_table
QUERIES["snapshot_type_drift"] = q_snapshot_type_drift
QUERIES["snapshot_replaced"] = q_snapshot_replaced
QUERIES["csv_one_column"] = q_csv_one_column
QUERIES["pipeline_run"] = q_pipeline_run
QUERIES["snapshot_latest"] = q_snapshot_latest
QUERIES["snapshot_all_versions"] = q_snapshot_all_versions
QUERIES["payload_explode"] = q_payload_explode
QUERIES["streaming_landing"] = q_streaming_landing
QUERIES["csv_roundtrip"] = q_csv_roundtrip
QUERIES["pipeline_counts"] = q_pipeline_counts
QUERIES["payload_open"] = q_payload_open
QUERIES["parquet_write_modes"] = q_parquet_write_modes
QUERIES["csv_empty_strings"] = q_csv_empty_strings
QUERIES["export_one"] = q_export_one
QUERIES["csv_write_all"] = q_csv_write_all
QUERIES["parquet_sink"] = q_parquet_sink


# --- ids as text -------------------------------------------------------------

def _text_id_query(table: str, column: str, prefix: str) -> Query:
    def run(spark, sf):
        rows = bronze(spark, sf, table)
        return cleaning.clean_table(rows.withColumn(column, F.concat(F.lit(prefix), F.col(column).cast("string"))),
                                    table)
    run.__name__ = f"q_clean_{table}_string_id"
    return run


for _t, (_c, _p) in {"alerts": ("alert_id", "A"), "defects": ("defect_id", "D"),
                     "maintenance_logs": ("log_id", "L")}.items():
    QUERIES[f"clean_{_t}_string_id"] = _text_id_query(_t, _c, _p)


def q_fact_alerts_string_keys(spark, sf):
    """Sensor and machine ids as text in the alerts and in both dimensions."""
    def text(df, column, prefix):
        return df.withColumn(column, F.concat(F.lit(prefix), F.col(column).cast("string")))

    layers = pipeline_layers(spark, sf)
    dims = {d: layers.dimensions[d] for d in facts.FACT_REQUIREMENTS["fact_alerts"][1]}
    for name, table, column, prefix in (("dim_sensor", "sensors", "sensor_id", "S"),
                                        ("dim_machine", "machines", "machine_id", "M")):
        silver_rows = cleaning.clean_table(text(bronze(spark, sf, table), column, prefix), table)
        dims[name] = dimensions.keyed_copy(silver_rows, dimensions.KEYED_COPIES[name])
    alerts = text(text(bronze(spark, sf, "alerts"), "sensor_id", "S"), "machine_id", "M")
    return _without_sk(facts.build_fact_alerts(cleaning.clean_table(alerts, "alerts"), dims), "fact_alerts")


QUERIES["fact_alerts_string_keys"] = q_fact_alerts_string_keys


# --- what the pipeline wrote --------------------------------------------------

def _gold_query(name: str) -> Query:
    """One gold table as the pipeline wrote it."""
    def run(spark, sf):
        layers = pipeline_layers(spark, sf)
        gold = {**layers.dimensions, **layers.facts}
        if name == "dim_date":  # the members the production facts use
            return gold[name].join(gold["fact_production"].select("date_sk"), "date_sk", "left_semi")
        if name == "dim_time":  # the members the sensor readings use
            return gold[name].join(gold["fact_sensor_readings"].select("time_sk"), "time_sk", "left_semi")
        return gold[name]
    run.__name__ = f"q_gold_{name}"
    return run


for _g in ("dim_date", "dim_time", *dimensions.KEYED_COPIES, "dim_product", "dim_alert_type",
           "dim_maintenance_type", *facts.FACT_BUILDERS):
    QUERIES[f"gold_{_g}"] = _gold_query(_g)
