import datetime as dt

import pytest

from millstar.operators import dimensions as D
from millstar.operators import facts
from millstar.schemas import GOLD_COLUMNS

TS = dt.datetime


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "dim_date": D.build_dim_date(spark),
        "dim_time": D.build_dim_time(spark),
        "dim_sensor": spark.createDataFrame([(101, 101, "M")], "sensor_sk long, sensor_id long, machine_name string"),
        "dim_machine": spark.createDataFrame([(7, 7, 3, "M")], "machine_sk long, machine_id long, line_id long, machine_name string"),
        "dim_production_line": spark.createDataFrame([(3, 3, 1)], "line_sk long, line_id long, factory_id long"),
        "dim_factory": spark.createDataFrame([(1, 1)], "factory_sk long, factory_id long"),
        "dim_shift": spark.createDataFrame([(2, 2)], "shift_sk long, shift_id long"),
        "dim_product": spark.createDataFrame([(1, "P1")], "product_sk int, product_code string"),
        "dim_order": spark.createDataFrame([(50, 50, "P1")], "order_sk long, order_id long, product_code string"),
        "dim_operator": spark.createDataFrame([(5, 5)], "operator_sk long, operator_id long"),
        "dim_maintenance_type": spark.createDataFrame([(1, "preventive")], "maint_type_sk int, maint_type_name string"),
        "dim_alert_type": spark.createDataFrame([(4, "threshold", "high")], "alert_type_sk int, alert_type_name string, severity_level string"),
    }


def test_fact_production(spark, dims):
    out_rows = [(1, 50, 3, 2, dt.date(2024, 1, 15), 500, 5, 30, 95.0),
                (2, 999, 99, 9, dt.date(2019, 5, 1), 0, 0, 10, 80.0)]
    src = spark.createDataFrame(out_rows, "output_id long, order_id long, line_id long, shift_id long, "
                                          "production_date date, units_produced long, units_defective long, "
                                          "downtime_minutes long, efficiency_percentage double")
    orders = spark.createDataFrame([(50, "P1", 600)], "order_id long, product_code string, quantity_ordered long")
    f = facts.build_fact_production(src, {**dims, "production_orders": orders})
    assert f.columns == GOLD_COLUMNS["fact_production"]
    rows = {r["units_produced"]: r for r in f.collect()}
    r = rows[500]
    assert (r["date_sk"], r["time_sk"], r["factory_sk"], r["line_sk"], r["product_sk"],
            r["shift_sk"], r["order_sk"], r["target_units"]) == (20240115, 20240115, 1, 3, 1, 2, 50, 600)
    assert r["cycle_time_avg"] == pytest.approx(0.9)
    orphan = rows[0]
    assert orphan["date_sk"] is None and orphan["time_sk"] == 20190501  # outside dim_date
    assert orphan["order_sk"] is None and orphan["cycle_time_avg"] is None
    assert len({r["production_sk"] for r in rows.values()}) == 2


def test_fact_production_key_fanout(spark, dims):
    src = spark.createDataFrame([(1, 50, 3, 2, dt.date(2024, 1, 15), 10, 0, 0, 1.0)],
                                "output_id long, order_id long, line_id long, shift_id long, "
                                "production_date date, units_produced long, units_defective long, "
                                "downtime_minutes long, efficiency_percentage double")
    orders = spark.createDataFrame([(50, "P1", 600), (50, "P1", 700)],
                                   "order_id long, product_code string, quantity_ordered long")
    dim_order = spark.createDataFrame([(50, 50, "P1"), (50, 50, "P1")],
                                      "order_sk long, order_id long, product_code string")
    f = facts.build_fact_production(src, {**dims, "production_orders": orders, "dim_order": dim_order})
    assert f.count() == 4  # k = 2 matches in each of the two order lookups


def test_fact_quality(spark, dims):
    rows = [(1, 50, 3, 5, dt.date(2024, 1, 15), "PASS", 0, 50),
            (2, 50, 3, 5, dt.date(2024, 1, 15), "fail", 5, 50),
            (3, 77, 3, 6, dt.date(2024, 1, 15), None, 1, 0)]
    src = spark.createDataFrame(rows, "check_id long, order_id long, line_id long, inspector_id long, "
                                      "check_date date, result string, defects_found long, sample_size long")
    f = facts.build_fact_quality(src, dims)
    assert f.columns == GOLD_COLUMNS["fact_quality"]
    got = sorted((r["defects_found"], r["defect_rate_pct"], r["check_passed"], r["product_sk"],
                  r["operator_sk"]) for r in f.collect())
    assert got == [(0, 0.0, True, 1, 5), (1, 0.0, False, None, None), (5, 10.0, False, 1, 5)]


def test_fact_sensor_readings(spark, dims):
    rows = [(1, 101, 7, "2024-01-15 10:30:45", 23.5, "C", 95, False),
            (2, 999, 8, "2024-01-15T22:05:00", 101.0, "C", 40, True)]
    src = spark.createDataFrame(rows, "reading_id long, sensor_id long, machine_id long, timestamp string, "
                                      "value double, unit string, quality_score long, is_anomaly boolean")
    f = facts.build_fact_sensor_readings(src, dims)
    assert f.columns == GOLD_COLUMNS["fact_sensor_readings"] and f.count() == 2
    r = {x["sensor_reading_sk"]: x for x in f.collect()}
    assert (r[1]["date_sk"], r[1]["time_sk"], r[1]["sensor_sk"], r[1]["machine_sk"], r[1]["line_sk"]) == \
        (20240115, 10, 101, 7, 3)
    assert r[1]["timestamp"] == TS(2024, 1, 15, 10, 30, 45)
    assert r[2]["time_sk"] == 22 and r[2]["sensor_sk"] is None and r[2]["line_sk"] is None
    assert dict(f.dtypes)["quality_score"] == "int"


def test_fact_maintenance(spark, dims):
    rows = [(1, 7, "Technician 5", "preventive", dt.date(2024, 1, 15), 2.5, "belt", 150.0),
            (2, 7, "Tech 005 and 9", "other", dt.date(2024, 1, 15), None, None, 10.0),
            (3, 8, "Technician", None, dt.date(2024, 1, 15), 1.0, None, 1.0),
            (4, 8, None, "preventive", dt.date(2024, 1, 15), 1.0, None, 1.0)]
    src = spark.createDataFrame(rows, "log_id long, machine_id long, performed_by string, "
                                      "maintenance_type string, performed_date date, downtime_hours double, "
                                      "parts_replaced string, cost double")
    f = facts.build_fact_maintenance(src, dims)
    assert f.columns == GOLD_COLUMNS["fact_maintenance"]
    r = {x["cost_amount"]: x for x in f.collect()}
    assert r[150.0]["operator_sk"] == 5 and r[150.0]["maintenance_type_sk"] == 1
    assert r[150.0]["labor_hours"] == 2.5 and r[150.0]["line_sk"] == 3
    assert r[10.0]["operator_sk"] == 5 and r[10.0]["labor_hours"] == 0.0  # first digit run "005"
    assert r[10.0]["maintenance_type_sk"] is None
    assert r[1.0]["operator_sk"] is None


def test_fact_alerts(spark, dims):
    rows = [(1, 101, 7, "threshold", "high", TS(2024, 1, 15, 10, 30), TS(2024, 1, 15, 10, 45), None),
            (2, 101, 7, "threshold", None, TS(2024, 1, 15, 23, 0), None, TS(2024, 1, 15, 23, 1))]
    src = spark.createDataFrame(rows, "alert_id long, sensor_id long, machine_id long, alert_type string, "
                                      "severity string, triggered_at timestamp, resolved_at timestamp, "
                                      "acknowledged_at timestamp")
    f = facts.build_fact_alerts(src, dims)
    assert f.columns == GOLD_COLUMNS["fact_alerts"]
    r = {x["time_sk"]: x for x in f.collect()}
    assert r[10]["resolution_time_min"] == 15.0 and r[10]["acknowledged_flag"] is False
    assert r[10]["alert_type_sk"] == 4 and r[10]["severity_level"] == "high"
    assert r[23]["resolution_time_min"] is None and r[23]["acknowledged_flag"] is True
    assert r[23]["alert_type_sk"] is None  # NULL severity never matches


def test_fact_alerts_accepts_iso_strings(spark, dims):
    rows = [(1, 101, 7, "threshold", "high", "2024-01-15T10:30:00", "2024-01-15T10:45:30", None)]
    src = spark.createDataFrame(rows, "alert_id long, sensor_id long, machine_id long, alert_type string, "
                                      "severity string, triggered_at string, resolved_at string, "
                                      "acknowledged_at string")
    r = facts.build_fact_alerts(src, dims).first()
    assert r["resolution_time_min"] == pytest.approx(15.5) and r["date_sk"] == 20240115


def test_fact_plan_is_map_only_with_small_dims(spark, dims, tmp_root):
    """Dimensions re-read from Parquet carry file sizes, so every lookup broadcasts."""
    stored = {}
    for name, df in dims.items():
        df.write.parquet(f"{tmp_root}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_root}/{name}")
    spark.createDataFrame([(1, 101, 7, "2024-01-15 10:30:45", 1.0, "C", 1, False)],
                          "reading_id long, sensor_id long, machine_id long, timestamp string, "
                          "value double, unit string, quality_score long, is_anomaly boolean") \
        .write.parquet(f"{tmp_root}/src")
    src = spark.read.parquet(f"{tmp_root}/src")
    plan = facts.build_fact_sensor_readings(src, stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_shuffle_lookup_spreads_null_keys(spark):
    """90% NULL foreign keys: a shuffle lookup must not put them all in one reducer."""
    from pyspark.sql import functions as F
    from millstar.operators.lookup import Lookup, resolve
    fact_df = spark.range(20000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id") % 50).alias("fk"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") + 1000).alias("v_sk"))
    lk = [Lookup("d", (("fk", "k"),), (("v_sk", "v_sk"),))]
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = resolve(fact_df, {"d": dim}, lk, broadcast_max_rows=0)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert sum(sizes) == 20000
    assert max(sizes) < 0.5 * 20000
    by_bcast = resolve(fact_df, {"d": dim}, lk)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, by_bcast.collect()))
    assert out.where("v_sk IS NOT NULL").count() == 2000


def test_broadcast_bound_is_checked(spark):
    from pyspark.sql import functions as F
    from millstar.operators.lookup import Lookup, resolve, strategies
    dim = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    one = [Lookup("d", (("fk", "k"),), (("v", "v"),))]
    assert strategies({"d": dim}, one, 100) == ["hint"] and strategies({"d": dim}, one, 99) == ["salt"]
    fact_df = spark.range(10).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("fk"))
    lk = [Lookup("d", (("fk", "k"),), (("v", "v"),))]
    small = resolve(fact_df, {"d": dim}, lk)._jdf.queryExecution().executedPlan().toString()
    big = resolve(fact_df, {"d": dim}, lk, broadcast_max_rows=99)
    assert "BroadcastHashJoin" in small and "__salt_fk" not in small
    # Past the bound the lookup takes the shuffle path (salted keys); Spark's own
    # size check may still broadcast such a tiny table at plan time.  (For a key
    # Catalyst knows is never NULL the salt folds away to nothing.)
    assert "__salt_fk" in big._jdf.queryExecution().optimizedPlan().toString()


def test_shuffle_lookup_splits_hot_key(spark):
    """One key holds a third of the fact: it is salted over many reducers."""
    from pyspark.sql import functions as F
    from millstar.operators.lookup import Lookup, resolve
    n = 30000
    fact_df = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("fk"))
    dim = spark.range(500).select(F.col("id").alias("k"), (F.col("id") + 1000).alias("v_sk"))
    dim = dim.unionByName(spark.range(1).select(F.lit(7).cast("long").alias("k"),
                                                F.lit(-7).cast("long").alias("v_sk")))
    lk = [Lookup("d", (("fk", "k"),), (("v_sk", "v_sk"),))]
    prev = (spark.conf.get("spark.sql.adaptive.enabled"),
            spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = resolve(fact_df, {"d": dim}, lk, broadcast_max_rows=0)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev[0])
        spark.conf.set("spark.sql.shuffle.partitions", prev[1])
    want = sorted(map(tuple, resolve(fact_df, {"d": dim}, lk).collect()))
    assert got == want and sum(sizes) == len(want) > n  # key 7 has two dimension rows

    # Unsalted, key 7 alone would put half of the output into one reducer.
    assert max(sizes) < 0.2 * sum(sizes)


def test_hot_key_threshold_and_buckets_scale_with_partitions(spark):
    from pyspark.sql import functions as F
    from millstar.operators.lookup import hot_keys
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"))
    hot = hot_keys(df, {}, [], [("k",)], 16)[("k",)]
    assert {r["k"]: r["__buckets"] for r in hot.collect()} == {7: 22}   # ceil(4 * 1/3 * 16)
    assert hot_keys(spark.range(1000).select(F.col("id").alias("k")), {}, [], [("k",)], 16) == {}
    # No floor: with very many partitions a key of a few rows is split as well.
    many = hot_keys(df, {}, [], [("k",)], 200_000)[("k",)]
    assert many.count() == df.distinct().count()


def test_hot_keys_of_a_later_hop_come_from_the_small_side(spark):
    from pyspark.sql import functions as F
    from millstar.operators.lookup import Lookup, hot_keys
    fact_df = spark.range(1000).select((F.col("id") % 100).alias("m"))
    machines = spark.range(100).select(F.col("id").alias("machine_id"),
                                       F.when(F.col("id") < 60, F.lit(1)).otherwise(F.col("id")).alias("line_id"))
    lk = [Lookup("machines", (("m", "machine_id"),), (("line_id", "line"),))]
    hot = hot_keys(fact_df, {"machines": machines}, lk, [("m",), ("line",)], 8)
    assert set(hot) == {("line",)}
    assert [(r["line"], r["__buckets"]) for r in hot[("line",)].collect()] == [(1, 20)]  # ceil(4 * .6 * 8)


def test_hot_key_probe_has_no_single_partition_step(spark):
    from pyspark.sql import functions as F
    from millstar.operators.lookup import key_counts
    probe = key_counts(spark.range(1000).select((F.col("id") % 9).alias("k")), {}, [], ("k",))
    assert "SinglePartition" not in probe._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["string", "string_iso", "date", "timestamp", "timestamp_ntz"])
def test_temporal_inputs_of_every_kind(spark, dims, kind):
    """Date/time columns may arrive as any of the JSON-derived types."""
    from pyspark.sql import functions as F
    value = {"string": "2024-01-15 10:30:00", "string_iso": "2024-01-15T10:30:00"}.get(kind)
    base = spark.createDataFrame([(1, 50, 3, 5, "PASS", 0, 50)],
                                 "check_id long, order_id long, line_id long, inspector_id long, "
                                 "result string, defects_found long, sample_size long")
    if value is not None:
        col = F.lit(value)
    else:
        col = F.lit("2024-01-15 10:30:00").cast(kind)
    q = facts.build_fact_quality(base.withColumn("check_date", col), dims).first()
    assert q["date_sk"] == 20240115
    alerts = spark.createDataFrame([(1, 101, 7, "threshold", "high")],
                                   "alert_id long, sensor_id long, machine_id long, "
                                   "alert_type string, severity string") \
        .withColumn("triggered_at", col) \
        .withColumn("resolved_at", F.lit(None).cast("string") if value else F.lit(None).cast(kind)) \
        .withColumn("acknowledged_at", F.lit(None).cast("timestamp"))
    a = facts.build_fact_alerts(alerts, dims).first()
    expected_hour = 0 if kind == "date" else 10
    assert a["date_sk"] == 20240115 and a["time_sk"] == expected_hour


def test_broadcast_bound_in_bytes(spark):
    """Strings count by their length, and all hinted sides of a fact share one bound."""
    from pyspark.sql import functions as F
    from millstar.operators import lookup
    wide = spark.range(20).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("s"))
    slim = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("s"))
    assert lookup.measured_size(wide, ["k", "s"]) == lookup.SideSize(20, 20 * 1008)
    one = lookup.Lookup("d", (("fk", "k"),), (("s", "s"),))
    two = lookup.Lookup("e", (("fk", "k"),), (("s", "t"),))
    saved = lookup.BROADCAST_MAX_BYTES
    lookup.BROADCAST_MAX_BYTES = 20 * 1008
    try:
        assert lookup.strategies({"d": wide, "e": slim}, [one, two], 100) == ["hint", "salt"]
        assert lookup.strategies({"d": slim, "e": slim}, [one, two], 100) == ["hint", "hint"]
        lookup.BROADCAST_MAX_BYTES -= 1
        assert lookup.strategies({"d": wide}, [one], 100) == ["salt"]
    finally:
        lookup.BROADCAST_MAX_BYTES = saved


def test_order_lookups_are_never_hinted(spark):
    from millstar.operators import facts, lookup
    for lookups in (facts.FACT_PRODUCTION_LOOKUPS, facts.FACT_QUALITY_LOOKUPS):
        growing = {lk.dim for lk in lookups if lk.growing}
        assert growing == {lk.dim for lk in lookups if lk.dim in ("dim_order", "production_orders")}
    dim = spark.range(10).selectExpr("id AS order_id", "id AS order_sk")
    lk = lookup.Lookup("dim_order", (("order_id", "order_id"),), (("order_sk", "order_sk"),), growing=True)
    assert lookup.strategies({"dim_order": dim}, [lk], 100) == ["spark"]
