import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millstar.operators import dimensions as D
from millstar.operators.dense_key import dense_key, dense_key_window
from millstar.schemas import GOLD_COLUMNS


class TestDimDate:
    def test_range_and_first_day(self, spark):
        df = D.build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
        assert df.count() == 10
        assert df.columns == GOLD_COLUMNS["dim_date"] and len(df.columns) == 12
        r = df.where("date_sk = 20240101").first()
        assert (r["year"], r["month_number"], r["quarter"]) == (2024, 1, 1)
        assert r["day_name"] == "Monday" and r["day_of_week"] == 2
        assert r["month_name"] == "January" and r["fiscal_period"] == "FY2024-Q1"
        assert r["is_weekend"] is False and r["is_holiday"] is False
        assert r["week_of_year"] == 1

    def test_default_range(self, spark):
        df = D.build_dim_date(spark)
        assert df.count() == D.dim_date_rows() == 4018
        types = dict(df.dtypes)
        assert types["date_sk"] == "int" and types["date_actual"] == "date"

    def test_weekend_and_iso_week(self, spark):
        df = D.build_dim_date(spark, dt.date(2020, 12, 26), dt.date(2021, 1, 4))
        rows = {r["date_actual"]: r for r in df.collect()}
        sat, sun = rows[dt.date(2020, 12, 26)], rows[dt.date(2020, 12, 27)]
        assert sat["day_of_week"] == 7 and sat["is_weekend"]
        assert sun["day_of_week"] == 1 and sun["is_weekend"]
        assert rows[dt.date(2021, 1, 1)]["week_of_year"] == 53  # ISO week of the prior year
        assert rows[dt.date(2021, 1, 4)]["week_of_year"] == 1


class TestDimTime:
    def test_hours(self, spark):
        rows = {r["hour_of_day"]: r for r in D.build_dim_time(spark).collect()}
        assert len(rows) == 24
        assert rows[3]["time_of_day"] == "Night" and rows[9]["time_of_day"] == "Morning"
        assert rows[14]["time_of_day"] == "Afternoon" and rows[20]["time_of_day"] == "Evening"
        assert rows[10]["period_am_pm"] == "AM" and rows[15]["period_am_pm"] == "PM"
        assert rows[7]["hour_band"] == "07:00 - 07:59"
        assert [h for h in range(24) if rows[h]["is_peak_hour"]] == [6, 7, 8, 9, 17, 18, 19, 20]
        assert all(r["minute_of_hour"] == 0 and r["time_sk"] == h for h, r in rows.items())


class TestKeyedCopy:
    def test_sk_first_and_equal_to_nk(self, spark):
        rows = [(1, "F1", "Madrid", "EU", "Ana", 1000), (2, "F2", "Lima", "SA", "Luis", 2000)]
        df = spark.createDataFrame(rows, "factory_id long, factory_name string, location string, "
                                         "region string, manager_name string, total_area_sqm long")
        out = D.keyed_copy(df, D.KEYED_COPIES["dim_factory"])
        assert out.columns[0] == "factory_sk"
        assert sorted(r["factory_sk"] for r in out.collect()) == [1, 2]
        assert all(r["factory_sk"] == r["factory_id"] for r in out.collect())

    def test_missing_configured_columns_are_dropped(self, spark):
        df = spark.createDataFrame([(1, "S", "extra")], "shift_id long, shift_name string, junk string")
        out = D.keyed_copy(df, D.KEYED_COPIES["dim_shift"])
        assert out.columns == ["shift_sk", "shift_id", "shift_name"]

    def test_no_column_list_keeps_all(self, spark):
        df = spark.createDataFrame([(1, "x")], "k long, v string")
        out = D.keyed_copy(df, D.KeyedCopy("t", "k_sk", ("k",)))
        assert out.columns == ["k_sk", "k", "v"]

    def test_missing_natural_key_raises(self, spark):
        df = spark.createDataFrame([("x",)], "v string")
        with pytest.raises(ValueError):
            D.keyed_copy(df, D.KeyedCopy("t", "k_sk", ("k",)))


class TestDerivedDimensions:
    def test_dim_product(self, spark):
        rows = [(1, "P-B", 10), (2, "P-A", 20), (3, "P-B", 30), (4, "P-C", 40)]
        df = spark.createDataFrame(rows, "order_id long, product_code string, quantity_ordered long")
        out = {r["product_code"]: r for r in D.build_dim_product(df).collect()}
        assert {c: r["product_sk"] for c, r in out.items()} == {"P-A": 1, "P-B": 2, "P-C": 3}
        assert out["P-A"]["product_name"] == "P-A" and out["P-A"]["unit_of_measure"] == "units"
        assert out["P-A"]["priority_default"] == "medium"

    def test_dim_alert_type(self, spark):
        rows = [(1, "threshold_high", "critical"), (2, "quality_drop", "low"),
                (3, "threshold_high", "critical"), (4, "machine_offline", None),
                (5, "sensor_offline", "high"), (6, None, "medium"), (7, "other", "low")]
        df = spark.createDataFrame(rows, "alert_id long, alert_type string, severity string")
        out = D.build_dim_alert_type(df).orderBy("alert_type_sk").collect()
        assert [r["alert_type_sk"] for r in out] == list(range(1, 7))
        assert out[0]["alert_type_name"] is None  # NULLs first
        cats = {r["alert_type_name"]: r["category"] for r in out}
        assert cats == {None: "Operational", "machine_offline": "Mechanical",
                        "other": "Operational", "quality_drop": "Environmental",
                        "sensor_offline": "Electrical", "threshold_high": "Quality"}
        acks = {(r["alert_type_name"], r["severity_level"]): r["requires_ack"] for r in out}
        assert acks[("threshold_high", "critical")] and acks[("sensor_offline", "high")]
        assert acks[("machine_offline", None)] is False

    def test_dim_maintenance_type(self, spark):
        rows = [(1, "preventive"), (2, "corrective"), (3, "preventive"), (4, "predictive")]
        df = spark.createDataFrame(rows, "log_id long, maintenance_type string")
        out = {r["maint_type_name"]: r["maint_type_sk"]
               for r in D.build_dim_maintenance_type(df).collect()}
        assert out == {"corrective": 1, "predictive": 2, "preventive": 3}


class TestDenseKey:
    @pytest.mark.parametrize("n,parts", [(0, 4), (1, 4), (7, 4), (5000, 16)])
    def test_equals_global_row_number(self, spark, n, parts):
        rnd = random.Random(n)
        vals = sorted({rnd.randrange(10 * n + 10) for _ in range(n)})
        rows = [(v if i % 97 else None,) for i, v in enumerate(vals)]
        rows = list({r for r in rows})
        df = spark.createDataFrame(rows, "k long")
        got = {r["k"]: r["sk"] for r in dense_key(df, ["k"], "sk", partitions=parts).collect()}
        want = {r["k"]: r["sk"] for r in dense_key_window(df, ["k"], "sk").collect()}
        assert got == want
        assert sorted(got.values()) == list(range(1, len(rows) + 1))

    def test_two_columns_nulls_first(self, spark):
        rows = [("b", None), ("a", "y"), (None, "x"), ("a", None), ("b", "z")]
        df = spark.createDataFrame(rows, "t string, s string")
        out = [(r["t"], r["s"]) for r in dense_key(df, ["t", "s"], "sk", 3).orderBy("sk").collect()]
        assert out == [(None, "x"), ("a", None), ("a", "y"), ("b", None), ("b", "z")]

    def test_plan_has_no_single_partition_exchange_over_data(self, spark):
        df = spark.range(10000).select((F.col("id") * 7 % 10007).alias("k")).distinct()
        out = dense_key(df, ["k"], "sk", partitions=8)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # The only window runs over the per-partition counts (<= 8 rows).
        assert "RangePartitioning" not in plan  # the range shuffle happened before the checkpoint
        assert out.rdd.getNumPartitions() >= 1
        assert out.count() == 10000
        w = Window.orderBy("k")
        ref = df.select("k", F.row_number().over(w).alias("sk"))
        assert out.join(ref, ["k", "sk"]).count() == df.count()
