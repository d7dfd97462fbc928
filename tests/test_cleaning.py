import datetime as dt

import pytest
from pyspark.sql import functions as F

from millstar.operators import cleaning
from millstar.schemas import TABLE_IDS

TS = dt.datetime


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


class TestBaseCleaner:
    def test_null_ids_dropped(self, spark):
        df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c"), (None, "d")], "id long, name string")
        out = cleaning.clean(df, cleaning.CleaningSpec("id"))
        assert _rows(out, "id") == [(1,), (3,)]

    def test_null_payload_kept(self, spark):
        df = spark.createDataFrame([("S001", 23.5), ("S002", None)], "sensor_id string, value double")
        out = cleaning.clean(df, cleaning.CleaningSpec("sensor_id"))
        assert out.count() == 2

    def test_exact_duplicates_removed(self, spark):
        rows = [(1, "a"), (2, "b"), (1, "a"), (3, "c"), (2, "b")]
        df = spark.createDataFrame(rows, "id long, name string")
        assert cleaning.clean(df, cleaning.CleaningSpec("id")).count() == 3

    def test_same_id_different_payload_kept(self, spark):
        df = spark.createDataFrame([(1, "a"), (1, "b")], "id long, name string")
        assert cleaning.clean(df, cleaning.CleaningSpec("id")).count() == 2

    def test_whole_pipeline(self, spark):
        rows = [(1, "a"), (None, "x"), (1, "a"), (2, "b")]
        df = spark.createDataFrame(rows, "id long, name string")
        assert _rows(cleaning.clean(df, cleaning.CleaningSpec("id")), "id", "name") == [(1, "a"), (2, "b")]

    def test_idempotent(self, spark):
        rows = [(1, "a"), (None, "x"), (1, "a"), (2, None)]
        df = spark.createDataFrame(rows, "id long, name string")
        spec = cleaning.CleaningSpec("id")
        once = cleaning.clean(df, spec)
        twice = cleaning.clean(once, spec)
        assert _rows(once, "id", "name") == _rows(twice, "id", "name")


ALERT_SCHEMA = "alert_id string, acknowledged_at timestamp, resolved_at timestamp, resolved_by string"


class TestAlertsCleaner:
    @pytest.fixture()
    def alerts(self, spark):
        rows = [
            ("A001", TS(2024, 1, 1, 10), TS(2024, 1, 1, 11), "alice"),
            ("A002", None, TS(2024, 1, 2, 11), "bob"),
            ("A003", TS(2024, 1, 3, 10), TS(2024, 1, 3, 11), None),
            ("A004", None, None, None),
            (None, TS(2024, 1, 5, 10), None, "eve"),
        ]
        return cleaning.clean_table(spark.createDataFrame(rows, ALERT_SCHEMA), "alerts",
                                    declared_types=False)

    def test_null_id_dropped(self, alerts):
        assert alerts.count() == 4

    def test_acknowledged_filled_from_resolved(self, alerts):
        row = alerts.where("alert_id = 'A002'").first()
        assert row["acknowledged_at"] == row["resolved_at"] == TS(2024, 1, 2, 11)

    def test_resolved_by_unknown_even_when_unresolved(self, alerts):
        by = {r["alert_id"]: r["resolved_by"] for r in alerts.collect()}
        assert by["A003"] == "unknown" and by["A004"] == "unknown" and by["A001"] == "alice"

    def test_status(self, spark):
        rows = [("R", TS(2024, 1, 1), TS(2024, 1, 2), "x"),
                ("K", TS(2024, 1, 1), None, "x"),
                ("P", None, None, "x")]
        out = cleaning.clean_table(spark.createDataFrame(rows, ALERT_SCHEMA), "alerts",
                                   declared_types=False)
        assert dict(_rows(out, "alert_id", "alert_status")) == {
            "R": "resolved", "K": "acknowledged", "P": "pending"}

    def test_iso_t_strings_cast_by_declared_types(self, spark):
        rows = [(1, 2, 3, "threshold", "high", "2024-01-15T10:30:00", None,
                 "2024-01-15 10:45:00", None)]
        schema = ("alert_id long, sensor_id long, machine_id long, alert_type string, "
                  "severity string, triggered_at string, acknowledged_at string, "
                  "resolved_at string, resolved_by string")
        out = cleaning.clean_table(spark.createDataFrame(rows, schema), "alerts").first()
        assert out["triggered_at"] == TS(2024, 1, 15, 10, 30)
        assert out["acknowledged_at"] == TS(2024, 1, 15, 10, 45)
        assert out["alert_status"] == "resolved"

    def test_all_null_integer_column_gets_declared_type(self, spark):
        rows = [(1, None), (2, None)]
        df = spark.createDataFrame(rows, "alert_id long, resolved_by int").withColumn(
            "acknowledged_at", F.lit(None).cast("timestamp")).withColumn(
            "resolved_at", F.lit(None).cast("timestamp"))
        out = cleaning.clean_table(df, "alerts")
        assert dict(out.dtypes)["resolved_by"] == "string"
        assert {r["resolved_by"] for r in out.collect()} == {"unknown"}


@pytest.mark.parametrize("table,col,text", [
    ("quality_checks", "notes", "No notes provided"),
    ("defects", "corrective_action", "Corrective action not taken"),
    ("maintenance_logs", "parts_replaced", "No parts replaced"),
])
def test_fill_rules(spark, table, col, text):
    idc = TABLE_IDS[table]
    rows = [("X001", "kept"), ("X002", None), (None, None), ("X004", None)]
    df = spark.createDataFrame(rows, f"{idc} string, {col} string")
    out = dict(_rows(cleaning.clean_table(df, table, declared_types=False), idc, col))
    assert out == {"X001": "kept", "X002": text, "X004": text}


def test_dedup_runs_before_fill(spark):
    rows = [("C1", None), ("C1", "No notes provided")]
    df = spark.createDataFrame(rows, "check_id string, notes string")
    out = cleaning.clean_table(df, "quality_checks", declared_types=False)
    assert out.count() == 2  # made equal by the fill, but de-duplicated before it


def test_registry_covers_fourteen_tables():
    assert len(TABLE_IDS) == 14
    assert cleaning.cleaning_spec("alerts").id_column == "alert_id"
    assert cleaning.cleaning_spec("shifts").rules == ()
    with pytest.raises(KeyError):
        cleaning.cleaning_spec("nope")


def test_malformed_value_fails_fast(spark):
    df = spark.createDataFrame([(1, "not a date")], "check_id long, check_date string")
    with pytest.raises(Exception):
        cleaning.clean_table(df, "quality_checks").collect()


def test_id_filter_pushed_to_scan(spark, tmp_root):
    path = f"{tmp_root}/t"
    spark.createDataFrame([(1, "a", None), (None, "b", "x")],
                          "defect_id long, defect_type string, corrective_action string") \
        .write.parquet(path)
    plan = cleaning.clean_table(spark.read.parquet(path), "defects") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(defect_id)" in plan


class TestTextIds:
    def test_ids_that_arrive_as_text_stay_text(self, spark):
        rows = [("A001", "7", "M1", "threshold", None, None, None, None, None)]
        df = spark.createDataFrame(rows, "alert_id string, sensor_id string, machine_id string, alert_type string, "
                                         "severity string, triggered_at timestamp, acknowledged_at timestamp, "
                                         "resolved_at timestamp, resolved_by int")
        out = cleaning.clean_table(df, "alerts")
        types = dict(out.dtypes)
        assert types["alert_id"] == types["sensor_id"] == types["machine_id"] == "string"
        assert types["resolved_by"] == "string" and out.first()["alert_id"] == "A001"

    def test_numeric_ids_are_still_cast(self, spark):
        df = spark.createDataFrame([(1, "dent", None)], "defect_id int, defect_type string, corrective_action string")
        assert dict(cleaning.clean_table(df, "defects").dtypes)["defect_id"] == "bigint"
