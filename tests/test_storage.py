import datetime as dt
import glob
import json
import os
import shutil

import pytest

from millstar.sinks.base import ParquetSink, Sink
from millstar.sinks.csv import CsvSink, read_csv_export
from millstar.sinks.export import export_table, export_tables
from millstar.sources import catalog, payload, snapshots
from millstar.schemas import BRONZE_SCHEMAS

SCHEMA = "id long, name string, value double"
ROWS = [(1, "a", 1.5), (2, 'say "hi"', None), (3, "multi\nline", 3.0)]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


class TestSnapshots:
    def test_stamp_format(self):
        assert snapshots.stamp(dt.datetime(2026, 1, 2, 3, 4, 5)) == "20260102T030405"
        aware = dt.datetime(2026, 1, 2, 5, 4, 5, tzinfo=dt.timezone(dt.timedelta(hours=2)))
        assert snapshots.stamp(aware) == "20260102T030405"

    def test_latest_is_greatest_stamp(self, spark, df, tmp_root):
        t = f"{tmp_root}/tbl"
        for i, s in enumerate(["20260101T100000", "20260103T150000", "20260102T120000"]):
            snapshots.write_snapshot(df.where(f"id <= {i + 1}"), t, s)
        assert snapshots.latest_version(spark, t) == "20260103T150000"
        assert snapshots.read_latest(spark, t).count() == 2
        assert snapshots.read_all_versions(spark, t).count() == 1 + 2 + 3
        assert "snapshot_ts" not in snapshots.read_all_versions(spark, t).columns
        assert "snapshot_ts" in snapshots.read_all_versions(spark, t, with_version=True).columns

    def test_same_stamp_overwrites_only_itself(self, spark, df, tmp_root):
        t = f"{tmp_root}/tbl"
        snapshots.write_snapshot(df, t, "20260101T000000")
        snapshots.write_snapshot(df.limit(1), t, "20260102T000000")
        snapshots.write_snapshot(df.where("id = 3"), t, "20260102T000000")
        assert snapshots.versions(spark, t) == ["20260101T000000", "20260102T000000"]
        assert [r["id"] for r in snapshots.read_latest(spark, t).collect()] == [3]

    def test_uncommitted_version_ignored(self, spark, df, tmp_root):
        t = f"{tmp_root}/tbl"
        snapshots.write_snapshot(df, t, "20260101T000000")
        staged = f"{tmp_root}/staged"
        df.write.parquet(staged)
        partial = f"{t}/snapshot_ts=20990101T000000"
        os.makedirs(partial)
        for f in glob.glob(f"{staged}/part-*"):
            shutil.copy(f, partial)
        assert snapshots.latest_version(spark, t) == "20260101T000000"

    def test_missing(self, spark, tmp_root):
        assert snapshots.read_latest(spark, f"{tmp_root}/none") is None
        with pytest.raises(FileNotFoundError, match="none"):
            snapshots.read_all_versions(spark, f"{tmp_root}/none")

    def test_parquet_read_write(self, spark, df, tmp_root):
        p = snapshots.write_parquet(df, f"{tmp_root}/p")
        snapshots.write_parquet(df, p, mode="append")
        assert snapshots.read_parquet(spark, p).count() == 6


class TestPayload:
    def _land(self, tmp_root, docs):
        d = f"{tmp_root}/landing"
        os.makedirs(d)
        for i, doc in enumerate(docs):
            with open(f"{d}/page{i}.json", "w") as fh:
                json.dump(doc, fh)
        return d

    def test_tables_split_and_empty_skipped(self, spark, tmp_root):
        docs = [{"tables": {"sensores": [{"id": 1, "nombre": "a"}, {"id": 2, "nombre": "b"}],
                            "dispositivos": [{"id": 1, "ubicacion": "x"}],
                            "vacia": []}},
                {"tables": {"sensores": [{"id": 3, "nombre": "c"}]}}]
        landed = payload.land_payload(spark, self._land(tmp_root, docs), f"{tmp_root}/bronze",
                                      "20260101T000000")
        assert sorted(landed) == ["dispositivos", "sensores"]
        s = snapshots.read_latest(spark, f"{tmp_root}/bronze/sensores")
        assert sorted(r["id"] for r in s.collect()) == [1, 2, 3]
        assert not os.path.exists(f"{tmp_root}/bronze/_staging/20260101T000000")
        assert catalog.list_tables(spark, f"{tmp_root}/bronze") == ["dispositivos", "sensores"]

    def test_no_tables_key(self, spark, tmp_root):
        landed = payload.land_payload(spark, self._land(tmp_root, [{"other": 1}]),
                                      f"{tmp_root}/bronze")
        assert landed == {}

    def test_declared_schema(self, spark, tmp_root):
        docs = [{"tables": {"shifts": [{"shift_id": 1, "shift_name": "Morning",
                                        "start_time": "06:00", "end_time": "14:00",
                                        "shift_duration_hrs": 8}],
                            "defects": []}}]
        schema = payload.payload_schema({"shifts": BRONZE_SCHEMAS["shifts"],
                                         "defects": BRONZE_SCHEMAS["defects"]})
        landed = payload.land_payload(spark, self._land(tmp_root, docs), f"{tmp_root}/bronze",
                                      schema=schema)
        assert list(landed) == ["shifts"]
        out = snapshots.read_latest(spark, f"{tmp_root}/bronze/shifts")
        assert dict(out.dtypes)["shift_id"] == "bigint"


class TestExport:
    def test_csv_header_and_delimiter(self, spark, df, tmp_root):
        path = CsvSink(f"{tmp_root}/out", delimiter=";").write(df.coalesce(1), "t")
        text = "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*.csv")))
        assert text.splitlines()[0] == "id;name;value"
        path2 = CsvSink(f"{tmp_root}/out2", include_header=False).write(df.limit(2).coalesce(1), "t")
        lines = "".join(open(f).read() for f in glob.glob(f"{path2}/part-*.csv")).splitlines()
        assert len(lines) == 2 and not lines[0].startswith("id")

    def test_csv_round_trip(self, spark, df, tmp_root):
        path = CsvSink(f"{tmp_root}/out").write(df, "t")
        back = read_csv_export(spark, path, df.schema)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)

    def test_csv_timestamps_round_trip(self, spark, tmp_root):
        src = spark.createDataFrame([(1, dt.datetime(2024, 1, 15, 10, 30, 0, 123456), dt.date(2024, 1, 15))],
                                    "id long, ts timestamp, d date")
        path = CsvSink(f"{tmp_root}/out").write(src, "t")
        raw = "".join(open(f).read() for f in glob.glob(f"{path}/part-*.csv"))
        assert "2024-01-15 10:30:00.123456" in raw
        assert read_csv_export(spark, path, src.schema).collect() == src.collect()

    def test_export_lists_tables_and_versions(self, spark, df, tmp_root):
        gold = f"{tmp_root}/gold"
        snapshots.write_snapshot(df, f"{gold}/dim_a", "20260101T000000")
        snapshots.write_snapshot(df.limit(1), f"{gold}/dim_a", "20260102T000000")
        snapshots.write_snapshot(df, f"{gold}/fact_b", "20260101T000000")
        os.makedirs(f"{gold}/empty_dir")
        df.write.partitionBy("id").parquet(f"{gold}/by_year")
        assert catalog.list_tables(spark, gold) == ["by_year", "dim_a", "fact_b"]
        assert catalog.list_tables(spark, f"{tmp_root}/missing") == []
        out = export_tables(spark, gold, ParquetSink(f"{tmp_root}/exp"), tables=["dim_a", "fact_b"])
        assert spark.read.parquet(out["dim_a"]).count() == 1
        out_all = export_tables(spark, gold, ParquetSink(f"{tmp_root}/exp_all"),
                                tables=["dim_a"], versions="all")
        assert spark.read.parquet(out_all["dim_a"]).count() == 4
        one = export_table(spark, gold, "fact_b", CsvSink(f"{tmp_root}/csv"))
        assert read_csv_export(spark, one, df.schema).count() == 3

    def test_missing_table_writes_nothing(self, spark, df, tmp_root):
        gold = f"{tmp_root}/gold"
        snapshots.write_snapshot(df, f"{gold}/dim_a", "20260101T000000")

        class Recorder(Sink):
            def __init__(self):
                self.written = []

            def write(self, frame, name):
                self.written.append(name)
                return name

        rec = Recorder()
        with pytest.raises(FileNotFoundError, match="nope"):
            export_tables(spark, gold, rec, tables=["dim_a", "nope"])
        assert rec.written == []


class TestLossless:
    def test_csv_keeps_null_and_empty_apart(self, spark, tmp_root):
        df = spark.createDataFrame([(1, None, None), (2, "", 1.5), (3, '""', None), (4, " ", 0.0)],
                                   "id long, s string, d double")
        back = read_csv_export(spark, CsvSink(tmp_root).write(df, "t"), df.schema)
        assert sorted(back.collect()) == sorted(df.collect())

    def test_versions_with_other_columns_are_merged(self, spark, tmp_root):
        gold = f"{tmp_root}/gold"
        snapshots.write_snapshot(spark.range(2).selectExpr("id"), f"{gold}/t", "20260101T000000")
        snapshots.write_snapshot(spark.range(1).selectExpr("id", "'x' AS extra"), f"{gold}/t", "20260102T000000")
        rows = [(0, None), (0, "x"), (1, None)]
        assert sorted(map(tuple, snapshots.read_all_versions(spark, f"{gold}/t").select("id", "extra").collect()),
                      key=str) == sorted(rows, key=str)
        out = export_table(spark, gold, "t", ParquetSink(f"{tmp_root}/out"), versions="all")
        assert set(spark.read.parquet(out).columns) == {"id", "extra"}

    def test_a_failed_rewrite_keeps_the_committed_version(self, spark, tmp_root):
        from pyspark.sql import functions as F
        snapshots.write_snapshot(spark.range(3), f"{tmp_root}/t", "20260101T000000")
        broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
        with pytest.raises(Exception):
            snapshots.write_snapshot(broken, f"{tmp_root}/t", "20260101T000000")
        assert snapshots.versions(spark, f"{tmp_root}/t") == ["20260101T000000"]
        assert snapshots.read_latest(spark, f"{tmp_root}/t").count() == 3
        snapshots.write_snapshot(spark.range(5), f"{tmp_root}/t", "20260101T000000")
        assert snapshots.read_latest(spark, f"{tmp_root}/t").count() == 5

    def test_open_payload_keeps_undeclared_tables_columns_and_text_ids(self, spark, tmp_root):
        os.makedirs(f"{tmp_root}/landing")
        doc = {"tables": {"defects": [{"defect_id": "D001", "defect_type": "dent", "corrective_action": None,
                                       "line": 4, "shade": "red"}],
                          "energy_usage": [{"meter": 1, "kwh": 2.5}], "shifts": []}}
        with open(f"{tmp_root}/landing/a.json", "w") as fh:
            json.dump(doc, fh)
        schema = payload.open_schema(spark, f"{tmp_root}/landing", BRONZE_SCHEMAS)
        landed = payload.land_payload(spark, f"{tmp_root}/landing", f"{tmp_root}/bronze", "20260101T000000", schema)
        assert set(landed) == {"defects", "energy_usage"}
        row = snapshots.read_latest(spark, f"{tmp_root}/bronze/defects").first()
        assert (row["defect_id"], row["line"], row["shade"], row["corrective_action"]) == ("D001", 4, "red", None)
        assert snapshots.read_latest(spark, f"{tmp_root}/bronze/energy_usage").first()["kwh"] == 2.5
