"""Atomic versions, increments and the consumption log, run manifests, type drift, self-describing CSV."""
from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.functions.types import common_schema, common_type
from millstar.plans.pipeline import Layout, clean_all, transform
from millstar.sinks import export
from millstar.sinks.base import ParquetSink
from millstar.sinks.csv import CsvSink, export_spec, null_text, read_csv_export
from millstar.sources import feed, fs, payload, snapshots
from millstar.streaming.landing import start_landing

ONE, TWO, THREE = "20260101T000000", "20260102T000000", "20260103T000000"
DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


class TestAtomicCommit:
    @pytest.mark.parametrize("step", ["create_empty", "glob_names"])
    def test_a_replace_that_dies_keeps_the_old_copy(self, spark, tmp_root, monkeypatch, step):
        table = f"{tmp_root}/t"
        snapshots.write_snapshot(spark.range(3), table, ONE)
        real = getattr(fs, step)
        monkeypatch.setattr(fs, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            snapshots.write_snapshot(spark.range(9), table, ONE)
        monkeypatch.setattr(fs, step, real)
        assert snapshots.versions(spark, table) == [ONE]
        assert snapshots.read_latest(spark, table).count() == 3
        snapshots.write_snapshot(spark.range(5), table, ONE)
        assert snapshots.read_latest(spark, table).count() == 5
        assert snapshots.read_all_versions(spark, table).count() == 5

    def test_a_reader_that_resolved_the_old_copy_finishes(self, spark, tmp_root):
        table = f"{tmp_root}/t"
        snapshots.write_snapshot(spark.range(3), table, ONE)
        for rows in (4, 5, 6):
            before = snapshots.read_latest(spark, table)
            n = before.count()
            snapshots.write_snapshot(spark.range(rows), table, ONE)
            assert before.count() == n          # its files are still there
        folders = [d for d in os.listdir(table) if d.startswith("snapshot_ts=")]
        assert len(folders) == 2                # the newest copy and the one before it
        assert snapshots.read_latest(spark, table).count() == 6

    def test_versions_of_other_writers_count(self, spark, tmp_root):
        spark.range(2).write.parquet(snapshots.version_path(f"{tmp_root}/t", ONE))
        assert snapshots.versions(spark, f"{tmp_root}/t") == [ONE]
        snapshots.write_snapshot(spark.range(7), f"{tmp_root}/t", ONE)
        assert snapshots.read_latest(spark, f"{tmp_root}/t").count() == 7


def _page(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as fh:
        json.dump({"tables": {"defects": rows}}, fh)


def _defect(i, **more):
    return {"defect_id": i, "defect_type": f"t{i}", "corrective_action": None, **more}


class TestIncrements:
    def test_every_landed_batch_reaches_silver(self, spark, tmp_root):
        layout, landing = Layout.under(f"{tmp_root}/lake"), f"{tmp_root}/landing"
        for k in range(3):
            _page(landing, f"p{k}", [_defect(10 * k + i) for i in range(3)] + [_defect(0)])
            start_landing(spark, landing, layout.bronze, f"{tmp_root}/ck").awaitTermination(120)
        assert len(snapshots.versions(spark, f"{layout.bronze}/defects")) == 3
        silver = transform(spark, layout, THREE, date_range=DAYS).silver["defects"]
        assert ids(silver, "defect_id") == [0, 1, 2, 10, 11, 12, 20, 21, 22]

    def test_a_capped_stream_loses_nothing(self, spark, tmp_root):
        layout, landing = Layout.under(f"{tmp_root}/lake"), f"{tmp_root}/landing"
        for k in range(4):
            _page(landing, f"p{k}", [_defect(k)])
        start_landing(spark, landing, layout.bronze, f"{tmp_root}/ck", max_files_per_trigger=1).awaitTermination(120)
        assert ids(clean_all(spark, layout, ONE)[1]["defects"], "defect_id") == [0, 1, 2, 3]

    def test_a_full_extraction_replaces_what_came_before(self, spark, tmp_root):
        layout = Layout.under(tmp_root)

        def land(name, rows, version, increment):
            _page(f"{tmp_root}/{name}", "p", rows)
            payload.land_payload(spark, f"{tmp_root}/{name}", layout.bronze, version, increment=increment)
        land("a", [_defect(1)], "20260101T000000", False)
        land("b", [_defect(2), _defect(1)], "20260102T000000", True)
        assert ids(feed.read_live(spark, f"{layout.bronze}/defects"), "defect_id") == [1, 1, 2]
        assert ids(clean_all(spark, layout, ONE)[1]["defects"], "defect_id") == [1, 2]
        land("c", [_defect(3)], "20260103T000000", False)
        land("d", [_defect("D4", shade="red")], "20260104T000000", True)   # ids become text, a column comes
        assert ids(feed.read_live(spark, f"{layout.bronze}/defects"), "defect_id") == ["3", "D4"]
        assert ids(clean_all(spark, layout, TWO)[1]["defects"], "defect_id") == ["3", "D4"]

    def test_the_log_tells_what_is_pending(self, spark, tmp_root):
        layout = Layout.under(tmp_root)
        bronze, silver = f"{layout.bronze}/defects", f"{layout.silver}/defects"
        rows = spark.createDataFrame([(1, "a", None)], "defect_id long, defect_type string, corrective_action string")
        snapshots.write_snapshot(rows, bronze, ONE)
        assert list(feed.pending(spark, bronze, silver)) == [ONE]
        clean_all(spark, layout, ONE)
        assert feed.pending(spark, bronze, silver) == {} and list(feed.consumed(spark, silver)) == [ONE]
        paths, frames = clean_all(spark, layout, TWO, only_pending=True)
        assert paths == {} and frames["defects"].count() == 1
        feed.mark_increment(spark, bronze, TWO)
        snapshots.write_snapshot(rows.withColumn("defect_id", F.lit(2).cast("long")), bronze, TWO)
        assert list(feed.pending(spark, bronze, silver)) == [TWO]
        paths, frames = clean_all(spark, layout, THREE, only_pending=True)
        assert list(paths) == ["defects"] and frames["defects"].count() == 2
        snapshots.write_snapshot(rows, bronze, TWO)                        # written again
        assert list(feed.pending(spark, bronze, silver)) == [TWO]


class TestManifest:
    def test_no_table_is_left_out(self, spark, tmp_root):
        gold = f"{tmp_root}/gold"
        for table, version, rows in (("fact_old", ONE, 4), ("dim_x", ONE, 5), ("dim_x", TWO, 7), ("custom", TWO, 2)):
            snapshots.write_snapshot(spark.range(rows), f"{gold}/{table}", version)
        export.begin_run(spark, gold, ONE)
        export.finish_run(spark, gold, ONE, {"dim_x": ONE})
        spark.range(3).write.parquet(f"{gold}/plain")
        spark.range(3).write.parquet(f"{gold}/half/snapshot_ts={ONE}")
        os.remove(f"{gold}/half/snapshot_ts={ONE}/_SUCCESS")
        out = export.export_tables(spark, gold, ParquetSink(f"{tmp_root}/out"))
        assert {t: spark.read.parquet(p).count() for t, p in out.items()} == {
            "fact_old": 4, "dim_x": 7, "custom": 2, "plain": 3}
        one = export.export_table(spark, gold, "dim_x", ParquetSink(f"{tmp_root}/one"))
        assert spark.read.parquet(one).count() == 7
        pinned = export.export_tables(spark, gold, ParquetSink(f"{tmp_root}/run"), run=ONE)
        assert {t: spark.read.parquet(p).count() for t, p in pinned.items()} == {"dim_x": 5}
        with pytest.raises(FileNotFoundError):
            export.export_tables(spark, gold, ParquetSink(f"{tmp_root}/no"), run=THREE)
        with pytest.raises(FileNotFoundError, match="half"):
            export.export_tables(spark, gold, ParquetSink(f"{tmp_root}/no"), tables=["half"])

    def test_an_open_run_stays_out(self, spark, tmp_root):
        gold = f"{tmp_root}/gold"
        snapshots.write_snapshot(spark.range(1), f"{gold}/dim_x", ONE)
        export.begin_run(spark, gold, TWO)
        snapshots.write_snapshot(spark.range(2), f"{gold}/dim_x", TWO)
        snapshots.write_snapshot(spark.range(2), f"{gold}/dim_new", TWO)

        def counts(out):
            return {t: spark.read.parquet(p).count()
                    for t, p in export.export_tables(spark, gold, ParquetSink(f"{tmp_root}/{out}")).items()}
        assert counts("a") == {"dim_x": 1, "dim_new": 2}
        export.finish_run(spark, gold, TWO, {"dim_x": TWO, "dim_new": TWO})
        assert counts("b") == {"dim_x": 2, "dim_new": 2}
        assert export.manifest(spark, gold, export.latest_run(spark, gold)) == {"dim_x": TWO, "dim_new": TWO}


class TestTypeDrift:
    @pytest.mark.parametrize("a,b,common", [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "decimal(5,2)", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", "string"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("bigint", "string", "string"),
        ("boolean", "int", "string"), ("void", "date", "date"), ("array<int>", "array<string>", "array<string>"),
        ("struct<a:int>", "struct<b:int,a:bigint>", "struct<a:bigint,b:int>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"), ("array<int>", "int", "string")])
    def test_common_type(self, a, b, common):
        kinds = [T._parse_datatype_string(x) if x != "void" else T.NullType() for x in (a, b)]
        assert common_type(*kinds).simpleString() == common
        if not common.startswith("struct"):
            assert common_type(*reversed(kinds)).simpleString() == common

    def test_versions_of_different_types(self, spark, tmp_root):
        table = f"{tmp_root}/t"
        one = spark.createDataFrame([(1, [1], {"a": 1}, (1,), 3)], "id long, l array<int>, m map<string,int>, s struct<x:int>, n int")
        two = spark.createDataFrame([("A1", ["z"], {"b": .5}, ("q", 2), None)],
                                    "id string, l array<string>, m map<string,double>, s struct<x:string,y:int>, extra string")
        three = spark.createDataFrame([(None, None, None, None, "e")], two.schema)
        for df, version in ((one, ONE), (two, TWO), (three, THREE)):
            snapshots.write_snapshot(df, table, version)
        back = snapshots.read_all_versions(spark, table, with_version=True)
        assert back.schema["id"].dataType == T.StringType() and back.columns[-1] == "snapshot_ts"
        rows = {r["snapshot_ts"]: r for r in back.collect()}
        assert rows[ONE]["id"] == "1" and rows[ONE]["l"] == ["1"] and rows[ONE]["m"] == {"a": 1.0}
        assert tuple(rows[ONE]["s"]) == ("1", None) and rows[ONE]["extra"] is None and rows[ONE]["n"] == 3
        assert tuple(rows[TWO]["s"]) == ("q", 2) and rows[TWO]["n"] is None
        assert rows[THREE]["s"] is None and rows[THREE]["extra"] == "e"

    def test_versions_of_one_schema_are_one_scan(self, spark, tmp_root):
        for k in range(6):
            df = spark.range(2).selectExpr("id", "'x' AS v") if k % 2 else spark.range(2).selectExpr("cast(id AS int) id")
            snapshots.write_snapshot(df, f"{tmp_root}/t", f"2026010{k + 1}T000000")
        df = snapshots.read_all_versions(spark, f"{tmp_root}/t")
        assert df.count() == 12
        assert df._jdf.queryExecution().analyzed().toString().count("Relation [") == 2

    def test_common_schema_keeps_the_order_of_appearance(self):
        a, b = (T._parse_datatype_string(x) for x in ("a int, b string", "c date, a bigint"))
        assert common_schema([a, b]).simpleString() == "struct<a:bigint,b:string,c:date>"


class TestCsvSidecar:
    ODD = [None, "a", "", None, " ", " \t", "\n", "\r\n", r"\N", r"\NN", "N", "#x", '"', '""', 'a"b', "\\", "a,b", "null"]

    @pytest.mark.parametrize("header", [True, False])
    def test_one_text_column(self, spark, tmp_root, header):
        df = spark.createDataFrame([(v,) for v in self.ODD], "s string")
        path = CsvSink(tmp_root, include_header=header).write(df, "t")
        back = read_csv_export(spark, path)
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str) and back.schema == df.schema
        assert export_spec(spark, path)["null"] == r"\NNN"

    @pytest.mark.parametrize("kind,values", [("long", [None, 1, None]), ("boolean", [None, True]), ("string", [None] * 3),
                                             ("string", [""] * 3), ("string", [])])
    def test_other_lone_columns(self, spark, tmp_root, kind, values):
        df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
        back = read_csv_export(spark, CsvSink(tmp_root).write(df, "t"))
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)

    def test_the_sidecar_serves_as_schema_and_options(self, spark, tmp_root):
        df = spark.createDataFrame([(1, None, dt.date(2024, 1, 2)), (None, "a;b", None)], "a long, b string, c date")
        path = CsvSink(tmp_root, delimiter=";", include_header=False).write(df, "t")
        assert read_csv_export(spark, path).schema == df.schema
        assert sorted(read_csv_export(spark, path).collect(), key=str) == sorted(df.collect(), key=str)
        os.remove(f"{path}/_schema.json")
        with pytest.raises(ValueError, match="schema"):
            read_csv_export(spark, path)
        assert read_csv_export(spark, path, df.schema, ";", False).count() == 2

    def test_null_text_avoids_the_values(self, spark):
        assert null_text(spark.createDataFrame([("x",)], "s string")) == r"\N"
        assert null_text(spark.createDataFrame([("\\NNN",)], "s string")) == r"\NNNN"
        assert null_text(spark.createDataFrame([(1, "x")], "a long, s string")) == ""


def test_landed_bytes_come_from_a_listing(spark, tmp_root, monkeypatch):
    _page(f"{tmp_root}/a", "p", [_defect(1)])
    _page(f"{tmp_root}/b", "q", [_defect(2)])
    total = sum(os.path.getsize(f"{tmp_root}/{p}") for p in ("a/p.json", "b/q.json"))
    monkeypatch.setattr(fs, "_fs_and_path", lambda *a: (_ for _ in ()).throw(AssertionError("a call for a file")))
    assert payload.landed_bytes(spark, [f"{tmp_root}/a", f"{tmp_root}/b"]) == total
    plan = payload.landed_files(spark, f"{tmp_root}/a").select("length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
