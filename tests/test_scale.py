"""Steps whose shuffled, written or held bytes must not grow beyond what the rows need."""
from __future__ import annotations

import glob
import json
import threading
import time

import pytest

from harness.adapter import bronze
from harness.landing import one_document, pack_pages
from millstar.operators import cleaning, lookup
from millstar.plans import incremental, pipeline
from millstar.plans.pipeline import Layout, clean_all
from millstar.sinks.csv import CsvSink, read_csv_export
from millstar.sources import buckets, feed, payload, snapshots, split

from conftest import SF_SMALL

VERSION = "20260101T000000"


def bag(df):
    return sorted(map(str, map(tuple, df.collect())))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- C1 over rows that are mostly distinct (F2 to F5, F7 to F11) ---------------

ROWS = [(1, "a", 0.0), (1, "a", -0.0), (2, None, None), (2, None, None), (None, "x", float("nan")), (3, "b", -0.0),
        (None, "x", float("nan")), (3, "b", 1.0), (None, None, None), (4, "", 2.0), (4, None, 2.0), (1, "a", 0.0)]


@pytest.mark.parametrize("few", [0, 2, 1000])
def test_few_copies_give_the_rows_of_a_whole_comparison(spark, tmp_root, monkeypatch, few):
    monkeypatch.setattr(cleaning, "FEW_COPIES", few)
    spark.createDataFrame(ROWS, "id long, name string, value double").write.parquet(f"{tmp_root}/rows")
    rows = spark.read.parquet(f"{tmp_root}/rows")
    assert bag(cleaning.drop_few_duplicates(rows)) == bag(cleaning.drop_exact_duplicates(rows))


def test_few_copies_of_nested_rows(spark):
    rows = spark.createDataFrame([(1, [1]), (1, [1]), (2, None)], "id long, parts array<int>")
    assert bag(cleaning.drop_few_duplicates(rows)) == bag(rows.dropDuplicates())


def test_silver_of_distinct_rows_shuffles_no_rows(spark, tmp_root, monkeypatch):
    layout, seen = Layout.under(tmp_root), {}
    snapshots.write_snapshot(bronze(spark, SF_SMALL, "quality_checks"), f"{layout.bronze}/quality_checks", VERSION)
    real = snapshots.write_snapshot
    monkeypatch.setattr(snapshots, "write_snapshot", lambda df, *a: seen.update(plan=plan(df)) or real(df, *a))
    silver = clean_all(spark, layout, VERSION)[1]["quality_checks"]
    assert "Exchange" not in seen["plan"]
    assert bag(silver) == bag(cleaning.clean_table(bronze(spark, SF_SMALL, "quality_checks"), "quality_checks"))


def test_versions_are_written_with_zstd(spark, tmp_root):
    path = snapshots.write_snapshot(spark.range(10), f"{tmp_root}/t", VERSION)
    assert glob.glob(f"{path}/*.zstd.parquet")


# --- pages and documents (F1, F6) ---------------------------------------------

def test_pages_are_packed_where_rows_are_read(spark):
    rows = spark.range(0, 1000, 1, 3).selectExpr("id", "IF(id % 3 = 0, NULL, concat('\"é', id)) AS note")
    pages = pack_pages(rows, 'ta"ble', 64, ("none",))
    assert "Exchange" not in plan(pages)
    docs = [json.loads(r["value"])["tables"] for r in pages.collect()]
    assert all(d["none"] == [] and 0 < len(d['ta"ble']) <= 64 for d in docs)
    assert sorted((r["id"], r.get("note")) for d in docs for r in d['ta"ble']) == sorted(map(tuple, rows.collect()),
                                                                                       key=lambda r: r[0])


def test_one_document_is_built_by_many_tasks_and_cut_by_bounded_ones(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(split, "TASKS_PER_CORE", 2)
    rows = spark.range(0, 20000, 1, 4).selectExpr("id", "concat('{', id, '}') AS note")
    one_document(rows, "t").write.text(f"{tmp_root}/landing")
    files = glob.glob(f"{tmp_root}/landing/part-*")
    assert len(files) == 1
    doc = json.loads(open(files[0]).read())["tables"]["t"]
    assert doc[0] is None and len(doc) == 20001
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")      # some 180 ranges
    try:
        pages = split.paginate(spark, f"{tmp_root}/landing", f"{tmp_root}/out")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    assert len(glob.glob(f"{tmp_root}/out/_pieces/part-*")) <= 4 * spark.sparkContext.defaultParallelism
    found = [r for p in spark.read.text(pages).collect() for r in json.loads(p["value"])["tables"]["t"]]
    assert sorted(r["id"] for r in found) == list(range(20000))


def test_compressed_export_reads_back(spark, tmp_root):
    df = spark.createDataFrame([(1, "a\n\"b\""), (2, None), (3, "")], "id long, note string")
    path = CsvSink(tmp_root, compression="gzip").write(df, "notes")
    assert glob.glob(f"{path}/*.csv.gz")
    assert bag(read_csv_export(spark, path)) == bag(df)


# --- increments (F8) -----------------------------------------------------------

def test_the_index_holds_short_digests_and_an_older_one_is_made_anew(spark, tmp_root):
    layout = Layout.under(tmp_root)
    table, silver_dir = f"{layout.bronze}/sensors", f"{layout.silver}/sensors"

    def land(version, ids):
        feed.mark_increment(spark, table, version)
        snapshots.write_snapshot(spark.createDataFrame([(i, f"s{i}") for i in ids], "sensor_id long, sensor_name string"),
                                 table, version)
        return sorted(r["sensor_id"] for r in clean_all(spark, layout, version, incremental=True)[1]["sensors"].collect())
    assert land("20260101T000000", [1, 2, 2]) == [1, 2]
    index = incremental._index(spark, silver_dir)
    digests = incremental.seen(spark, index["folders"], list(range(index["buckets"]))).collect()
    assert [len(r[incremental.DIGEST]) for r in digests] == [16, 16]
    assert land("20260102T000000", [2, 3]) == [1, 2, 3]
    log = incremental._log(silver_dir, "20260102T000000")
    old = {k: v for k, v in incremental._index(spark, silver_dir).items() if k != "digest_bytes"}
    incremental.fs.write_text(spark, log, json.dumps(old))
    assert land("20260103T000000", [3, 4]) == [1, 2, 3, 4]
    assert len(incremental._index(spark, silver_dir)["folders"]) == 1


# --- buckets (F12) -------------------------------------------------------------

def test_buckets_grow_with_the_largest_order_table(spark, tmp_root, monkeypatch):
    layout = Layout.under(tmp_root)
    snapshots.write_snapshot(bronze(spark, SF_SMALL, "production_orders"), f"{layout.bronze}/production_orders", VERSION)
    assert pipeline.bucket_count(spark, layout, 8) == 8
    monkeypatch.setattr(pipeline, "ROWS_PER_BUCKET", 100)
    n = bronze(spark, SF_SMALL, "production_orders").count()
    found = pipeline.bucket_count(spark, layout, 8)
    assert found * 100 >= n > found * 50
    result = pipeline.transform(spark, layout, VERSION, order_buckets=8)
    assert buckets.bucketing(spark, result.written["silver/production_orders"]) == ("order_id", found)


# --- broadcast sides on the driver (F2 to F7, F9) --------------------------------

def test_hinted_sides_fit_into_the_room_of_the_driver(spark, monkeypatch):
    slim = {d: spark.range(20).selectExpr("id AS k", "id AS s") for d in "de"}
    looks = [lookup.Lookup(d, (("fk", "k"),), (("s", d),)) for d in "de"]
    monkeypatch.setattr(lookup, "broadcast_room", lambda spark: 2 * 20 * 64 - 1)
    assert lookup.strategies(slim, looks, 100) == ["hint", "salt"]
    assert lookup.hinted_bytes(slim, looks, 100) == 20 * 64
    fact = spark.createDataFrame([(1,), (30,), (None,), (1,)], "fk long")
    assert bag(lookup.resolve(fact, slim, looks)) == bag(lookup.resolve(fact, slim, looks, lookup.PLAIN))


def test_facts_written_at_once_share_the_room_of_the_driver(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(pipeline, "broadcast_room", lambda spark: 10)
    need, under_way, most, guard = {"a": 6, "b": 6, "c": 4, "d": 99, "e": 0}, set(), [], threading.Lock()

    def watched(df, path, version):
        name = path.rsplit("/", 1)[-1]
        with guard:
            under_way.add(name)
            most.append(sum(min(10, need[n]) for n in under_way))
        time.sleep(0.2)
        with guard:
            under_way.remove(name)
        return tmp_root
    monkeypatch.setattr(snapshots, "write_snapshot", watched)
    written = pipeline._write_layer(spark, {n: lambda: spark.range(1) for n in need}, tmp_root, VERSION, 4,
                                    broadcasts={n: lambda n=n: need[n] for n in need})[0]
    assert set(written) == set(need) and max(most) <= 10


def test_repeated_hashes_beyond_the_room_of_the_driver_are_not_broadcast(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(cleaning, "broadcast_room", lambda spark: 100)
    spark.createDataFrame(ROWS, "id long, name string, value double").write.parquet(f"{tmp_root}/rows")
    few = cleaning.drop_few_duplicates(spark.read.parquet(f"{tmp_root}/rows"))
    assert "Broadcast" not in plan(few)
    assert bag(few) == bag(cleaning.drop_exact_duplicates(spark.read.parquet(f"{tmp_root}/rows")))


# --- staged pages (F8) ------------------------------------------------------------

def test_staged_pages_are_read_in_batches_of_bounded_rows(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(payload, "ROWS_AT_ONCE", 300)
    before, seen = spark.conf.get(payload._BATCH), {}
    rows = spark.range(0, 1000, 1, 2).selectExpr("id", "IF(id % 3 = 0, NULL, concat('n', id)) AS sizes")
    (pack_pages(rows, "t", 64, ("none",)).unionByName(pack_pages(rows.limit(0), "void"))
     .unionByName(pack_pages(rows.where("id < 5"), "few", 2)).write.text(f"{tmp_root}/landing"))
    write, find = payload.write_snapshot, payload.largest_pages

    def watched(df, path, version):
        seen[path.rsplit("/", 1)[-1]] = int(spark.conf.get(payload._BATCH))
        return write(df, path, version)

    def found(pages, names, staged):
        seen["plan"] = plan(pages.select(f"{payload._SIZES}.*")) if staged else ""
        return find(pages, names, staged)
    monkeypatch.setattr(payload, "write_snapshot", watched)
    monkeypatch.setattr(payload, "largest_pages", found)
    landed = payload.land_payload(spark, f"{tmp_root}/landing", f"{tmp_root}/bronze", VERSION, multi_line=False)
    read = seen.pop("plan")
    assert seen == {"t": 4, "few": 4} and spark.conf.get(payload._BATCH) == before
    assert "sizes" in read and "tables" not in read.split("ReadSchema")[1]
    assert bag(spark.read.parquet(landed["t"])) == bag(rows) and spark.read.parquet(landed["few"]).count() == 5
    assert payload.land_payload(spark, f"{tmp_root}/landing", f"{tmp_root}/plain", VERSION, multi_line=False,
                                stage=False).keys() == landed.keys()
