"""Silver grown by increments equals silver of one pass; the index is pruned to the buckets that new rows touch."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millstar.operators import cleaning
from millstar.plans import incremental as inc
from millstar.plans.pipeline import Layout, clean_all
from millstar.sources import feed, snapshots

SCHEMA = "log_id long, machine_id long, performed_by string, cost double, performed_date timestamp, parts_replaced string"
DAY = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)


def row(i, **more):
    return (i, i % 7, more.get("by"), more.get("cost", i / 2), more.get("day", DAY), None)


def land(spark, layout, version, rows, increment=True, schema=SCHEMA):
    folder = f"{layout.bronze}/maintenance_logs"
    if increment:
        feed.mark_increment(spark, folder, version)
    snapshots.write_snapshot(spark.createDataFrame(rows, schema), folder, version)


def grown(spark, layout, version):
    return bag(clean_all(spark, layout, version, incremental=True)[1]["maintenance_logs"])


def bag(df):
    return sorted(map(str, map(tuple, df.select(sorted(df.columns)).collect())))


def whole(spark, layout):
    return bag(cleaning.clean_table(feed.read_live(spark, f"{layout.bronze}/maintenance_logs"), "maintenance_logs"))


def test_two_landings_with_repeats_equal_one(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(inc, "ROWS_PER_BUCKET", 40)
    layout = Layout.under(tmp_root)
    first = [row(i) for i in range(200)] + [row(0), (None, 1, None, 1.0, None, None)]
    land(spark, layout, "20260101T000000", first)
    assert grown(spark, layout, "20260101T000000") == whole(spark, layout)
    second = [row(5), row(6), row(300), row(300), row(7, cost=-0.0), row(7, cost=0.0), (8, 1, None, 4.0, None, None),
              row(9, day=DAY.replace(microsecond=123457))]
    land(spark, layout, "20260102T000000", second)
    full_passes = []
    real = cleaning.clean_table
    monkeypatch.setattr(cleaning, "clean_table", lambda df, *a: full_passes.append(df.count()) or real(df, *a))
    silver = grown(spark, layout, "20260102T000000")
    monkeypatch.undo()
    assert silver == whole(spark, layout)
    assert full_passes == [4]          # 300, one of the two zeros, (8, ...) and the other microsecond
    assert grown(spark, layout, "20260103T000000") == silver   # nothing new
    land(spark, layout, "20260104T000000", [row(300), row(301)])
    assert grown(spark, layout, "20260104T000000") == whole(spark, layout)


def test_the_plan_prunes_the_index(spark, tmp_root):
    rows = inc.with_digest(spark.range(500).selectExpr("id", "'x' AS v"), 16)
    inc._write_index(rows, f"{tmp_root}/index", 16)
    plan = inc.seen(spark, [f"{tmp_root}/index"], [3, 4])
    files = {f.rsplit("/", 2)[-2] for f in plan.inputFiles()}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and inc.BUCKET in text.split("PartitionFilters: [")[1].split("]")[0]
    assert plan.count() == rows.where(F.col(inc.BUCKET).isin(3, 4)).count()
    assert len(files) >= 2


def test_what_cannot_grow_is_made_anew(spark, tmp_root):
    layout = Layout.under(tmp_root)
    land(spark, layout, "20260101T000000", [row(1), row(2)])
    grown(spark, layout, "20260101T000000")
    land(spark, layout, "20260102T000000", [("L3", 1, None, 1.0, None, "x"), ("1", 1, None, .5, DAY, None)],
         schema=SCHEMA.replace("log_id long", "log_id string"))               # ids become text
    assert grown(spark, layout, "20260102T000000") == whole(spark, layout)
    land(spark, layout, "20260103T000000", [row(9)], increment=False)         # a full extraction
    assert grown(spark, layout, "20260103T000000") == whole(spark, layout)
    land(spark, layout, "20260103T000000", [row(9), row(10)], increment=False)  # written again
    assert grown(spark, layout, "20260104T000000") == whole(spark, layout)


def test_long_chains_are_written_whole(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(inc, "CHAIN", 2)
    layout = Layout.under(tmp_root)
    for k in range(4):
        version = f"2026010{k + 1}T000000"
        land(spark, layout, version, [row(10 * k + i) for i in range(3)] + [row(0)])
        assert grown(spark, layout, version) == whole(spark, layout)
    assert len(inc._index(spark, f"{layout.silver}/maintenance_logs")["folders"]) <= 2
