import datetime as dt
import json
import os
import time

from millstar.plans.pipeline import Layout, transform
from millstar.schemas import BRONZE_SCHEMAS
from millstar.sources import payload, snapshots
from millstar.streaming.landing import start_landing


def _drop(landing, name, doc, mtime):
    path = f"{landing}/{name}.json"
    with open(path, "w") as fh:
        json.dump(doc, fh)
    os.utime(path, (mtime, mtime))


def _shift(i):
    return {"shift_id": i, "shift_name": f"S{i}", "start_time": "06:00",
            "end_time": "14:00", "shift_duration_hrs": 8}


BASE = 1_767_225_600  # 2026-01-01T00:00:00Z


def test_all_new_files_become_one_version_and_nothing_lands_twice(spark, tmp_root):
    landing, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/ckpt"
    os.makedirs(landing)
    schema = payload.payload_schema({"shifts": BRONZE_SCHEMAS["shifts"],
                                     "defects": BRONZE_SCHEMAS["defects"]})
    _drop(landing, "a", {"tables": {"shifts": [_shift(1), _shift(2)], "defects": []}}, BASE)
    _drop(landing, "b", {"tables": {"shifts": [_shift(3)]}}, BASE + 3600)

    start_landing(spark, landing, bronze, ckpt, schema).awaitTermination(120)
    first = snapshots.versions(spark, f"{bronze}/shifts")
    assert first == ["20260101T010000-000000000000"]
    assert snapshots.read_latest(spark, f"{bronze}/shifts").count() == 3
    assert snapshots.versions(spark, f"{bronze}/defects") == []

    # A restart with the same checkpoint lands nothing twice; a new file adds one version.
    _drop(landing, "c", {"tables": {"shifts": [_shift(4), _shift(5), _shift(6)]}}, BASE + 7200)
    time.sleep(1)
    start_landing(spark, landing, bronze, ckpt, schema).awaitTermination(120)
    assert snapshots.versions(spark, f"{bronze}/shifts") == first + ["20260101T020000-000000000001"]
    assert snapshots.read_all_versions(spark, f"{bronze}/shifts").count() == 6


def test_default_landing_keeps_every_row_of_same_second_pages(spark, tmp_root):
    """Default arguments; pages of one second; rows counted after cleaning."""
    landing, ckpt = f"{tmp_root}/landing", f"{tmp_root}/ckpt"
    layout = Layout.under(f"{tmp_root}/lake")
    os.makedirs(landing)
    for page in range(5):
        _drop(landing, f"p{page}", {"tables": {"shifts": [_shift(10 * page + i) for i in range(3)]}}, BASE)
    start_landing(spark, landing, layout.bronze, ckpt).awaitTermination(120)
    result = transform(spark, layout, "20260102T000000", date_range=(dt.date(2024, 1, 1), dt.date(2024, 1, 2)))
    assert sorted(r["shift_id"] for r in result.silver["shifts"].collect()) == sorted(
        10 * page + i for page in range(5) for i in range(3))


def test_capped_batches_of_one_second_do_not_overwrite_each_other(spark, tmp_root):
    landing, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/ckpt"
    os.makedirs(landing)
    for page in range(4):
        _drop(landing, f"p{page}", {"tables": {"shifts": [_shift(page)]}}, BASE)
    start_landing(spark, landing, bronze, ckpt, max_files_per_trigger=1).awaitTermination(120)
    assert len(snapshots.versions(spark, f"{bronze}/shifts")) == 4
    assert snapshots.read_all_versions(spark, f"{bronze}/shifts").count() == 4


def test_stream_keeps_undeclared_tables_and_columns(spark, tmp_root):
    landing, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/ckpt"
    os.makedirs(landing)
    _drop(landing, "a", {"tables": {"shifts": [{**_shift(1), "crew": "x"}], "energy_usage": [{"kwh": 1.5}]}}, BASE)
    start_landing(spark, landing, bronze, ckpt, declared=BRONZE_SCHEMAS).awaitTermination(120)
    assert snapshots.read_latest(spark, f"{bronze}/shifts").first()["crew"] == "x"
    assert snapshots.read_latest(spark, f"{bronze}/energy_usage").first()["kwh"] == 1.5
