import datetime as dt
import os

import pytest

from harness.adapter import BRONZE_TABLES, bronze
from millstar.plans.pipeline import Layout, run_pipeline, transform
from millstar.sinks.csv import CsvSink
from millstar.sources import catalog, snapshots
from millstar.schemas import GOLD_COLUMNS

from conftest import SF_SMALL

VERSION = "20260101T000000"


def _land(spark, layout, tables=BRONZE_TABLES):
    for t in tables:
        snapshots.write_snapshot(bronze(spark, SF_SMALL, t), f"{layout.bronze}/{t}", VERSION)


def test_transform_writes_every_gold_table(spark, tmp_root):
    layout = Layout.under(tmp_root)
    _land(spark, layout)
    result = transform(spark, layout, VERSION)
    assert result.skipped_facts == []
    assert len(result.silver) == 14
    assert len(result.dimensions) == 12 and len(result.facts) == 5
    assert sorted(catalog.list_tables(spark, layout.gold)) == sorted(
        list(result.dimensions) + list(result.facts))
    for name, df in {**result.dimensions, **result.facts}.items():
        if name in GOLD_COLUMNS:
            assert df.columns == GOLD_COLUMNS[name], name
    # one row per source row when dimension keys are unique
    assert result.facts["fact_sensor_readings"].count() == result.silver["sensor_readings"].count()
    assert result.facts["fact_alerts"].count() == result.silver["alerts"].count()
    sk = result.facts["fact_quality"].select("quality_sk")
    assert sk.distinct().count() == sk.count()
    assert snapshots.latest_version(spark, f"{layout.gold}/fact_alerts") == VERSION


def test_missing_inputs_skip_facts(spark, tmp_root):
    layout = Layout.under(tmp_root)
    _land(spark, layout, ["sensor_readings", "sensors", "machines", "production_lines"])
    result = transform(spark, layout, VERSION)
    assert list(result.facts) == ["fact_sensor_readings"]
    assert sorted(result.skipped_facts) == ["fact_alerts", "fact_maintenance",
                                            "fact_production", "fact_quality"]
    assert "dim_date" in result.dimensions and "dim_time" in result.dimensions
    assert "dim_order" not in result.dimensions


def test_run_pipeline_from_landed_payload(spark, tmp_root):
    from harness.landing import pack_pages
    landing = f"{tmp_root}/landing"
    for t in ("sensor_readings", "sensors", "machines", "production_lines"):
        pack_pages(bronze(spark, SF_SMALL, t), t).write.text(f"{landing}/{t}")
    layout = Layout.under(f"{tmp_root}/lake")
    out = run_pipeline(spark, [f"{landing}/{t}" for t in os.listdir(landing)], layout,
                       VERSION, sink=CsvSink(layout.exports), multi_line=False)
    assert sorted(out["landed"]) == ["machines", "production_lines", "sensor_readings", "sensors"]
    assert "fact_sensor_readings" in out["exported"]
    assert out["transform"].facts["fact_sensor_readings"].count() == \
        bronze(spark, SF_SMALL, "sensor_readings").count()


def test_reproducible_fact_keys(spark, tmp_root):
    layout = Layout.under(tmp_root)
    _land(spark, layout, ["alerts", "sensors", "machines", "production_lines"])
    result = transform(spark, layout, VERSION, fact_sk_from={"fact_alerts": "alert_id"})
    f = result.facts["fact_alerts"]
    ids = {r["alert_id"] for r in result.silver["alerts"].select("alert_id").collect()}
    assert {r["alert_sk"] for r in f.select("alert_sk").collect()} == ids


def test_string_timestamps_in_alerts(spark, tmp_root):
    """Alerts landed with ISO 'T' string timestamps give the same facts as typed ones."""
    from pyspark.sql import functions as F
    typed, strings = Layout.under(f"{tmp_root}/typed"), Layout.under(f"{tmp_root}/strings")
    dims = ["sensors", "machines", "production_lines"]
    _land(spark, typed, ["alerts", *dims])
    _land(spark, strings, dims)
    alerts = bronze(spark, SF_SMALL, "alerts")
    for c in ("triggered_at", "acknowledged_at", "resolved_at"):
        alerts = alerts.withColumn(c, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"))
    snapshots.write_snapshot(alerts, f"{strings.bronze}/alerts", VERSION)
    cols = ["date_sk", "time_sk", "sensor_sk", "machine_sk", "line_sk", "alert_type_sk",
            "resolution_time_min", "acknowledged_flag", "severity_level"]
    a = transform(spark, typed, VERSION).facts["fact_alerts"].select(cols)
    b = transform(spark, strings, VERSION).facts["fact_alerts"].select(cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_export_takes_all_tables_from_the_newest_finished_run(spark, tmp_root, monkeypatch):
    """P3 fails after P2 wrote new dimensions: export still gives the run before, whole."""
    from millstar.plans import pipeline
    from millstar.sinks.base import ParquetSink
    from millstar.sinks.export import export_tables, latest_run
    layout = Layout.under(tmp_root)
    _land(spark, layout)
    days = (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    transform(spark, layout, "20260101T000000", date_range=days)
    monkeypatch.setattr(pipeline, "build_facts", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        transform(spark, layout, "20260102T000000", date_range=(days[0], days[0]))
    assert latest_run(spark, layout.gold) == "20260101T000000"
    out = export_tables(spark, layout.gold, ParquetSink(f"{tmp_root}/out"))
    assert len(out) == 17
    assert spark.read.parquet(out["dim_date"]).count() == 3   # the failed run's calendar had one day


def test_declared_types_reach_the_cleaner(spark, tmp_root):
    layout = Layout.under(tmp_root)
    _land(spark, layout, ("defects",))
    days = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    plain = transform(spark, layout, "20260101T000000", date_range=days, declared_types=False)
    assert dict(plain.silver["defects"].dtypes)["defect_id"] == dict(
        bronze(spark, "/root/testdata/sf0.001", "defects").dtypes)["defect_id"]
