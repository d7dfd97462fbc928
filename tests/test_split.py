"""Multi-line documents cut by byte ranges give the rows that one parser gives."""
from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millstar.plans.pipeline import Layout, run_pipeline
from millstar.sources import payload, split

TEXTS = ["plain", 'a "quoted" one', "br{ace}s [and] more}", "back\\slash\\", "é 日本 🎉", "new\nline", "", "}", '{"a": [1]}',
         "\\\"", "x" * 300, '"},{"']


def document(rnd, sizes):
    def row(i):
        return {"id": i, "note": rnd.choice(TEXTS), "part": {"deep": [{"k": rnd.choice(TEXTS)}] * rnd.randrange(3)},
                "empty": None}
    tables = {name: [row(i) for i in range(n)] for name, n in sizes}
    return {"meta": {"tables": [{"id": -1}], "x": {"y": {"id": -2}}}, "tables": tables, "after": {"z": [{"id": -3}]}}


def landed_rows(docs):
    out = []
    for doc in docs:
        for name, rows in doc["tables"].items():
            out += [(name, json.dumps(r, sort_keys=True)) for r in rows]
    return sorted(out)


def paged_rows(spark, path):
    return landed_rows([json.loads(r["value"]) for r in spark.read.text(path).collect()])


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("limit", [397, 5000, 1 << 20])
def test_rows_and_tables_survive_any_cut(spark, tmp_root, indent, limit):
    rnd = random.Random(limit)
    docs = [document(rnd, [("a", 60), ("none", 0), ("b}\"{", 1), ("c", 25)]), document(rnd, [("c", 9)]),
            document(rnd, [])]
    os.makedirs(f"{tmp_root}/landing")
    for k, doc in enumerate(docs):
        with open(f"{tmp_root}/landing/{k}.json", "w") as fh:
            json.dump(doc, fh, indent=indent, ensure_ascii=bool(indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(limit))
    try:
        pages = split.paginate(spark, f"{tmp_root}/landing", f"{tmp_root}/out")
        assert paged_rows(spark, pages) == landed_rows(docs)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_long_document_lands_by_many_tasks(spark, tmp_root, monkeypatch):
    rows = [{"shift_id": i, "shift_name": TEXTS[i % len(TEXTS)], "start_time": "06:00", "end_time": "14:00",
             "shift_duration_hrs": 8} for i in range(3000)]
    os.makedirs(f"{tmp_root}/landing")
    with open(f"{tmp_root}/landing/one.json", "w") as fh:
        json.dump({"tables": {"shifts": rows, "alerts": []}}, fh, indent=1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pages, multi_line = payload.splittable(spark, f"{tmp_root}/landing", True, f"{tmp_root}/pages")
        assert not multi_line
        pieces = spark.read.parquet(f"{tmp_root}/pages/_pieces")
        assert pieces.select("split").distinct().count() > 10
        layout = Layout.under(f"{tmp_root}/lake")
        out = run_pipeline(spark, f"{tmp_root}/landing", layout, "20260101T000000")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    silver = out["transform"].silver["shifts"]
    got = sorted((r["shift_id"], r["shift_name"]) for r in silver.collect())
    assert got == sorted((r["shift_id"], r["shift_name"]) for r in rows)
    assert payload.splittable(spark, f"{tmp_root}/landing", True, "unused")[1] is True   # short enough for one task
