#!/usr/bin/env python
"""Benchmark: the whole pipeline at $BENCH_SF_DIR on local[$BENCH_CPUS].

Steps (all timed, one Spark session):
  land_bronze      adapter tables -> 14 bronze versions
  clean_<table>    bronze -> silver, per table        (P1)
  dim_<name>       silver -> gold dimension, each     (P2)
  fact_<name>      silver + gold dims -> gold fact    (P3)
  export_csv       every gold table -> CSV            (S9-S11)
  pipeline_total   all of the above with independent writes submitted in
                   parallel (the headline metric); the per-table numbers come
                   from a second, one-write-at-a-time run (pipeline_total_sequential)
  refshape_*         the same bronze -> gold -> CSV run in the reference's plan shape:
                     cleaning recomputed by every consumer, window-numbered dimensions,
                     every output through coalesce(1), one write at a time;
                     compare refshape_transform_export_total with transform_export_total
                     (ours, one write at a time) and transform_export_total_parallel
  dense_key_window_<n> / dense_key_range_<n>   single-partition window vs range form
  fact_*_order_lookups_shuffled   F1/F2 with the order lookups past the broadcast
                     bound (salted shuffle joins), small dimensions still broadcast

A warm-up pass on sf0.001 runs first (JIT/codegen), outside the metric.
BENCH_REPLICATE=k (default 1, off) adds a run with every fact source landed k times
(x<k>_pipeline_total), to see how the pipeline grows with the data on one machine.
shuffle_write_mb_main / shuffle_write_mb_refshape: shuffle bytes written by the
headline run and by the reference-shape run (from Spark's event log).
Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from harness.adapter import BRONZE_TABLES, bronze  # noqa: E402
from millstar.operators import cleaning, facts  # noqa: E402
from millstar.operators.lookup import PLAIN  # noqa: E402
from millstar.operators.dense_key import dense_key, dense_key_window  # noqa: E402
from millstar.plans.pipeline import Layout, transform  # noqa: E402
from millstar.session import build_session, scratch_path  # noqa: E402
from millstar.sinks.csv import CsvSink  # noqa: E402
from millstar.sinks.export import export_tables  # noqa: E402
from millstar.sources import snapshots  # noqa: E402

VERSION = "20260101T000000"
PARALLEL = 8


# Optional scale-out of the fact sources (BENCH_REPLICATE=k): k copies of each, the
# row id offset per copy so rows stay distinct; foreign keys are unchanged.
FACT_SOURCE_IDS = {"production_output": "output_id", "quality_checks": "check_id",
                   "defects": "defect_id", "maintenance_logs": "log_id",
                   "alerts": "alert_id", "sensor_readings": "reading_id"}


def bronze_table(spark, sf_dir, t, replicate):
    df = bronze(spark, sf_dir, t)
    if replicate <= 1 or t not in FACT_SOURCE_IDS:
        return df
    idc = FACT_SOURCE_IDS[t]
    return (df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(replicate - 1))))
              .withColumn(idc, F.col(idc) + F.col("__copy").cast("long") * F.lit(10**12))
              .drop("__copy"))


def land(spark, sf_dir, layout, parallel, replicate=1):
    def one(t):
        snapshots.write_snapshot(bronze_table(spark, sf_dir, t, replicate),
                                 f"{layout.bronze}/{t}", VERSION)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(one, BRONZE_TABLES))


def run_pipeline(spark, sf_dir, tag, parallel, replicate=1):
    """Land -> transform -> CSV export; per-table seconds are exact when parallel == 1."""
    layout = Layout.under(scratch_path(spark, f"bench-{tag}"))
    q = {}
    t0 = time.perf_counter()
    land(spark, sf_dir, layout, parallel, replicate)
    q["land_bronze"] = time.perf_counter() - t0
    result = transform(spark, layout, VERSION, parallel_writes=parallel)
    for name, sec in result.seconds.items():
        key = name if name.startswith(("dim_", "fact_", "layer_")) else f"clean_{name}"
        q[key] = sec
    t1 = time.perf_counter()
    export_tables(spark, layout.gold, CsvSink(layout.exports), parallel_writes=parallel)
    q["export_csv"] = time.perf_counter() - t1
    q["pipeline_total"] = time.perf_counter() - t0
    return q, layout


def reference_shape_pipeline(spark, layout):
    """The reference's plan shape over the same bronze: every consumer recomputes the
    cleaning from bronze, dimensions numbered by a single-partition window, every output
    written one at a time through coalesce(1), the export reading the written gold tables."""
    from millstar.operators import dimensions as D
    from millstar.schemas import TABLE_IDS
    out_root = scratch_path(spark, "bench-refshape")
    q = {}

    def one_file(df, path):
        df.coalesce(1).write.mode("overwrite").parquet(path)

    t0 = time.perf_counter()
    cleaned = {t: cleaning.clean_table(snapshots.read_latest(spark, f"{layout.bronze}/{t}"), t)
               for t in TABLE_IDS}
    for t, df in cleaned.items():
        one_file(df, f"{out_root}/silver/{t}")
    t1 = time.perf_counter()
    dims = {"dim_date": D.build_dim_date(spark), "dim_time": D.build_dim_time(spark),
            "dim_product": D.build_dim_product(cleaned["production_orders"], "window"),
            "dim_alert_type": D.build_dim_alert_type(cleaned["alerts"], "window"),
            "dim_maintenance_type": D.build_dim_maintenance_type(cleaned["maintenance_logs"],
                                                                 "window")}
    for name, cfg in D.KEYED_COPIES.items():
        dims[name] = D.keyed_copy(cleaned[cfg.table], cfg)
    for name, df in dims.items():
        one_file(df, f"{out_root}/gold/{name}")
    t2 = time.perf_counter()
    built = {}
    for name, (tables, dim_names) in facts.FACT_REQUIREMENTS.items():
        inputs = {d: dims[d] for d in dim_names}
        inputs.update({t: cleaned[t] for t in tables[1:]})
        t_f = time.perf_counter()
        # Plain left joins: no measuring jobs, no hints, no salts.
        built[name] = facts.FACT_BUILDERS[name](cleaned[tables[0]], inputs, broadcast_max_rows=PLAIN)
        one_file(built[name], f"{out_root}/gold/{name}")
        q[f"refshape_{name}"] = time.perf_counter() - t_f
    t3 = time.perf_counter()
    for name in [*dims, *built]:  # the export reads the written gold tables
        spark.read.parquet(f"{out_root}/gold/{name}").coalesce(1).write.mode("overwrite").option("header", True).csv(
            f"{out_root}/exports/{name}")
    t4 = time.perf_counter()
    q.update(refshape_layer_silver=t1 - t0, refshape_layer_dimensions=t2 - t1,
             refshape_layer_facts=t3 - t2, refshape_export_csv=t4 - t3,
             refshape_transform_export_total=t4 - t0)
    return q


def at_scale_shape(spark, layout):
    """fact_production/fact_quality with the order lookups past the broadcast bound
    (shuffle joins with salted keys) while the small dimensions still broadcast --
    the plan these facts take once the orders table is large."""
    silver = {t: spark.read.parquet(snapshots.version_path(f"{layout.silver}/{t}", VERSION))
              for t in ("production_output", "production_orders", "quality_checks")}
    gold = {d: spark.read.parquet(snapshots.version_path(f"{layout.gold}/{d}", VERSION))
            for d in ("dim_date", "dim_shift", "dim_factory", "dim_production_line",
                      "dim_product", "dim_order", "dim_operator")}
    bound = max(1, gold["dim_order"].count() // 2)   # orders past it, everything else under
    out = {}
    for name, src in (("fact_production", "production_output"), ("fact_quality", "quality_checks")):
        tables, dim_names = facts.FACT_REQUIREMENTS[name]
        inputs = {d: gold[d] for d in dim_names}
        inputs.update({t: silver[t] for t in tables[1:]})
        t0 = time.perf_counter()
        df = facts.FACT_BUILDERS[name](silver[src], inputs, broadcast_max_rows=bound)
        df.write.mode("overwrite").parquet(scratch_path(spark, f"bench-{name}-shuffle"))
        out[f"{name}_order_lookups_shuffled"] = time.perf_counter() - t0
    return out


def dense_key_compare(spark, n):
    keys = spark.range(n).select((F.col("id") * 7919 % n).cast("string").alias("k"))
    out = {}
    for label, fn in (("window", dense_key_window), ("range", dense_key)):
        t0 = time.perf_counter()
        res = fn(keys, ["k"], "sk")
        res.write.mode("overwrite").format("noop").save()
        out[f"dense_key_{label}_{n:.0e}".replace("+0", "")] = time.perf_counter() - t0
    return out


def shuffle_mb(event_dir, windows):
    """Shuffle bytes written by tasks finishing inside each (start, end) window, in MB."""
    totals = {name: 0 for name in windows}
    for path in glob.glob(f"{event_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                ev = json.loads(line)
                written = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}) \
                    .get("Shuffle Bytes Written", 0)
                finish = ev.get("Task Info", {}).get("Finish Time", 0) / 1000.0
                for name, (t0, t1) in windows.items():
                    if t0 <= finish <= t1:
                        totals[name] += written
    return {f"shuffle_write_mb_{k}": v / 1e6 for k, v in totals.items()}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # Event log in a fresh local scratch folder (this bench runs local[N] by definition).
    event_dir = tempfile.mkdtemp(prefix="millstar-bench-events-")
    spark = build_session(f"local[{cpus}]", app_name="millstar-bench",
                          shuffle_partitions=max(2, cpus * 2),
                          extra_conf={"spark.driver.memory": "16g",
                                      "spark.eventLog.enabled": "true",
                                      "spark.eventLog.dir": event_dir,
                                      "spark.eventLog.rolling.enabled": "false",
                                      "spark.eventLog.compress": "false"})
    run_pipeline(spark, "/root/testdata/sf0.001", "warmup", PARALLEL)
    windows = {}

    # Headline: the production configuration (independent writes submitted in parallel).
    t_main = time.time()
    main_run, layout = run_pipeline(spark, sf_dir, "main", PARALLEL)
    windows["main"] = (t_main, time.time())
    queries = {"pipeline_total": main_run["pipeline_total"]}
    queries.update({f"{k}_parallel": v for k, v in main_run.items()
                    if k.startswith(("layer_", "land_", "export_"))})
    # Attribution: the same pipeline with one write at a time, exact per-table seconds.
    seq_run, layout = run_pipeline(spark, sf_dir, "sequential", 1)
    queries.update({k if k != "pipeline_total" else "pipeline_total_sequential": v
                    for k, v in seq_run.items()})
    queries["transform_export_total"] = (seq_run["pipeline_total"] - seq_run["land_bronze"])
    queries["transform_export_total_parallel"] = (main_run["pipeline_total"]
                                                  - main_run["land_bronze"])
    queries.update(at_scale_shape(spark, layout))
    t_ref = time.time()
    queries.update(reference_shape_pipeline(spark, layout))
    windows["refshape"] = (t_ref, time.time())
    for n in os.environ.get("BENCH_DENSE_KEYS", "100000,1000000,10000000").split(","):
        queries.update(dense_key_compare(spark, int(n)))
    replicate = int(os.environ.get("BENCH_REPLICATE", "1"))
    if replicate > 1:
        big, _ = run_pipeline(spark, sf_dir, f"x{replicate}", PARALLEL, replicate)
        queries.update({f"x{replicate}_{k}": v for k, v in big.items()
                        if k in ("pipeline_total", "land_bronze") or k.startswith(("layer_", "export"))})

    spark.stop()
    queries.update(shuffle_mb(event_dir, windows))
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(queries["pipeline_total"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
