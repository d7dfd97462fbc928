"""Tasks that fail their first attempt (a stand-in for a lost executor) are retried
and the results are unchanged: no lost rows, no duplicates, same surrogate keys.

Runs in a subprocess because retries need a ``local[n, maxFailures]`` master,
and one process holds one SparkContext.
"""

import json
import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import json, sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from millstar.session import build_session
    from millstar.operators.dense_key import dense_key, dense_key_window
    from millstar.operators import facts, dimensions as D
    from millstar.sources import snapshots
    from harness.adapter import bronze
    from millstar.operators.cleaning import clean_table

    spark = build_session("local[4,4]", shuffle_partitions=4,
                          extra_conf={{"spark.checkpoint.dir": {ckpt!r}}})

    import os, uuid
    @F.udf("long")  # test-only fault injector: every partition's first attempt dies
    def flaky(x):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0:
            open(os.path.join({marks!r}, uuid.uuid4().hex), "w").close()
            raise RuntimeError("injected task loss")
        return x

    out = {{}}
    keys = (spark.range(20000, numPartitions=4)
                 .select(flaky((F.col("id") * 7919) % 20011).cast("string").alias("k")).distinct())
    got = {{r["k"]: r["sk"] for r in dense_key(keys, ["k"], "sk").collect()}}
    want = {{r["k"]: r["sk"] for r in dense_key_window(keys, ["k"], "sk").collect()}}
    out["dense_key_equal"] = got == want and len(got) == 20000

    sf = "/root/testdata/sf0.001"
    dims = {{"dim_date": D.build_dim_date(spark), "dim_time": D.build_dim_time(spark),
             "dim_sensor": D.keyed_copy(clean_table(bronze(spark, sf, "sensors"), "sensors"),
                                                    D.KEYED_COPIES["dim_sensor"]),
             "dim_machine": D.keyed_copy(clean_table(bronze(spark, sf, "machines"), "machines"),
                                                     D.KEYED_COPIES["dim_machine"]),
             "dim_production_line": D.keyed_copy(
                 clean_table(bronze(spark, sf, "production_lines"), "production_lines"),
                 D.KEYED_COPIES["dim_production_line"]),
             "dim_alert_type": D.build_dim_alert_type(clean_table(bronze(spark, sf, "alerts"), "alerts"))}}
    alerts = clean_table(bronze(spark, sf, "alerts"), "alerts").withColumn(
        "sensor_id", flaky(F.col("sensor_id")))
    fact = facts.build_fact_alerts(alerts, dims)
    path = snapshots.write_snapshot(fact, {gold!r} + "/fact_alerts", "20260101T000000")
    back = spark.read.parquet(path)
    n_src = clean_table(bronze(spark, sf, "alerts"), "alerts").count()
    out["fact_rows"] = back.count()
    out["fact_distinct_sk"] = back.select("alert_sk").distinct().count()
    out["source_rows"] = n_src

    # Keys numbered by row order: the same rows and keys with and without lost tasks.
    kept = facts.build_fact_alerts(clean_table(bronze(spark, sf, "alerts"), "alerts"), dims)
    one = facts.with_dense_key(fact, "alert_sk")
    two = facts.with_dense_key(kept, "alert_sk", partitions=7)
    out["dense_fact_equal"] = (one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
                               and one.count() == n_src
                               and one.agg(F.countDistinct("alert_sk")).first()[0] == n_src)

    # The salted shuffle-join path (every lookup past the bound) under the same failures.
    cols = ["date_sk", "time_sk", "sensor_sk", "machine_sk", "line_sk", "alert_type_sk",
            "resolution_time_min", "acknowledged_flag", "severity_level"]
    shuffled = facts.build_fact_alerts(alerts, dims, broadcast_max_rows=0).select(cols)
    plain = facts.build_fact_alerts(clean_table(bronze(spark, sf, "alerts"), "alerts"),
                                    dims).select(cols)
    out["shuffle_path_equal"] = (shuffled.exceptAll(plain).count() == 0
                                 and plain.exceptAll(shuffled).count() == 0
                                 and shuffled.count() == plain.count())
    print("RESULT " + json.dumps(out))
""")


def test_results_survive_task_retries():
    scratch = tempfile.mkdtemp(prefix="millstar-fault-")
    marks = f"{scratch}/injected"
    os.makedirs(marks)
    script = SCRIPT.format(root=ROOT, ckpt=f"{scratch}/ckpt", gold=f"{scratch}/gold", marks=marks)
    proc = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True,
                          timeout=600, cwd=ROOT)
    lines = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT ")]
    assert lines, proc.stderr[-3000:]
    res = json.loads(lines[-1][len("RESULT "):])
    assert len(os.listdir(marks)) >= 2  # failures really were injected and retried
    assert res["dense_key_equal"]
    assert res["dense_fact_equal"]
    assert res["fact_rows"] == res["fact_distinct_sk"] == res["source_rows"] > 0
    assert res["shuffle_path_equal"]
