"""Print the physical plans of the pipeline's key stages (``explain("formatted")``).

    python -m harness.plans [--sf DIR]

Builds bronze/silver/gold under the session's scratch folder first, so every
stage is planned exactly as the pipeline plans it (inputs re-read from Parquet).
"""

from __future__ import annotations

import argparse
import sys

from harness.adapter import BRONZE_TABLES, bronze
from millstar.operators import cleaning, facts
from millstar.operators.dense_key import dense_key
from millstar.plans.pipeline import Layout, transform
from millstar.session import build_session, scratch_path
from millstar.sources import snapshots

VERSION = "20260101T000000"


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args(argv)
    spark = build_session("local[8]")
    layout = Layout.under(scratch_path(spark, "plans"))
    for t in BRONZE_TABLES:
        snapshots.write_snapshot(bronze(spark, args.sf, t), f"{layout.bronze}/{t}", VERSION)
    res = transform(spark, layout, VERSION)

    def show(title, df):
        print(f"\n===== {title}")
        df.explain("formatted")
        sys.stdout.flush()

    raw = snapshots.read_latest(spark, f"{layout.bronze}/quality_checks")
    show("silver: clean quality_checks", cleaning.clean_table(raw, "quality_checks"))

    def inputs(name):
        tables, dim_names = facts.FACT_REQUIREMENTS[name]
        d = {k: res.dimensions[k] for k in dim_names}
        d.update({t: res.silver[t] for t in tables[1:]})
        return res.silver[tables[0]], d

    src, dims = inputs("fact_sensor_readings")
    show("gold: fact_sensor_readings (dimensions pass the broadcast check)",
         facts.build_fact_sensor_readings(src, dims))
    src, dims = inputs("fact_production")
    show("gold: fact_production, every lookup past the broadcast bound (shuffle path)",
         facts.build_fact_production(src, dims, broadcast_max_rows=0))
    names = res.silver["production_orders"].select("product_code").distinct()
    show("D14: dense key over distinct product codes", dense_key(names, ["product_code"], "sk"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
