"""Command line: the pipeline stages as Spark applications.

    python -m millstar land      --lake ROOT LANDED [LANDED ...] [--json-lines]
    python -m millstar transform --lake ROOT [--only-pending] [--incremental] [--dense-fact-keys] [--order-buckets N]
    python -m millstar export    --lake ROOT [--tables T ...] [--sep ,] [--no-header] [--all-versions | --run V]
    python -m millstar run       --lake ROOT LANDED [LANDED ...]        (land -> transform -> export)
    python -m millstar stream    --lake ROOT --landing DIR --checkpoint DIR

``ROOT`` holds ``bronze/ silver/ gold/ exports/``; any Hadoop-compatible URI works.
Run under ``spark-submit`` on a cluster (the session's master is used as given);
without one, a local session is started.  Prints a JSON summary.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from millstar.plans.pipeline import Layout, payload_types_of, run_pipeline, transform
from millstar.schemas import BRONZE_SCHEMAS
from millstar.session import build_session, scratch_path
from millstar.sinks.csv import CsvSink
from millstar.sinks.export import export_tables
from millstar.sources.payload import land_payload, splittable


def _session() -> SparkSession:
    # Master and shuffle partitions come from spark-submit / the cluster defaults.
    return build_session(master=None, shuffle_partitions=None)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="millstar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("land", "transform", "export", "run", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--lake", required=True, help="root holding bronze/silver/gold/exports")
        if name in ("land", "run"):
            p.add_argument("landed", nargs="+", help="landed payload files or folders")
            p.add_argument("--json-lines", action="store_true",
                           help="one payload document per line")
            p.add_argument("--types", choices=("open", "declared", "inferred"), default="open",
                           help="open: every table and column, declared types where declared; "
                                "declared: declared columns only; inferred: all types from the data")
        if name in ("export", "run"):
            p.add_argument("--sep", default=",")
            p.add_argument("--no-header", action="store_true")
        if name == "export":
            p.add_argument("--tables", nargs="*")
            p.add_argument("--all-versions", action="store_true")
            p.add_argument("--run", help="export the tables as this finished run wrote them")
        if name == "transform":
            p.add_argument("--only-pending", action="store_true",
                           help="do not clean tables again whose landed versions are all in silver")
            p.add_argument("--incremental", action="store_true",
                           help="compare and clean new rows only, by an index of the rows in silver")
            p.add_argument("--dense-fact-keys", action="store_true",
                           help="fact keys 1..N in row order, the same after every retry and rerun")
            p.add_argument("--order-buckets", type=int, help="write the order tables in so many buckets of order_id")
        if name == "stream":
            p.add_argument("--landing", required=True)
            p.add_argument("--checkpoint", required=True)
    args = ap.parse_args(argv)

    spark = _session()
    layout = Layout.under(args.lake)
    out: dict = {"command": args.cmd}
    if args.cmd == "land":
        landed, multi_line = splittable(spark, args.landed, not args.json_lines, scratch_path(spark, "pages"))
        schema = payload_types_of(spark, landed, args.types, multi_line)
        out["landed"] = land_payload(spark, landed, layout.bronze, schema=schema, multi_line=multi_line)
    elif args.cmd == "transform":
        res = transform(spark, layout, only_pending=args.only_pending, dense_fact_keys=args.dense_fact_keys,
                        incremental=args.incremental, order_buckets=args.order_buckets)
        out.update(version=res.version, written=res.written, skipped_facts=res.skipped_facts)
    elif args.cmd == "export":
        sink = CsvSink(layout.exports, args.sep, not args.no_header)
        out["exported"] = export_tables(spark, layout.gold, sink, args.tables,
                                        "all" if args.all_versions else "latest",
                                        parallel_writes=4, run=args.run)
    elif args.cmd == "run":
        res = run_pipeline(spark, args.landed, layout,
                           sink=CsvSink(layout.exports, args.sep, not args.no_header),
                           multi_line=not args.json_lines, payload_types=args.types)
        out.update(version=res["version"], landed=res["landed"], exported=res["exported"],
                   skipped_facts=res["transform"].skipped_facts)
    elif args.cmd == "stream":
        from millstar.streaming.landing import start_landing
        start_landing(spark, args.landing, layout.bronze, args.checkpoint,
                      declared=BRONZE_SCHEMAS).awaitTermination()
        out["bronze"] = layout.bronze
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
