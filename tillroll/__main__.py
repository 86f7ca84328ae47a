"""Command line: ``python -m tillroll run|load|ingest ...`` (also under spark-submit)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Observation

from tillroll.operators.loyalty import TOP_K
from tillroll.plans.build import run_daily
from tillroll.plans.incremental import load_receipts
from tillroll.session import build_session
from tillroll.sources.receipts import read_receipts
from tillroll.streaming import ingest_new_receipts


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillroll")
    parser.add_argument("--master", help="only for local runs; spark-submit sets it otherwise")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="read every receipt file, stage them, rebuild every model")
    run.add_argument("--root", required=True, help="shared folder of the daily runs")
    origin = run.add_mutually_exclusive_group(required=True)
    origin.add_argument("--source", help="folder of receipt files")
    origin.add_argument("--staging", help="Parquet path that ingest keeps up to date")
    run.add_argument("--layout", choices=["document", "lines"], default="document")
    run.add_argument("--tolerant", action="store_true", help="set malformed documents aside")
    run.add_argument("--leavers", help="CSV of business_name,fiscal_year,num_employee_left")
    run.add_argument("--top-k", type=int, default=TOP_K)
    load = sub.add_parser("load", help="add one load's receipts to models that are kept load by load")
    load.add_argument("--root", required=True, help="shared folder of the loads")
    load.add_argument("--source", required=True, help="folder of the load's receipt files")
    load.add_argument("--load", required=True, help="its name, such as the day; an earlier load of that name is replaced")
    load.add_argument("--layout", choices=["document", "lines"], default="document")
    ingest = sub.add_parser("ingest", help="append receipts of new files to a staging path")
    ingest.add_argument("--source", required=True)
    ingest.add_argument("--staging", required=True)
    ingest.add_argument("--checkpoint")
    ingest.add_argument("--layout", choices=["document", "lines"], default="document")
    args = parser.parse_args(argv)

    spark = build_session(args.master)
    if args.command == "run":
        load = Observation("receipt_load")
        leavers = args.leavers and spark.read.option("header", True).option("mode", "FAILFAST").schema(
            "business_name string, fiscal_year long, num_employee_left long").csv(args.leavers)
        name, tables = run_daily(spark, args.root, args.source, args.layout, args.staging, not args.tolerant,
                                 leavers=leavers or None, top_k=args.top_k, load=load)
        print(json.dumps({"run": name, "staged_rows": load.get["num_rows"], "tables": sorted(tables)}))
    elif args.command == "load":
        name, run = load_receipts(spark, args.root, args.load, read_receipts(spark, args.source, args.layout))
        print(json.dumps({"load": name, "run": run}))
    else:
        n = ingest_new_receipts(spark, args.source, args.staging, args.checkpoint, args.layout)
        print(json.dumps({"ingested_rows": n}))


if __name__ == "__main__":
    main()
