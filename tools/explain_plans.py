"""Write PLANS.md: the shape of every model's executed plan under three staging forms.

For each model: hash exchanges, joins and top-k limits of the final adaptive plan, with the
staging rows as (a) a table bucketed by Reference with receipt-local forms, (b) plain Parquet
with receipt-local forms, (c) plain Parquet with the join forms.
Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.plans import MODEL_NAMES, ReceiptModels  # noqa: E402
from tillroll.session import build_session  # noqa: E402
from tillroll.sources import receipts_from_tables, stage_receipts  # noqa: E402


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def shape(plan: str) -> str:
    ex = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan))
    single = plan.count("Exchange SinglePartition")
    joins = len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan))
    wgl = "yes" if "WindowGroupLimit" in plan else ""
    return f"{ex} | {single} | {joins} | {wgl}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="tillroll-plans-")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.sql.warehouse.dir": scratch + "/wh",
                                 "spark.sql.maxMetadataStringLength": "400"})
    spark.sparkContext.setLogLevel("ERROR")
    stg = receipts_from_tables(spark, sf_dir)
    bucketed = stage_receipts(stg, table="plans_stg", num_buckets=8)
    stg.write.parquet(scratch + "/plain")
    plain = spark.read.parquet(scratch + "/plain")
    forms = {"bucketed, receipt-local": ReceiptModels(bucketed, unique_reference=True),
             "Parquet, receipt-local": ReceiptModels(plain, unique_reference=True),
             "Parquet, joins": ReceiptModels(plain, unique_reference=False)}
    print("# PLANS\n")
    print(f"Generated by `python tools/explain_plans.py {sf_dir}` (final adaptive plans, "
          "local[8], 8 shuffle partitions).\n")
    print("Columns per form: hash/range exchanges | single-partition exchanges (global "
          "aggregates, scalar subqueries) | joins | top-k cut before the shuffle.\n")
    header = " | ".join(f"{f}: exch | single | joins | topk" for f in forms)
    print(f"| model | {header} |")
    print("| --- |" + " --- | --- | --- | --- |" * len(forms))
    for name in MODEL_NAMES:
        cells = " | ".join(shape(final_plan(m.table(name))) for m in forms.values())
        print(f"| {name} | {cells} |")
    spark.stop()


if __name__ == "__main__":
    main()
