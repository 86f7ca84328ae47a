from decimal import Decimal

import pytest
from pyspark.sql import Observation

from tests.conftest import rows
from tests.edge_receipts import write_documents
from tillroll.operators import quality
from tillroll.plans import MODEL_NAMES, SERVED_BY, ReceiptModels, run_daily, run_pipeline
from tillroll.sources import RunStore, receipts_from_tables


def test_daily_job_writes_every_model(spark, tmp_dir):
    tables = run_pipeline(spark, write_documents(tmp_dir), prefix="edge_", num_buckets=2)
    assert set(tables) == set(MODEL_NAMES) | {"stg_receipts"}
    for name in MODEL_NAMES:
        assert spark.catalog.tableExists("edge_" + name)
    assert spark.table("edge_staging_row_count").first().num_rows == 8
    monthly = {(r.year, r.month): r.total_monthly_profit
               for r in spark.table("edge_business_monthly_profits").collect()}
    assert monthly[(2022, 7)] == Decimal("37.00")
    # downstream models were built from the written upstream tables
    plan = tables["business_monthly_profits"]._jdf.queryExecution().analyzed().toString()
    assert "edge_business_monthly_profits" in plan
    detail = spark.sql("DESCRIBE TABLE EXTENDED edge_stg_receipts").collect()
    assert any(r.col_name == "Bucket Columns" and "Reference" in r.data_type for r in detail)


def test_bucketed_model_tables_write_one_file_per_bucket(spark, tmp_dir):
    import os

    from tillroll.plans import ReceiptModels, build_all
    from tillroll.sources import read_receipt_json

    stg = read_receipt_json(spark, write_documents(tmp_dir)).repartition(5)
    build_all(ReceiptModels(stg), "bk_", names=["receipt_products"], num_buckets=2,
              bucket_receipt_tables=True)
    location = spark.sql("DESCRIBE TABLE EXTENDED bk_receipt_products").filter(
        "col_name = 'Location'").first().data_type
    files = [f for f in os.listdir(location.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) <= 2


def test_command_line_ingest_and_run(spark, tmp_dir, capsys):
    import json
    import os

    from tillroll.__main__ import main

    src = write_documents(os.path.join(tmp_dir, "in"))
    main(["ingest", "--source", src, "--staging", os.path.join(tmp_dir, "stg")])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"ingested_rows": 8}
    root = os.path.join(tmp_dir, "root")
    for origin in (["--source", src], ["--staging", os.path.join(tmp_dir, "stg")]):
        main(["run", "--root", root, "--top-k", "1", *origin])
        out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert out["staged_rows"] == 8 and "turnover_summary" in out["tables"]
        store = RunStore(spark, root)
        assert store.current() == out["run"]
        assert store.table("top_ten_customers_by_business_value").agg({"ranking": "max"}).first()[0] == 1


def test_runs_are_atomic_and_repeatable(spark, tmp_dir):
    import os

    from tests.edge_receipts import EDGE_RECEIPTS

    root, src = os.path.join(tmp_dir, "root"), os.path.join(tmp_dir, "in")
    store = RunStore(spark, root)
    assert store.current() is None
    write_documents(src, EDGE_RECEIPTS[:3])
    first, _ = run_daily(spark, root, src)
    assert store.table("receipts").count() == 3
    # a run that fails midway, or is killed before its commit, changes nothing for readers
    os.makedirs(os.path.join(tmp_dir, "bad"))
    with open(os.path.join(tmp_dir, "bad", "x.json"), "w") as f:
        f.write('{"Date": "2022/07/02", "Reference": 7, "Total": "no number"}')
    with pytest.raises(Exception):
        run_daily(spark, root, os.path.join(tmp_dir, "bad"))
    half = store.new_run()
    store.write(spark.range(1), half, "receipts")
    assert store.current() == first and store.table("receipts").count() == 3
    write_documents(src, EDGE_RECEIPTS)
    second, _ = run_daily(spark, root, src)
    assert second > first and store.current() == second
    served = store.table("receipts", ["receipt_ref"], where="receipt_ref <> 'R1'", order_by=["receipt_ref"])
    assert served.columns == ["receipt_ref"] and "R1" not in [r.receipt_ref for r in served.collect()]


def test_second_run_in_another_process(tmp_dir):
    """Neither a shared catalog nor spark.checkpoint.dir ties the runs together."""
    import os
    import subprocess
    import sys

    from tests.edge_receipts import EDGE_RECEIPTS

    src, stg, root = (os.path.join(tmp_dir, x) for x in ("in", "stg", "root"))
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; from tillroll.session import build_session; from tillroll.streaming import ingest_new_receipts;"
            "from tillroll.plans import run_daily; s = build_session('local[2]', shuffle_partitions=2);"
            "print('N', ingest_new_receipts(s, sys.argv[1], sys.argv[2]), run_daily(s, sys.argv[3], staging=sys.argv[2])[1]['receipts'].count())")
    seen = []
    for upto in (3, 8):
        write_documents(src, EDGE_RECEIPTS[:upto])
        env = {**os.environ, "PYTHONPATH": here}
        out = subprocess.run([sys.executable, "-c", code, src, stg, root], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=300)
        seen.append([line for line in out.stdout.splitlines() if line.startswith("N ")])
    assert seen == [["N 3 3"], ["N 5 8"]]


def test_malformed_documents_are_set_aside(spark, tmp_dir):
    import os

    src = write_documents(os.path.join(tmp_dir, "in"))
    with open(os.path.join(src, "bad.json"), "w") as f:
        f.write('{"Total": "no number"}')
    seen = Observation()
    _, tables = run_daily(spark, os.path.join(tmp_dir, "root"), src, strict=False, contracts=seen)
    nulls, types = quality.reports_from_metrics(spark, seen.get)
    assert rows(nulls) == rows(tables["contract_report"]) and {r.misfit_count for r in types.collect()} == {0}
    assert tables["receipts"].count() == 8
    (bad,) = tables["rejected_documents"].collect()
    assert bad["_file_path"].endswith("/bad.json") and bad["_corrupt_record"] == '{"Total": "no number"}'
    outcome = {r["_file_path"].rsplit("/", 1)[1]: (r["num_good"], r["num_bad"]) for r in tables["load_outcome"].collect()}
    assert outcome.pop("bad.json") == (0, 1) and sum(g for g, _ in outcome.values()) == 8 and not any(b for _, b in outcome.values())
    assert "_file_path" not in tables["stg_receipts"].columns


def test_a_reader_of_one_business_reads_few_files(spark, tmp_dir):
    from pyspark.sql import functions as F
    from tests.conftest import SMALL_SF

    store = RunStore(spark, f"{tmp_dir}/root")
    name, keys = "business_monthly_profits", SERVED_BY["business_monthly_profits"]
    table = ReceiptModels(receipts_from_tables(spark, SMALL_SF), unique_reference=True).table(name)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run = store.new_run()
        written = store.write(table, run, name, cluster_by=keys)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    store.commit(run)
    files = written.groupBy("business_name").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert len(written.inputFiles()) >= 6 and files.agg(F.max("n")).first()[0] <= 2
    one = store.table(name, where="business_name = 'NATION_7'", order_by=["year", "month"])
    got = [tuple(r) for r in one.collect()]
    assert got == sorted(got, key=lambda r: (r[2], r[3])) and len(got) == table.filter("business_name = 'NATION_7'").count()


def test_customer_totals_are_aggregated_once(spark, tmp_dir):
    _, tables = run_daily(spark, f"{tmp_dir}/root", write_documents(f"{tmp_dir}/in"))
    models = ReceiptModels(tables["stg_receipts"], unique_reference=True)
    state = spark.read.parquet(f"{tmp_dir}/root/runs/{RunStore(spark, f'{tmp_dir}/root').current()}/state_customer_totals")
    models.use("customer_totals", state)
    for name in ("business_customers_summary", "top_ten_customers_by_business_value", "top_ten_customers_by_num_purchases"):
        plan = models.table(name)._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and all("state_customer_totals" in f for f in models.table(name).inputFiles())
        assert sorted(map(str, models.table(name).collect())) == sorted(map(str, tables[name].collect()))


def test_sizing_conf_for_a_large_input():
    from tillroll.session import sizing_conf

    conf = sizing_conf(100 << 40, total_cores=8000)
    partitions, splits = int(conf["spark.sql.shuffle.partitions"]), (100 << 40) // int(conf["spark.sql.files.maxPartitionBytes"])
    assert partitions == 8000
    assert partitions * splits < 2 * 10 ** 9  # blocks between map and reduce tasks
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    small = sizing_conf(10 << 20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_written_receipt_profits_are_not_computed_twice(spark, tmp_dir):
    from tests.conftest import SMALL_SF, rows
    from tillroll.plans import ReceiptModels
    from tillroll.sources import receipts_from_tables
    from pyspark.sql import functions as F

    stg = receipts_from_tables(spark, SMALL_SF).withColumn(
        "Reference", F.when(F.col("Sequence") % 97 != 0, F.col("Reference")))
    models = ReceiptModels(stg, unique_reference=True)
    want = rows(models.sale_profits)
    again = ReceiptModels(stg, unique_reference=True)
    path = f"{tmp_dir}/bsp"
    again.business_sales_profits.write.parquet(path)
    again.use("business_sales_profits", spark.read.parquet(path))
    assert rows(again.sale_profits) == want
