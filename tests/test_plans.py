"""Physical plan checks: the plans we want at scale, not just the right rows."""

import re

import pytest

from tests.conftest import SMALL_SF
from tillroll.plans import MODEL_NAMES, ReceiptModels
from tillroll.sources import receipts_from_tables, stage_receipts


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark):
    """The staging rows as a table bucketed by Reference, which users may ask for."""
    return stage_receipts(receipts_from_tables(spark, SMALL_SF), table="stg_plans", num_buckets=8)


@pytest.fixture(scope="module")
def unbucketed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stg") / "stg")
    receipts_from_tables(spark, SMALL_SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def models(staged):
    return ReceiptModels(staged, unique_reference=True)


def test_no_python_in_any_plan(models):
    for name in MODEL_NAMES:
        plan = optimized(models.table(name))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert marker not in plan, (name, marker)


@pytest.mark.parametrize("name", ["sale_profits", "business_sales_profits", "business_sales",
                                  "products", "sales_details"])
def test_receipt_level_models_do_not_shuffle(models, name):
    assert "Exchange" not in executed(models.table(name))


@pytest.mark.parametrize("name", ["sale_profits", "products", "business_employees"])
def test_receipt_local_needs_at_most_one_shuffle_without_buckets(unbucketed, name):
    plan = executed(ReceiptModels(unbucketed, unique_reference=True).table(name))
    assert plan.count("Exchange hashpartitioning") <= 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_load_adds_no_shuffle_and_mapping_scans_lines_once(spark, tmp_dir):
    from tests.edge_receipts import write_documents
    from tillroll.sources import RunStore, read_receipts

    store = RunStore(spark, f"{tmp_dir}/root")
    raw = read_receipts(spark, write_documents(f"{tmp_dir}/in"))
    assert "Exchange" not in executed(raw) and store.write(raw, store.new_run(), "stg").count() == 8
    plan = executed(receipts_from_tables(spark, SMALL_SF)).split("Initial Plan")[0]
    assert plan.count("lineitem.parquet") == 1


def test_building_a_model_runs_no_job(spark):
    import __spark_entry__ as entry

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    read = len(tracker.getJobIdsForGroup("build"))
    models = entry._models(spark, SMALL_SF)
    schemas = len(tracker.getJobIdsForGroup("build")) - read  # reading Parquet schemas
    models.sale_profits, models.products, models.business_monthly_profits
    assert len(tracker.getJobIdsForGroup("build")) - read == schemas


def test_join_forms_still_available(unbucketed):
    plan = executed(ReceiptModels(unbucketed, unique_reference=False).sale_profits)
    assert "Join" in plan


def test_monthly_profit_shuffles_once_after_partial_aggregation(models):
    plan = executed(models.business_monthly_profits)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan


def test_top_k_is_cut_before_the_shuffle(models):
    plan = executed(models.top_ten_customers_by_business_value)
    assert "WindowGroupLimit" in plan
    # a partial limit below the exchange and a final one above it
    assert plan.count("WindowGroupLimit") >= 2


def test_scan_reads_only_needed_fields(models):
    plan = optimized(models.sale_profits)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema" in scan
    for unused in ("Cashier", "Payments", "Customer", "GST"):
        assert unused not in scan.split("ReadSchema")[1], unused


def test_filter_reaches_the_scan(staged):
    from tillroll.operators import loyalty

    plan = optimized(loyalty.business_customers(staged))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for f in ("IsNotNull(Customer)", "IsNotNull(Business)", "GreaterThan(Total,0.0)"):
        assert f in pushed


def test_reference_check_needs_no_shuffle_on_the_staging_table(staged, unbucketed):
    from tillroll.sources.staging import reference_conflicts

    assert "Exchange" not in executed(reference_conflicts(staged))
    assert "Exchange hashpartitioning(Reference" in executed(reference_conflicts(unbucketed))


@pytest.mark.parametrize("name", ["business_sales", "sale_profits", "business_employees", "products", "sales_details"])
def test_joins_read_only_repeated_receipts(spark, tmp_path, name):
    """One repeated Reference doesn't turn the other receipts to joins."""
    from pyspark.sql import functions as F

    receipts_from_tables(spark, SMALL_SF, repeated=True).write.parquet(str(tmp_path / "stg"))
    models = ReceiptModels(spark.read.parquet(str(tmp_path / "stg")))
    assert not models.receipt_local
    alone, shared = models.parts
    repeated = {r["Reference"] for r in models.staging.groupBy("Reference").agg(F.count("*").alias("n")).filter("n > 1 and Reference is not null").collect()}
    assert repeated and {r["Reference"] for r in shared.staging.select("Reference").collect()} == repeated
    assert alone.staging.count() + shared.staging.count() == models.staging.count()
    assert alone.staging.filter("Reference is null").count() == models.staging.filter("Reference is null").count() > 0
    # The part with References of its own has no join but the filter by the repeated ones.
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join \S+ \S+ Inner", executed(alone.table(name)))) == 0
    assert sorted(map(str, models.table(name).collect())) == sorted(map(str, ReceiptModels(models.staging, unique_reference=False).table(name).collect()))


def test_many_repeated_references_are_joined_not_broadcast(spark, tmp_path, monkeypatch):
    from tillroll.sources import staging

    monkeypatch.setattr(staging, "MAX_BROADCAST_KEYS", 3)
    receipts_from_tables(spark, SMALL_SF, repeated=True).write.parquet(str(tmp_path / "stg"))
    models = ReceiptModels(spark.read.parquet(str(tmp_path / "stg")))
    assert "rightHint=(strategy=broadcast)" not in models.products._jdf.queryExecution().optimizedPlan().toString()
    assert models.products.count() == ReceiptModels(models.staging, unique_reference=False).products.count()


def test_turnover_scans_once_with_two_exchanges(unbucketed):
    df = ReceiptModels(unbucketed, unique_reference=True).turnover_by_period
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "ReusedExchange" in plan
    final, skip = "", None
    for line in plan.splitlines():  # without the initial plans, which stand deeper than their heading
        depth = len(line) - len(line.lstrip(" :|"))
        skip = None if skip is not None and depth <= skip else skip
        if "== Initial Plan" in line and skip is None:
            skip = depth
        final += "" if skip is not None else line + "\n"
    # The scalar's subquery comes from the same state: its exchange is reused.
    assert len(re.findall(r"Scan parquet", final)) == 1
    assert len(re.findall(r"\+- Exchange hashpartitioning", final)) == 2
