"""Invariants of the model graph on test data, and agreement of the two plan forms."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF, rows
from tillroll.plans import ReceiptModels
from tillroll.schemas import RECEIPT
from tillroll.sources import receipts_from_tables

JOIN_BASED = ["business_sales", "sale_profits", "business_sales_profits",
              "business_monthly_profits", "business_employees", "business_employee_stats",
              "employee_attendences", "employees_left", "turnover_by_period", "products",
              "sales_details"]


@pytest.fixture(scope="module")
def stg(spark):
    return receipts_from_tables(spark, SMALL_SF).cache()


@pytest.fixture(scope="module")
def models(stg):
    return ReceiptModels(stg)


@pytest.mark.parametrize("name", JOIN_BASED)
def test_receipt_local_equals_joins(stg, name):
    local = ReceiptModels(stg, unique_reference=True).table(name)
    joined = ReceiptModels(stg, unique_reference=False).table(name)
    assert local.schema == joined.schema
    assert rows(local) == rows(joined)


@pytest.mark.parametrize("variant", [{}, {"fine_terms": True}, {"mixed_dates": True}])
def test_forms_agree_on_variants(spark, variant):
    stg = receipts_from_tables(spark, SMALL_SF, **variant)
    for name in ["sale_profits", "products", "business_monthly_profits"]:
        local = ReceiptModels(stg, unique_reference=True).table(name)
        joined = ReceiptModels(stg, unique_reference=False).table(name)
        assert rows(local) == rows(joined)


def test_monthly_profit_adds_up(models):
    cents = "decimal(18,2)"
    monthly = models.business_monthly_profits.agg(
        F.sum(F.col("total_monthly_profit").cast(cents))).first()[0]
    per_receipt = models.business_sales_profits.agg(
        F.sum(F.col("total_profit").cast(cents))).first()[0]
    assert monthly == per_receipt


def test_rankings_have_no_gaps(models):
    for name in ["top_ten_customers_by_business_value", "top_ten_customers_by_num_purchases"]:
        top = models.table(name)
        sizes = {r.business_name: r.n for r in
                 models.business_customers_summary.groupBy("business_name")
                 .agg(F.count("*").alias("n")).collect()}
        for r in top.groupBy("business_name").agg(F.collect_list("ranking").alias("rk")).collect():
            assert sorted(r.rk) == list(range(1, min(10, sizes[r.business_name]) + 1))


def test_top_ten_is_ordered_by_its_keys(models):
    top = models.top_ten_customers_by_business_value.collect()
    by_biz = {}
    for r in top:
        by_biz.setdefault(r.business_name, []).append(r)
    for rs in by_biz.values():
        rs.sort(key=lambda r: r.ranking)
        keys = [(-r.amount_spent, -r.num_purchases, r.customer_name) for r in rs]
        assert keys == sorted(keys)


def test_headcount_equals_names_in_list(models):
    joined = models.business_employee_stats.join(
        models.employee_attendences, ["business_name", "year", "month", "month_name"])
    bad = joined.filter(F.size(F.split("unique_employees", ", ")) != F.col("num_employees"))
    assert bad.count() == 0


def test_leavers_bounded_by_staff(models):
    left = models.employees_left.groupBy("business_name").agg(F.sum("num_employee_left").alias("l"))
    staff = models.business_employees.groupBy("business_name").agg(
        F.countDistinct("cashier_name").alias("s"))
    assert left.join(staff, "business_name").filter("l > s").count() == 0


def test_explode_then_collect_is_identity(stg, models):
    again = (models.receipt_products.groupBy("receipt_ref")
             .agg(F.count("*").alias("n")))
    sizes = stg.filter(F.size("Products") > 0).select(
        F.col("Reference").alias("receipt_ref"), F.size("Products").alias("n"))
    assert rows(again) == rows(sizes)


def test_user_supplied_leavers(stg, spark):
    leavers = spark.createDataFrame([], "business_name string, fiscal_year bigint, "
                                        "num_employee_left bigint")
    m = ReceiptModels(stg, leavers=leavers)
    assert m.turnover_by_period.filter("num_employee_left <> 0").count() == 0


def test_one_pass_contract_report_equals_per_table_report(stg, spark):
    from tillroll.operators import normalise, quality

    # inject NULLs at every level: row fields, list elements, element fields, Reference
    damaged = stg.withColumn(
        "Reference", F.when(F.col("Sequence") % 11 == 0, None).otherwise(F.col("Reference"))
    ).withColumn(
        "Cashier", F.when(F.col("Sequence") % 13 == 0, None).otherwise(F.col("Cashier"))
    ).withColumn(
        "Products", F.when(F.col("Sequence") % 7 == 0, F.array_union(
            F.col("Products"), F.array(F.lit(None).cast("struct<Cost:double,Name:string,"
                                                        "Price:double,Quantity:double>"))))
        .otherwise(F.col("Products"))
    ).withColumn(
        "Payments", F.when(F.col("Sequence") % 5 == 0, None).otherwise(F.col("Payments")))
    tables = {name: getattr(normalise, name)(damaged) for name in normalise.ROW_TABLES} | {
        name: getattr(normalise, name)(damaged) for name in normalise.LINE_TABLES}
    per_table = quality.contract_report(tables)
    one_pass = quality.contract_report_in_receipt(damaged)
    assert rows(one_pass) == rows(per_table)
    assert one_pass.filter("null_count > 0").count() >= 4


def test_operators_chain_with_transform(stg):
    from tillroll.operators import loyalty

    top = (stg.transform(loyalty.business_customers)
              .transform(loyalty.business_customers_summary)
              .transform(loyalty.top_customers_by_value))
    assert rows(top) == rows(ReceiptModels(stg).top_ten_customers_by_business_value)


def test_contract_violations_lists_only_broken_columns(stg):
    from tillroll.operators import normalise, quality

    damaged = stg.withColumn("Cashier", F.lit(None).cast("string"))
    found = quality.contract_violations({"receipts": normalise.receipts(damaged),
                                         "receipt_cashiers": normalise.receipt_cashiers(damaged)})
    assert [(r.table_name, r.column_name, r.null_count) for r in found.collect()] == [
        ("receipt_cashiers", "cashier_name", stg.count())]


def test_turnover_from_bitmaps_equals_headcounts_and_leavers(stg, spark):
    from tillroll.operators import workforce
    m = ReceiptModels(stg, unique_reference=True)
    assert rows(m.turnover_by_period) == rows(workforce.turnover_by_period(m.business_employee_stats, m.employees_left))
    odd = spark.createDataFrame(
        [("a", "x", 2020, 7), ("a", "x", 2020, 7), ("a", None, 2021, 6), ("a", "y", 2021, 6), ("b", None, 1999, 7), (None, "x", 2001, 6),
         ("a", "z", 1931, 6), ("a", "z", 2109, 6), ("c", "w", 2019, 12), (None, "q", 2000, 1)],
        "business_name string, cashier_name string, year bigint, month bigint")
    from tillroll.functions import month_name
    employees = odd.distinct().withColumn("month_name", month_name(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))))
    expected = workforce.turnover_by_period(workforce.business_employee_stats(employees), workforce.employees_left(employees))
    assert rows(workforce.turnover_from_service(odd)) == rows(expected) and expected.count() == 5
    with pytest.raises(Exception, match="outside the turnover bitmaps: 2200"):
        workforce.turnover_from_service(spark.createDataFrame([("a", "x", 2200, 7)], odd.schema)).collect()


def test_repeated_pivot_cells_and_leavers_fail_with_their_key(stg, spark):
    from tillroll.operators import workforce
    stats = spark.createDataFrame([("B", 2020, 7, "July", 3), ("B", 2021, 6, "June", 4)],
                                  "business_name string, year bigint, month bigint, month_name string, num_employees bigint")
    left = spark.createDataFrame([("B", 2020, 2)], "business_name string, fiscal_year bigint, num_employee_left bigint")
    (row,) = workforce.turnover_by_period(stats, left).collect()
    assert (row["July"], row["June"], row["num_employee_left"]) == (3.0, 4.0, 2)
    with pytest.raises(Exception, match="several headcounts of July: B, 2020"):
        workforce.turnover_by_period(stats.unionByName(stats.filter("month = 7")), left).collect()
    with pytest.raises(Exception, match="several leavers rows: B, 2020"):
        workforce.turnover_by_period(stats, left.unionByName(left)).collect()


def test_contract_metrics_of_a_write_equal_the_scans(spark, tmp_dir):
    import __spark_entry__ as entry
    from pyspark.sql import Observation

    from tillroll.operators import quality

    damaged = (entry._misfit_receipts(spark, SMALL_SF).withColumn("Cashier", F.when(F.col("Terminal") > 1, F.col("Cashier")))
               .withColumn("Products", F.when(F.col("Terminal") == 2, F.transform("Products", lambda p: p.withField("Price", F.lit(float("inf")))
                                                                                 .withField("Name", F.lit(None).cast("string")))).otherwise(F.col("Products"))))
    seen = Observation()
    quality.observe_contracts(damaged, seen).write.parquet(f"{tmp_dir}/rows")
    nulls, types = quality.reports_from_metrics(spark, seen.get)
    assert rows(nulls) == rows(quality.contract_report_in_receipt(damaged))
    assert rows(types) == rows(quality.type_report_in_receipt(damaged))
    found = {(r.table_name, r.column_name): r.misfit_count for r in types.collect()}
    inf = damaged.filter("Terminal = 2").agg(F.sum(F.size("Products"))).first()[0]
    assert found["receipt_products", "product_price"] == inf > 0 and found["receipts", "receipt_date"] > 0


def test_profits_in_a_receipt_equal_the_join_form_on_odd_lines(spark):
    """NULL and zero terms, negative steps, several promotions of a product, NULL prices, no lines."""
    products = [(1.5, "a", 4.0, 3.0), (1.5, "a", 4.0, None), (None, "b", 2.5, 0.5), (0.1, None, 3.3333, 2.0), (2.0, "c", None, 1.0), None]
    promotions = [(0.5, 2, "a"), (0.25, -1, "a"), (0.125, 3, "a"), (0.1, 0, "b"), (None, 1, "b"), (0.2, None, "b"), (0.3, 1, None), None]
    rows_ = [((str(k), f"B{k}"), "C", None, "2022/07/02", 0.1, [], products[:k], promotions[:9 - k], f"R{k}", k, 1, 2.0) for k in range(7)]
    stg = spark.createDataFrame(rows_ + [(*r[:8], None, *r[9:]) for r in rows_], RECEIPT)
    for name in ("sale_profits", "business_sales_profits", "business_monthly_profits"):
        local, joined = (ReceiptModels(stg, unique_reference=unique).table(name) for unique in (True, False))
        assert rows(local) == rows(joined)
        assert local.dtypes == joined.dtypes


def test_profit_reads_each_list_once_and_joins_once(spark, tmp_path):
    stg = receipts_from_tables(spark, SMALL_SF)
    stg.write.parquet(str(tmp_path / "stg"))
    stg = spark.read.schema(stg.schema).parquet(str(tmp_path / "stg"))
    plan = ReceiptModels(stg, unique_reference=False).sale_profits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert "Generate" not in ReceiptModels(stg, unique_reference=True).sale_profits._jdf.queryExecution().optimizedPlan().toString()


def test_lists_of_a_receipt_are_collected_once(spark):
    plan = receipts_from_tables(spark, SMALL_SF, fine_terms=True, mixed_dates=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1, plan
