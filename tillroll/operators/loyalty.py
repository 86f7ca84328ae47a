"""Q2: the most loyal customers of each business (M6-M9)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import sum_exact, to_amount

TOP_K = 10
# The unrounded sum, by which customers are ranked; no column of the finished tables.
EXACT_SPENT = "_exact_spent"


def business_customers(stg: DataFrame) -> DataFrame:
    """Receipts with a customer, a business and a positive total.

    The tests are on the structs: a customer struct with a NULL name passes.
    """
    keep = (F.col("Customer").isNotNull() & F.col("Business").isNotNull()
            & (F.col("Total") > 0))
    return stg.filter(keep).select(
        F.col("Reference").alias("receipt_ref"),
        F.col("Customer.Name").alias("customer_name"),
        F.col("Business.Name").alias("business_name"),
        F.col("Total").alias("amount_spent"))


def customer_totals(customers: DataFrame) -> DataFrame:
    """Spend, rounded and exact, and purchase count per (business, customer); a NULL name is one
    group."""
    return (customers.groupBy("business_name", "customer_name")
                     .agg(to_amount(sum_exact(F.col("amount_spent"))).alias("amount_spent"),
                          F.count("receipt_ref").alias("num_purchases"),
                          sum_exact(F.col("amount_spent")).alias(EXACT_SPENT)))


def merged_customer_totals(parts: DataFrame) -> DataFrame:
    """Customer totals of disjoint sets of receipts as those of all: exact sums add up, shown ones
    are rounded once more from them."""
    exact = F.sum(EXACT_SPENT).cast(parts.schema[EXACT_SPENT].dataType)
    return (parts.groupBy("business_name", "customer_name")
                 .agg(to_amount(exact).alias("amount_spent"), F.sum("num_purchases").alias("num_purchases"),
                      exact.alias(EXACT_SPENT)))


def business_customers_summary(customers: DataFrame) -> DataFrame:
    """Spend and purchase count per (business, customer)."""
    return customer_totals(customers).drop(EXACT_SPENT)


def _exact_spent(summary: DataFrame) -> DataFrame:
    """The summary with the sum that ranks: the exact one where it came along, else the shown."""
    return summary if EXACT_SPENT in summary.columns else summary.withColumn(EXACT_SPENT, F.col("amount_spent"))


def _top_k(summary: DataFrame, order: list[Column], columns: list[str], k: int) -> DataFrame:
    # The customer name closes the order so that ties rank the same way on every run. The
    # filter sits directly on the row number, which lets Spark cut each business to k rows in
    # every map task before the shuffle (WindowGroupLimit), so a business with a third of all
    # customers still sends only k rows per task to its window partition.
    w = Window.partitionBy("business_name").orderBy(*order, F.col("customer_name").asc_nulls_last())
    ranked = _exact_spent(summary).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return ranked.select(*columns, F.col("_rn").cast("bigint").alias("ranking"))


def top_customers_by_value(summary: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top_k(summary,
                  [F.col(EXACT_SPENT).desc_nulls_last(), F.col("num_purchases").desc()],
                  ["business_name", "customer_name", "amount_spent", "num_purchases"], k)


def top_customers_by_purchases(summary: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top_k(summary,
                  [F.col("num_purchases").desc(), F.col(EXACT_SPENT).desc_nulls_last()],
                  ["business_name", "customer_name", "num_purchases", "amount_spent"], k)
