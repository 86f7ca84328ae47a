"""Product-line detail tables (M13, M14)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import (calendar_month, calendar_year, month_year_label,
                                parse_receipt_date)
from tillroll.operators.profit import matched_lines_in_receipt


def products(products: DataFrame, promotions: DataFrame) -> DataFrame:
    """Product lines with their promotion terms; no promotion gives 0 and 0.

    Bag semantics of the left join: a line with two promotions for its product gives two rows
    (the rows are the result).
    """
    promos = promotions.select("receipt_ref", "product_name", "discount", "per_quantity")
    return (products.join(promos, ["receipt_ref", "product_name"], "left")
                    .select("receipt_ref", "product_name", "product_cost", "product_price",
                            "product_quantity",
                            F.coalesce(F.col("discount"), F.lit(0.0)).alias("discount"),
                            F.coalesce(F.col("per_quantity"), F.lit(0)).cast("bigint")
                             .alias("per_quantity")))


def sales_details(receipts: DataFrame, businesses: DataFrame, products: DataFrame) -> DataFrame:
    """Receipt x product lines with business and month; ``receipt_ref`` appears once."""
    d = parse_receipt_date(F.col("receipt_date"))
    month, year = calendar_month(d), calendar_year(d)
    return (receipts.select("receipt_ref", "receipt_date")
                    .join(businesses.select("receipt_ref", "business_name"), "receipt_ref")
                    .join(products.select("receipt_ref", "product_name", "product_cost",
                                          "product_price", "product_quantity"), "receipt_ref")
                    .select("receipt_ref", "business_name", "receipt_date",
                            month.alias("month"), year.alias("year"),
                            month_year_label(month, year).alias("month_year"),
                            "product_name", "product_cost", "product_price", "product_quantity"))


def products_in_receipt(stg: DataFrame) -> DataFrame:
    """:func:`products` for staging rows with unique, non-NULL Reference: each line is matched
    with the promotions of its own receipt, no join."""
    return matched_lines_in_receipt(stg).select(
        "receipt_ref", "product_name", "product_cost", "product_price", "product_quantity",
        F.coalesce(F.col("discount"), F.lit(0.0)).alias("discount"),
        F.coalesce(F.col("per_quantity"), F.lit(0)).cast("bigint").alias("per_quantity"))


def sales_details_in_receipt(stg: DataFrame) -> DataFrame:
    """:func:`sales_details` for staging rows with unique, non-NULL Reference."""
    d = parse_receipt_date(F.col("Date"))
    month, year = calendar_month(d), calendar_year(d)
    return (stg.filter(F.col("Reference").isNotNull())
               .select(F.col("Reference").alias("receipt_ref"),
                       F.col("Business.Name").alias("business_name"),
                       F.col("Date").alias("receipt_date"),
                       month.alias("month"), year.alias("year"),
                       month_year_label(month, year).alias("month_year"),
                       F.explode("Products").alias("p"))
               .select("receipt_ref", "business_name", "receipt_date", "month", "year",
                       "month_year", F.col("p.Name").alias("product_name"),
                       F.col("p.Cost").alias("product_cost"),
                       F.col("p.Price").alias("product_price"),
                       F.col("p.Quantity").alias("product_quantity")))
