"""Normalised tables: projections and explodes of the staging rows (N1-N7).

Values keep their delivered types (money DOUBLE, quantities BIGINT, the date as text), as in
the original tables; computations cast them (tillroll.functions.money).

All are narrow transformations: no shuffle, and the partitioning of the staging rows (for
example the buckets of the staging table) is kept. Each table's columns are defined once, as
expressions over a staging row (``ROW_TABLES``) or over one element of a list
(``LINE_TABLES``), so that other one-pass computations (the NOT NULL report) can use them
without building the tables.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ref() -> Column:
    return F.col("Reference")


def receipt_columns() -> dict[str, Column]:
    """``receipt_date`` stays the delivered ``yyyy/MM/dd`` text, as in the original table;
    models parse it where they need calendar parts."""
    return {"receipt_ref": _ref(), "sequence_num": F.col("Sequence"),
            "receipt_date": F.col("Date"), "gst": F.col("GST"),
            "terminal_num": F.col("Terminal"), "receipt_total": F.col("Total")}


def business_columns() -> dict[str, Column]:
    return {"receipt_ref": _ref(), "business_abn": F.col("Business.ABN"),
            "business_name": F.col("Business.Name")}


def cashier_columns() -> dict[str, Column]:
    return {"receipt_ref": _ref(), "cashier_name": F.col("Cashier")}


def customer_columns() -> dict[str, Column]:
    """Receipts without a customer stay, with NULL name and points."""
    return {"receipt_ref": _ref(), "customer_name": F.col("Customer.Name"),
            "customer_points": F.col("Customer.Points_Earnt")}


def payment_columns(p: Column) -> dict[str, Column]:
    return {"payment_method": p["Method"], "payment_amount": p["Amount"]}


def product_columns(p: Column) -> dict[str, Column]:
    return {"product_name": p["Name"], "product_cost": p["Cost"], "product_price": p["Price"],
            "product_quantity": p["Quantity"]}


def promotion_columns(p: Column) -> dict[str, Column]:
    return {"product_name": p["Product"], "discount": p["Discount"],
            "per_quantity": p["Per_Quantity"]}


ROW_TABLES: dict[str, Callable[[], dict[str, Column]]] = {
    "receipts": receipt_columns, "receipt_businesses": business_columns,
    "receipt_cashiers": cashier_columns, "receipt_customers": customer_columns,
}
# table -> (list field of the staging row, columns of one element); receipt_ref is added.
LINE_TABLES: dict[str, tuple[str, Callable[[Column], dict[str, Column]]]] = {
    "receipt_payments": ("Payments", payment_columns),
    "receipt_products": ("Products", product_columns),
    "receipt_promotions": ("Promotions", promotion_columns),
}


def _rows(stg: DataFrame, table: str) -> DataFrame:
    return stg.select(*[c.alias(n) for n, c in ROW_TABLES[table]().items()])


def _lines(stg: DataFrame, table: str) -> DataFrame:
    """One row per list element; NULL or empty lists produce no row."""
    field, columns = LINE_TABLES[table]
    exploded = stg.select(_ref().alias("receipt_ref"), F.explode(field).alias("p"))
    return exploded.select("receipt_ref", *[c.alias(n) for n, c in columns(F.col("p")).items()])


def receipts(stg: DataFrame) -> DataFrame:
    return _rows(stg, "receipts")


def receipt_businesses(stg: DataFrame) -> DataFrame:
    return _rows(stg, "receipt_businesses")


def receipt_cashiers(stg: DataFrame) -> DataFrame:
    return _rows(stg, "receipt_cashiers")


def receipt_customers(stg: DataFrame) -> DataFrame:
    return _rows(stg, "receipt_customers")


def receipt_payments(stg: DataFrame) -> DataFrame:
    return _lines(stg, "receipt_payments")


def receipt_products(stg: DataFrame) -> DataFrame:
    """One row per product line; a product may repeat within a receipt."""
    return _lines(stg, "receipt_products")


def receipt_promotions(stg: DataFrame) -> DataFrame:
    return _lines(stg, "receipt_promotions")
