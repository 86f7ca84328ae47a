"""Fixed schemas: the receipt document, the flat CSV header and the type policy.

Schema inference is never used on receipts: files without promotions infer
``Promotions: array<string>`` and files without a customer drop the column.
"""

from pyspark.sql import types as T

# Tables carry money and quantities as DOUBLE, as delivered. Every computation casts them to
# these decimals, wide enough for prices of four decimals, fractional quantities and discounts
# of six decimals: a line is then decimal(25,7), a discounted line decimal(34,13) and their sum
# decimal(38,13), all exact. Results are rounded once, at the end, to TOTAL (half up) and
# returned as DOUBLE (tillroll.functions.money). Values out of range fail (ANSI mode is on).
MONEY = T.DecimalType(12, 4)
QUANTITY = T.DecimalType(12, 3)
DISCOUNT = T.DecimalType(7, 6)
EXACT = T.DecimalType(34, 13)
TOTAL = T.DecimalType(18, 2)

BUSINESS = T.StructType([
    T.StructField("ABN", T.StringType()),
    T.StructField("Name", T.StringType()),
])

CUSTOMER = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Points_Earnt", T.LongType()),
])

PAYMENT = T.StructType([
    T.StructField("Amount", T.DoubleType()),
    T.StructField("Method", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("Cost", T.DoubleType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Quantity", T.DoubleType()),
])

PROMOTION = T.StructType([
    T.StructField("Discount", T.DoubleType()),
    T.StructField("Per_Quantity", T.LongType()),
    T.StructField("Product", T.StringType()),
])

# One receipt document (the staging row).
RECEIPT = T.StructType([
    T.StructField("Business", BUSINESS),
    T.StructField("Cashier", T.StringType()),
    T.StructField("Customer", CUSTOMER),
    T.StructField("Date", T.StringType()),
    T.StructField("GST", T.DoubleType()),
    T.StructField("Payments", T.ArrayType(PAYMENT)),
    T.StructField("Products", T.ArrayType(PRODUCT)),
    T.StructField("Promotions", T.ArrayType(PROMOTION)),
    T.StructField("Reference", T.StringType()),
    T.StructField("Sequence", T.LongType()),
    T.StructField("Terminal", T.LongType()),
    T.StructField("Total", T.DoubleType()),
])

# Flat receipt header as delivered in CSV files (header line required). Line items cannot be
# carried by a flat row; such receipts have no payments, products or promotions.
RECEIPT_CSV = T.StructType([
    T.StructField("Reference", T.StringType()),
    T.StructField("Sequence", T.LongType()),
    T.StructField("Terminal", T.LongType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Total", T.DoubleType()),
    T.StructField("GST", T.DoubleType()),
    T.StructField("Cashier", T.StringType()),
    T.StructField("Business_ABN", T.StringType()),
    T.StructField("Business_Name", T.StringType()),
    T.StructField("Customer_Name", T.StringType()),
    T.StructField("Customer_Points", T.LongType()),
])

# Declared NOT NULL columns of the normalised tables (the table contracts).
NOT_NULL_CONTRACT = {
    "receipts": ["receipt_ref", "sequence_num", "receipt_date", "gst", "terminal_num",
                 "receipt_total"],
    "receipt_businesses": ["receipt_ref", "business_abn", "business_name"],
    "receipt_cashiers": ["receipt_ref", "cashier_name"],
    "receipt_customers": ["receipt_ref"],
    "receipt_payments": ["receipt_ref", "payment_method", "payment_amount"],
    "receipt_products": ["receipt_ref", "product_name", "product_cost", "product_price",
                         "product_quantity"],
    "receipt_promotions": ["receipt_ref", "product_name", "discount", "per_quantity"],
}

# Declared types of the normalised tables' columns that aren't text.
DECLARED_TYPES = {
    "receipts": {"sequence_num": "INTEGER", "receipt_date": "DATE", "gst": "FLOAT", "terminal_num": "INTEGER",
                 "receipt_total": "FLOAT"},
    "receipt_customers": {"customer_points": "INTEGER"},
    "receipt_payments": {"payment_amount": "FLOAT"},
    "receipt_products": {"product_cost": "FLOAT", "product_price": "FLOAT", "product_quantity": "FLOAT"},
    "receipt_promotions": {"discount": "FLOAT", "per_quantity": "INTEGER"},
}
