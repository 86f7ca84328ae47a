"""Receipts derived from the star-schema test tables (orders, lineitem, part, customer, nation).

Every order becomes one receipt document with the fixed receipt schema, so the whole model
chain, explodes included, runs on data that grows with the test scale factor. No row is
dropped; some fields are derived from the order key to give the receipt semantics something to
bite on (receipts without customer, with zero total, with two payments).

Fixed values of the mapping (the SQL oracle uses the same ones):

* Reference = order key as text; Sequence = order key; Terminal = order key mod 5, plus 1
* Date = order date as yyyy/MM/dd
* Total = 0 when order key mod 17 = 0, else the order total price in cents; GST = Total x 0.10
* Cashier = 'Clerk#' followed by order key mod 37
* Business = nation of the customer (ABN = nation key as text, Name = nation name)
* Customer = none when order key mod 10 = 0, else (customer name, floor of Total)
* Payments = (order priority, Total); when order key mod 7 = 0: ('Cash', 10.00) and
  (order priority, Total - 10.00)
* Products = one per line item: part name, Price = part retail price, Cost = Price x 0.6,
  Quantity = line quantity
* Promotions = one per line item with a discount: the discount, the line number as Per_Quantity
  and the part name (a part that an order holds twice repeats its promotions and fans lines out)

Variants, for queries that need what the plain mapping never holds:

* ``fine_terms``: Price x 1.0003 with four decimals, Quantity = line quantity / 4, Discount =
  discount / 8
* ``repeated``: every order whose key is a multiple of 50 is delivered twice, and Reference is
  missing where the key is a multiple of 97
* ``mixed_dates``: Date as yyyy/MM/dd, yyyy-MM-dd or yyyy/M/d by order key mod 3
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import CUSTOMER, PAYMENT, PRODUCT, PROMOTION, RECEIPT

# Fixed values (see module docstring).
TERMINALS = 5
ZERO_TOTAL_EVERY = 17
CASHIERS = 37
NO_CUSTOMER_EVERY = 10
SPLIT_PAYMENT_EVERY = 7
CASH_PART = Decimal("10.00")
GST_RATE = Decimal("0.10")
COST_RATE = Decimal("0.6")
FINE_PRICE = Decimal("1.0003")
FINE_QUANTITY = 4
FINE_DISCOUNT = 8
REPEATED_EVERY = 50
NO_REFERENCE_EVERY = 97
CENTS = T.DecimalType(10, 2)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_items(spark: SparkSession, sf_dir: str, fine_terms: bool) -> DataFrame:
    """Per order: the product list and the promotion list.

    An order's lines become one receipt document, so they are collected per order, once for both
    lists, which hold the same names: the arrays are the size of one receipt, as in the document
    model itself (partial aggregation merges the pieces of an order from several tasks)."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    price = F.col("p_retailprice").cast(CENTS)
    cost = (price * F.lit(COST_RATE)).cast(CENTS)
    quantity, discount = F.col("l_quantity").cast("bigint").cast("double"), F.col("l_discount")
    if fine_terms:
        price = (price * F.lit(FINE_PRICE)).cast("decimal(12,4)")
        quantity, discount = F.col("l_quantity") / FINE_QUANTITY, discount / FINE_DISCOUNT
    parts = _table(spark, sf_dir, "part").select(  # priced once a part, not once a line
        "p_partkey", "p_name", price.cast("double").alias("price"), cost.cast("double").alias("cost"))
    lp = lines.join(parts, lines.l_partkey == parts.p_partkey, "inner")
    line = F.struct(
        F.col("cost").alias("Cost"),
        F.col("p_name").alias("Name"),
        F.col("price").alias("Price"),
        quantity.alias("Quantity"),
        F.when(F.col("l_discount") > 0, discount).alias("Discount"),
        F.col("l_linenumber").cast("bigint").alias("Per_Quantity"),
    )
    return lp.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines")).select(
        "l_orderkey",
        F.transform("lines", lambda x: F.struct(*[x[f.name].alias(f.name) for f in PRODUCT])).alias("Products"),
        F.transform(F.filter("lines", lambda x: x["Discount"].isNotNull()), lambda x: F.struct(
            x["Discount"].alias("Discount"), x["Per_Quantity"].alias("Per_Quantity"), x["Name"].alias("Product"))).alias("Promotions"))


def receipts_from_tables(spark: SparkSession, sf_dir: str, fine_terms: bool = False,
                         repeated: bool = False, mixed_dates: bool = False) -> DataFrame:
    """The staging table (one nested row per order) built from the test tables."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    items = _line_items(spark, sf_dir, fine_terms)

    key = F.col("o_orderkey")
    total = (F.when(key % ZERO_TOTAL_EVERY == 0, F.lit(0).cast(CENTS))
              .otherwise(F.col("o_totalprice").cast(CENTS)))
    priority = F.col("o_orderpriority")
    single = F.array(F.struct(total.cast("double").alias("Amount"), priority.alias("Method")))
    split = F.array(
        F.struct(F.lit(CASH_PART).cast("double").alias("Amount"), F.lit("Cash").alias("Method")),
        F.struct((total - F.lit(CASH_PART)).cast("double").alias("Amount"),
                 priority.alias("Method")))
    customer = F.when(key % NO_CUSTOMER_EVERY != 0, F.struct(
        F.col("c_name").alias("Name"), F.floor(total).cast("bigint").alias("Points_Earnt")))

    joined = (orders
              .join(customers, orders.o_custkey == customers.c_custkey, "inner")
              .join(nations, F.col("c_nationkey") == nations.n_nationkey, "inner")
              .join(items, key == items.l_orderkey, "left"))
    date = F.date_format(F.col("o_orderdate"), "yyyy/MM/dd")
    if mixed_dates:
        date = (F.when(key % 3 == 0, date).when(key % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
                .otherwise(F.date_format("o_orderdate", "yyyy/M/d")))
    reference = key.cast("string")
    if repeated:
        reference = F.when(key % NO_REFERENCE_EVERY != 0, reference)
    empty = lambda t: F.array().cast(T.ArrayType(t))
    staged = joined.select(
        F.struct(F.col("n_nationkey").cast("string").alias("ABN"),
                 F.col("n_name").alias("Name")).alias("Business"),
        F.concat(F.lit("Clerk#"), (key % CASHIERS).cast("string")).alias("Cashier"),
        customer.cast(CUSTOMER).alias("Customer"),
        date.alias("Date"),
        (total * F.lit(GST_RATE)).cast(CENTS).cast("double").alias("GST"),
        F.when(key % SPLIT_PAYMENT_EVERY == 0, split).otherwise(single)
         .cast(T.ArrayType(PAYMENT)).alias("Payments"),
        F.coalesce(F.col("Products").cast(T.ArrayType(PRODUCT)), empty(PRODUCT)).alias("Products"),
        F.coalesce(F.col("Promotions").cast(T.ArrayType(PROMOTION)),
                   empty(PROMOTION)).alias("Promotions"),
        reference.alias("Reference"),
        key.alias("Sequence"),
        (key % TERMINALS + 1).alias("Terminal"),
        total.cast("double").alias("Total"),
    )
    staged = staged.select(*[F.col(f.name).cast(f.dataType) for f in RECEIPT])
    if repeated:
        staged = staged.unionByName(staged.filter(F.col("Sequence") % REPEATED_EVERY == 0))
    return staged
