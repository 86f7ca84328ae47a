"""Q1: promotion-adjusted profit per receipt and per business month (M1-M5)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tillroll.functions import (as_discount, as_money, as_quantity, as_total, calendar_month,
                                calendar_year, month_name, month_year_label, parse_receipt_date,
                                sum_cents, to_amount)
from tillroll.schemas import EXACT, PROMOTION


def business_sales(receipts: DataFrame, businesses: DataFrame) -> DataFrame:
    """Receipt header with its business and calendar month."""
    d = parse_receipt_date(F.col("receipt_date"))
    return (receipts.join(businesses, "receipt_ref", "inner")
                    .select("business_abn", "business_name", "receipt_ref", "receipt_date",
                            "receipt_total", "gst",
                            calendar_year(d).alias("year"), calendar_month(d).alias("month"),
                            month_name(d).alias("month_name")))


_KEYS = ["receipt_ref", "product_name"]
_STEP = "decimal(23,3)"
# Sum of the discounts of one receipt's promotions for one product.
_DISCOUNTS = "decimal(11,6)"
_SUM = "decimal(38,13)"


def _profit_sums() -> list[Column]:
    return [to_amount(F.sum("total_cost")).alias("total_cost"),
            to_amount(F.sum("total_price")).alias("total_price"),
            to_amount(F.sum("price_after_discount")).alias("total_price_after_discount"),
            to_amount(F.sum("profit")).alias("total_profit")]


def _line_amounts(cost: Column, price: Column, m: Column, off: Column) -> dict[str, Column]:
    """Cost, price, discounted price and profit of a product line of total ``cost`` and ``price``
    over the rows of its left join with promotions: ``m`` promotions, whose qualifying ones sum to
    the discount ``off``. A line with m >= 1 promotions counts m times.

    A promotion applies to the whole line once the quantity reaches a positive multiple of its
    ``Per_Quantity`` (floor(q / n) * n > 0: n > 0 and q >= n, or n < 0 and q > 0); zero never does.
    """
    m, off = m.cast("decimal(10,0)"), off.cast(_DISCOUNTS)
    copies = F.greatest(m, F.lit(1).cast("decimal(10,0)"))
    after = F.when(m == 0, price.cast(EXACT)).otherwise(((price * m).cast(EXACT) - (price * off).cast(EXACT)).cast(EXACT))
    total_cost = (cost * copies).cast(EXACT)
    return {"total_cost": total_cost, "total_price": (price * copies).cast(EXACT), "price_after_discount": after,
            "profit": (after - total_cost).cast(EXACT)}


def sale_profits(products: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per receipt: cost, price, discounted price and profit, rounded to cents.

    Same sums as over the left join of product lines with promotions on (receipt, product
    name), with its bag semantics (a line with m promotions counts m times), but without
    forming the (line, promotion) pairs, whose number grows with the square of the copies of a
    repeated receipt. One ordered pass per (receipt, product) over thresholds and lines sums the discounts
    whose threshold a line's quantity reaches; the number of promotions and what has no threshold is
    joined. Lines without a receipt or product meet no promotion; those without a receipt aren't dealt.
    """
    qty, per = as_quantity(F.col("product_quantity")), F.col("per_quantity")
    discount = as_discount(F.col("discount"))
    lines = products.select(*_KEYS, qty.cast(_STEP).alias("at"), F.lit(1).alias("kind"),
                            (as_money(F.col("product_cost")) * qty).alias("cost"), (as_money(F.col("product_price")) * qty).alias("price"))
    terms = promotions.filter(F.col("receipt_ref").isNotNull() & F.col("product_name").isNotNull()).select(
        *_KEYS, F.when(per > 0, per).cast(_STEP).alias("at"), F.lit(0).alias("kind"),
        F.when(per > 0, discount).alias("d_positive"), F.when(per < 0, discount).alias("d_negative"))
    counted = terms.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("m"), F.sum("d_negative").alias("d_negative"))
    steps = terms.filter(F.col("d_positive").isNotNull()).drop("d_negative")
    upto = Window.partitionBy(*_KEYS).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (lines.filter(F.col("receipt_ref").isNotNull()).unionByName(steps, allowMissingColumns=True)
               .withColumn("d_positive", F.sum("d_positive").over(upto)).filter("kind = 1"))
    zero = F.lit(0)
    off = F.coalesce("d_positive", zero) + F.when(F.col("at") > 0, F.coalesce("d_negative", zero)).otherwise(zero)
    matched = reached.join(counted, _KEYS, "left").select("receipt_ref", "cost", "price", F.coalesce("m", zero).alias("m"), off.alias("off"))
    nameless = lines.filter(F.col("receipt_ref").isNull()).select("receipt_ref", "cost", "price", zero.alias("m"), zero.alias("off"))

    def sums(rows: DataFrame) -> DataFrame:
        amounts = _line_amounts(*[F.col(c) for c in ("cost", "price", "m", "off")])
        return rows.select("receipt_ref", *[c.alias(n) for n, c in amounts.items()]).groupBy("receipt_ref").agg(*_profit_sums())

    return sums(matched).unionByName(sums(nameless))


def business_sales_profits(sales: DataFrame, profits: DataFrame) -> DataFrame:
    """Receipts with their profit; receipts without product lines drop out."""
    return (sales.join(profits, "receipt_ref", "inner")
                 .select("business_abn", "business_name", "receipt_date", "year", "month",
                         "month_name", "receipt_ref", "receipt_total", "gst", "total_cost",
                         "total_price", "total_price_after_discount", "total_profit"))


def business_monthly_profits(sales_profits: DataFrame) -> DataFrame:
    return (sales_profits
            .groupBy("business_abn", "business_name", "year", "month", "month_name")
            .agg(sum_cents(F.col("total_profit")).alias("total_monthly_profit"),
                 F.count("receipt_ref").alias("num_of_sales")))


def business_monthly_profits_by_counts(receipts: DataFrame, businesses: DataFrame,
                                       profits: DataFrame) -> DataFrame:
    """:func:`business_monthly_profits` of ``business_sales_profits(business_sales(receipts,
    businesses), profits)``, without forming the (receipt row, business row) pairs of a
    repeated receipt: each receipt's distinct months and businesses carry their row counts, and
    a (business, month) combination counts their product times."""
    d = parse_receipt_date(F.col("receipt_date"))
    months = (receipts.groupBy("receipt_ref", calendar_year(d).alias("year"),
                               calendar_month(d).alias("month"), month_name(d).alias("month_name"))
              .agg(F.count(F.lit(1)).alias("n_months")))
    firms = (businesses.groupBy("receipt_ref", "business_abn", "business_name")
             .agg(F.count(F.lit(1)).alias("n_firms")))
    copies = (F.col("n_months") * F.col("n_firms")).cast("decimal(20,0)")
    return (firms.join(months, "receipt_ref").join(profits.select("receipt_ref", "total_profit"),
                                                   "receipt_ref")
            .groupBy("business_abn", "business_name", "year", "month", "month_name")
            .agg(to_amount(F.sum(as_total(F.col("total_profit")) * copies))
                 .alias("total_monthly_profit"),
                 F.coalesce(F.sum(F.col("n_months") * F.col("n_firms")), F.lit(0))
                  .cast("bigint").alias("num_of_sales")))


def merged_monthly_profits(parts: DataFrame) -> DataFrame:
    """Monthly profits of disjoint sets of receipts as those of all: sums of cents stay exact."""
    return (parts.groupBy("business_abn", "business_name", "year", "month", "month_name")
            .agg(sum_cents(F.col("total_monthly_profit")).alias("total_monthly_profit"),
                 F.sum("num_of_sales").alias("num_of_sales")))


def without_monthly_profits(monthly: DataFrame) -> DataFrame:
    """The rows that, merged with others, take these profits and sales away again."""
    return monthly.withColumn("total_monthly_profit", -F.col("total_monthly_profit")).withColumn("num_of_sales", -F.col("num_of_sales"))


def monthly_profit_series(monthly: DataFrame) -> DataFrame:
    """Profit series per business with a ``month_year`` label, in time order."""
    return (monthly.withColumn("month_year", month_year_label(F.col("month"), F.col("year")))
                   .orderBy(F.col("business_name").asc_nulls_last(), "year", "month"))


# -- Receipt-local forms -------------------------------------------------------------------
# When no two staging rows share a (non-NULL) Reference, all tables joined on receipt_ref are
# projections of the same row, and each join rebuilds that row. The forms below match product
# lines with the promotions of their own row instead of joining: no join, and the only
# exchange left is the per-receipt aggregation, which a staging table bucketed by Reference
# serves without a shuffle. They equal the join forms only under that key condition;
# ReceiptModels checks it before choosing them.


def promotions_for(product: Column, promotions: Column) -> Column:
    """Promotions of the same receipt for this product (equi-match on the product name)."""
    return F.filter(F.coalesce(promotions, F.array().cast(ArrayType(PROMOTION))),
                    lambda d: d["Product"] == product["Name"])


def _sales_columns() -> dict[str, Column]:
    """Columns of :func:`business_sales`, computed from a staging row."""
    d = parse_receipt_date(F.col("Date"))
    return {
        "business_abn": F.col("Business.ABN"), "business_name": F.col("Business.Name"),
        "receipt_ref": F.col("Reference"), "receipt_date": F.col("Date"),
        "receipt_total": F.col("Total"), "gst": F.col("GST"),
        "year": calendar_year(d), "month": calendar_month(d), "month_name": month_name(d),
    }


def matched_lines_in_receipt(stg: DataFrame, keep: dict[str, Column] | None = None
                             ) -> DataFrame:
    """Product lines with each promotion of the same receipt for the same product (a line
    without one is kept once with NULL terms), plus the ``keep`` columns of the receipt
    (name -> expression; default: receipt_ref). A receipt without Reference matches no
    promotion, as a join on a NULL key matches nothing."""
    keep = keep or {"receipt_ref": F.col("Reference")}
    names = list(keep)
    promotions = F.when(F.col("Reference").isNotNull(), F.col("Promotions")).alias("Promotions")
    exploded = stg.select(*[c.alias(n) for n, c in keep.items()],
                          F.explode("Products").alias("p"), promotions)
    matched = exploded.select(*names, "p", F.explode_outer(
        promotions_for(F.col("p"), F.col("Promotions"))).alias("d"))
    return matched.select(
        *names, F.col("p.Name").alias("product_name"),
        F.col("p.Cost").alias("product_cost"),
        F.col("p.Price").alias("product_price"),
        F.col("p.Quantity").alias("product_quantity"),
        F.col("d.Discount").alias("discount"),
        F.col("d.Per_Quantity").alias("per_quantity"))


def business_sales_in_receipt(stg: DataFrame) -> DataFrame:
    """:func:`business_sales` for staging rows with unique, non-NULL Reference."""
    cols = _sales_columns()
    return stg.filter(F.col("Reference").isNotNull()).select(
        *[c.alias(n) for n, c in cols.items()])


def _sums_in_receipt() -> dict[str, Column]:
    """Sums of the amounts of a staging row's product lines, each matched with the promotions of
    the same row, computed inside the row: no line leaves it. A line's values are cast and multiplied
    once; each sum computes its own amount, so that a reader of one sum pays for that alone."""
    promotions = F.when(F.col("Reference").isNotNull(), F.col("Promotions"))

    def read(p: Column) -> Column:
        return F.struct(as_money(p["Cost"]).alias("cost"), as_money(p["Price"]).alias("price"), as_quantity(p["Quantity"]).alias("qty"),
                        promotions_for(p, promotions).alias("terms"))

    def matched(x: Column) -> Column:
        def add(off: Column, d: Column) -> Column:
            per = d["Per_Quantity"]
            qualifies = ((per > 0) & (x["qty"] >= per)) | ((per < 0) & (x["qty"] > 0))
            return F.when(qualifies, (off + F.coalesce(as_discount(d["Discount"]), F.lit(0))).cast(_DISCOUNTS)).otherwise(off)

        off = F.aggregate(x["terms"], F.lit(0).cast(_DISCOUNTS), add)
        return F.struct((x["cost"] * x["qty"]).alias("cost"), (x["price"] * x["qty"]).alias("price"), F.size(x["terms"]).alias("m"), off.alias("off"))

    def total(name: str) -> Column:
        amounts = F.transform("_lines", lambda x: _line_amounts(x["cost"], x["price"], x["m"], x["off"])[name].cast(_SUM))
        return F.aggregate(amounts, F.lit(None).cast(_SUM), lambda s, v: F.coalesce((s + v).cast(_SUM), s, v))

    lines = F.transform(F.transform("Products", read), matched)
    return {"_lines": lines} | {name: total(name) for name in ("total_cost", "total_price", "price_after_discount", "profit")}


def _profits_in_receipt(stg: DataFrame, header: dict[str, Column]) -> DataFrame:
    """Profit sums by the ``header`` of receipts; receipts without product lines drop out."""
    columns = _sums_in_receipt()
    lines = stg.filter(F.size("Products") > 0).select(*[c.alias(n) for n, c in header.items()], columns.pop("_lines").alias("_lines"))
    return lines.select(*header, *[c.alias(n) for n, c in columns.items()]).groupBy(*header).agg(*_profit_sums())


def sale_profits_in_receipt(stg: DataFrame) -> DataFrame:
    """:func:`sale_profits` for staging rows with unique, non-NULL Reference."""
    return _profits_in_receipt(stg, {"receipt_ref": F.col("Reference")})


def business_sales_profits_in_receipt(stg: DataFrame) -> DataFrame:
    """:func:`business_sales_profits` for staging rows with unique, non-NULL Reference;
    receipts without product lines drop out as in the join. The receipt header columns
    depend on the receipt alone, so they ride along as grouping keys."""
    cols = _sales_columns()
    header = ["business_abn", "business_name", "receipt_date", "year", "month", "month_name",
              "receipt_ref", "receipt_total", "gst"]
    return _profits_in_receipt(stg.filter(F.col("Reference").isNotNull()), {n: cols[n] for n in header})
