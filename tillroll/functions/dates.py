"""Date expressions. All are built-in Column expressions (JVM side, codegen)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Receipt dates are written as year, month, day with slashes or hyphens, padded or not; the month name is the full
# English name; the fiscal year starts in July.
RECEIPT_DATE_FORMATS = ("yyyy/M/d", "yyyy-M-d")
MONTH_NAME_FORMAT = "MMMM"
FISCAL_YEAR_FIRST_MONTH = 7


def try_receipt_date(c: Column) -> Column:
    """As :func:`parse_receipt_date`, but NULL for other text."""
    return F.coalesce(*[F.try_to_date(c, f) for f in RECEIPT_DATE_FORMATS])


def parse_receipt_date(c: Column) -> Column:
    """``'2022/07/02'``, ``'2022-07-02'`` or ``'2022/7/2'`` -> DATE; other text fails the job."""
    parsed = try_receipt_date(c)
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not a receipt date: "), c)).cast("date")).otherwise(parsed)


def calendar_year(d: Column) -> Column:
    return F.year(d).cast("bigint")


def calendar_month(d: Column) -> Column:
    return F.month(d).cast("bigint")


def month_name(d: Column) -> Column:
    """Full month name, e.g. ``July``."""
    return F.date_format(d, MONTH_NAME_FORMAT)


def month_year_label(month: Column, year: Column) -> Column:
    """``7-2022``: month and year without zero padding."""
    return F.concat(month.cast("string"), F.lit("-"), year.cast("string"))


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0; orders (year, month) pairs with one number."""
    return year * 12 + month - 1


def fiscal_year(year: Column, month: Column) -> Column:
    """Calendar year in which the July-to-June fiscal year starts."""
    return F.when(month >= FISCAL_YEAR_FIRST_MONTH, year).otherwise(year - 1).cast("bigint")


def period_label(fy: Column) -> Column:
    """``July 2022 - June 2023`` for fiscal year 2022."""
    return F.concat(F.lit("July "), fy.cast("string"), F.lit(" - June "), (fy + 1).cast("string"))
