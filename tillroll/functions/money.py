"""Money expressions.

Tables carry money as DOUBLE, as delivered or rounded once to cents, like the original tables.
Every computation on money runs on exact decimals (see tillroll.schemas): amounts, quantities
and discounts keep the decimals they were delivered with, are multiplied and summed as decimals,
and are rounded to cents and converted back to DOUBLE once, so results do not depend on summation
order or engine.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import DISCOUNT, MONEY, QUANTITY, TOTAL


def as_money(c: Column) -> Column:
    """An amount as an exact decimal, for arithmetic."""
    return c.cast(MONEY)


def as_quantity(c: Column) -> Column:
    return c.cast(QUANTITY)


def as_discount(c: Column) -> Column:
    return c.cast(DISCOUNT)


def as_total(c: Column) -> Column:
    """Round an exact result to cents, half up."""
    return c.cast(TOTAL)


def to_amount(c: Column) -> Column:
    """An exact decimal result, rounded half up to cents, as the table type of money."""
    return c.cast(TOTAL).cast("double")


def sum_exact(c: Column) -> Column:
    """Sum of delivered money amounts as an exact decimal, not yet rounded."""
    return F.sum(c.cast(MONEY))


def sum_cents(c: Column) -> Column:
    """Sum of amounts that were rounded to cents before: summed as a decimal, converted once."""
    return to_amount(F.sum(c.cast(TOTAL)))
