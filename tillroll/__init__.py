"""tillroll: point-of-sale receipt analytics on Spark DataFrames.

Receipt documents are read with an explicit schema, normalised into flat tables keyed by
``receipt_ref`` and turned into the analyses a retail operator asks for: promotion-adjusted
profit per receipt and month (Q1), the most loyal customers of each business (Q2) and staff
headcount, attendance and yearly turnover (Q3). Every step is a ``DataFrame -> DataFrame``
function made of built-in Spark operators.
"""

from tillroll.plans.pipeline import ReceiptModels

__all__ = ["ReceiptModels"]
