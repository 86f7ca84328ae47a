from tillroll.functions.dates import (calendar_month, calendar_year, fiscal_year, month_index,
                                      month_name, month_year_label, parse_receipt_date,
                                      period_label)
from tillroll.functions.money import (as_discount, as_money, as_quantity, as_total, sum_cents, sum_exact,
                                      to_amount)

__all__ = [
    "as_discount", "as_money", "as_quantity", "as_total", "calendar_month", "calendar_year",
    "fiscal_year", "month_index", "month_name", "month_year_label", "parse_receipt_date",
    "period_label", "sum_cents", "sum_exact", "to_amount",
]
