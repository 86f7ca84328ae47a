"""The model graph: every table of the receipt analysis, built lazily from the staging rows.

Physical plan choices:

* Every receipt-level join of the original models is on ``receipt_ref``, and every
  normalised table is a projection or explode of one staging row. When no two rows share a
  ``Reference``, each such join only rebuilds the staging row, so the receipt-local forms
  (``*_in_receipt``) project the row instead of joining it back, and match each product line
  with the promotions of its own row (array filter + explode_outer) instead of a join. No
  receipt-level model joins; the per-receipt sums need one exchange, or none when the staging
  table is bucketed by Reference; each analysis costs one shuffle after partial aggregation.
* Whether the key condition holds is checked once, with an aggregation over the Reference
  column alone (``reference_is_unique``), unless the caller states it (``unique_reference``),
  for example for a staging table whose load deduplicated receipts. The check writes the
  repeated References down; if there are any, staging is split by them: rows with a Reference of
  their own (or none) still take the receipt-local forms, and the general join forms, with the
  bag semantics of the original models, read the repeated receipts alone. Both parts' rows are
  the result, as no join of the models reaches across References; groups by business are merged.
* Aggregations by business use partial aggregation, so a business holding a third of all
  receipts costs one row per map task in the shuffle; top-k per business is cut in every map
  task before its shuffle (WindowGroupLimit). No broadcast hint is given: small sides are
  broadcast by Spark's size statistics or by adaptive execution at run time, which measure them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import lines, loyalty, normalise, profit, quality, workforce
from tillroll.session import scratch_path
from tillroll.sources.staging import reference_conflicts, split_by_conflict, staging_row_count

MODEL_NAMES = [
    "receipts", "receipt_businesses", "receipt_cashiers", "receipt_customers",
    "receipt_payments", "receipt_products", "receipt_promotions",
    "business_sales", "business_sales_profits", "sale_profits", "business_monthly_profits",
    "monthly_profit_series",
    "business_customers", "business_customers_summary", "top_ten_customers_by_business_value",
    "top_ten_customers_by_num_purchases",
    "business_employees", "business_employee_stats", "employee_attendences",
    "june_july_headcount", "employees_left", "turnover_by_period", "turnover_summary",
    "products", "sales_details",
    "staging_row_count", "businesses", "contract_report",
]

# Aggregated states that several models read; the daily job writes them once.
STATE_NAMES = ["customer_totals"]

# How the daily job lays out the tables that readers filter by business.
SERVED_BY = {
    "business_monthly_profits": ["business_name", "year", "month"],
    "monthly_profit_series": ["business_name", "year", "month"],
    "business_customers_summary": ["business_name", "customer_name"],
    "business_employee_stats": ["business_name", "year", "month"],
    "employee_attendences": ["business_name", "year", "month"],
    "turnover_by_period": ["business_name", "fiscal_year"],
}


class ReceiptModels:
    """Lazy access to every model over one staging DataFrame.

    ``unique_reference``: True states that no two staging rows share a Reference (receipt-local
    forms), False that the join forms shall run on all rows; None finds the repeated References on
    first use of a join-based model and splits the rows by them, unless they are known: ``conflicts``
    gives them (a written table with a column Reference) and their number. ``leavers`` optionally replaces the
    computed leaver counts with a user table (business_name, fiscal_year, num_employee_left).
    """

    def __init__(self, staging: DataFrame, unique_reference: bool | None = None,
                 leavers: DataFrame | None = None, top_k: int = loyalty.TOP_K,
                 conflicts: tuple[DataFrame, int] | None = None):
        self.staging = staging
        self._unique = unique_reference
        self._leavers = leavers
        self.top_k = top_k
        self._served: set[str] = set()
        if conflicts is not None:
            self._conflicts = conflicts

    @cached_property
    def _conflicts(self) -> tuple[DataFrame, int]:
        """The repeated References, written to the shared scratch folder, and their number."""
        spark = self.staging.sparkSession
        path = scratch_path(spark, "repeated-references")
        reference_conflicts(self.staging).write.parquet(path)
        found = spark.read.parquet(path)
        return found, found.count()

    @cached_property
    def receipt_local(self) -> bool:
        """Whether the receipt-local forms apply to all rows (no Reference on two rows)."""
        return self._unique if self._unique is not None else not self._conflicts[1]

    @cached_property
    def parts(self) -> list[ReceiptModels]:
        """Models over the rows with a Reference of their own, and over those that share one."""
        alone, shared = split_by_conflict(self.staging, *self._conflicts)
        return [ReceiptModels(alone, unique_reference=True), ReceiptModels(shared, unique_reference=False)]

    def _by_form(self, name: str, local: Callable[[], DataFrame], joined: Callable[[], DataFrame]) -> DataFrame:
        """Model ``name`` in the form that applies, or both parts' rows."""
        if self.receipt_local:
            return local()
        if self._unique is False:
            return joined()
        alone, shared = self.parts
        return alone.table(name).unionByName(shared.table(name))

    def table(self, name: str) -> DataFrame:
        if name not in MODEL_NAMES:
            raise KeyError(name)
        return getattr(self, name)

    def use(self, name: str, df: DataFrame) -> None:
        """Serve model ``name`` (or a state that models share) from ``df``, typically its written
        table, from now on, so that models built later read it instead of recomputing it."""
        if name not in MODEL_NAMES + STATE_NAMES:
            raise KeyError(name)
        self.__dict__[name] = df
        self._served.add(name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in MODEL_NAMES}

    # -- normalised tables -----------------------------------------------------------------
    @cached_property
    def receipts(self) -> DataFrame:
        return normalise.receipts(self.staging)

    @cached_property
    def receipt_businesses(self) -> DataFrame:
        return normalise.receipt_businesses(self.staging)

    @cached_property
    def receipt_cashiers(self) -> DataFrame:
        return normalise.receipt_cashiers(self.staging)

    @cached_property
    def receipt_customers(self) -> DataFrame:
        return normalise.receipt_customers(self.staging)

    @cached_property
    def receipt_payments(self) -> DataFrame:
        return normalise.receipt_payments(self.staging)

    @cached_property
    def receipt_products(self) -> DataFrame:
        return normalise.receipt_products(self.staging)

    @cached_property
    def receipt_promotions(self) -> DataFrame:
        return normalise.receipt_promotions(self.staging)

    # -- Q1 ----------------------------------------------------------------------------------
    @cached_property
    def business_sales(self) -> DataFrame:
        return self._by_form("business_sales", lambda: profit.business_sales_in_receipt(self.staging),
                             lambda: profit.business_sales(self.receipts, self.receipt_businesses))

    @cached_property
    def sale_profits(self) -> DataFrame:
        if self.receipt_local and "business_sales_profits" in self._served:
            # already computed per receipt and written: a projection, plus the group without Reference
            rest = profit.sale_profits_in_receipt(self.staging.filter(F.col("Reference").isNull()))
            return self.business_sales_profits.select(*rest.columns).unionByName(rest)
        return self._by_form("sale_profits", lambda: profit.sale_profits_in_receipt(self.staging),
                             lambda: profit.sale_profits(self.receipt_products, self.receipt_promotions))

    @cached_property
    def business_sales_profits(self) -> DataFrame:
        return self._by_form("business_sales_profits", lambda: profit.business_sales_profits_in_receipt(self.staging),
                             lambda: profit.business_sales_profits(self.business_sales, self.sale_profits))

    @cached_property
    def business_monthly_profits(self) -> DataFrame:
        if not self.receipt_local and self._unique is None:
            alone, shared = self.parts
            return profit.merged_monthly_profits(alone.business_monthly_profits.unionByName(shared.business_monthly_profits))
        # repeated receipts: sums from counted distinct values, not from the pairs
        return self._by_form("business_monthly_profits", lambda: profit.business_monthly_profits(self.business_sales_profits),
                             lambda: profit.business_monthly_profits_by_counts(self.receipts, self.receipt_businesses, self.sale_profits))

    @cached_property
    def monthly_profit_series(self) -> DataFrame:
        return profit.monthly_profit_series(self.business_monthly_profits)

    # -- Q2 ----------------------------------------------------------------------------------
    @cached_property
    def business_customers(self) -> DataFrame:
        return loyalty.business_customers(self.staging)

    @cached_property
    def business_customers_summary(self) -> DataFrame:
        return self.customer_totals.drop(loyalty.EXACT_SPENT)

    @cached_property
    def customer_totals(self) -> DataFrame:
        """The summary with unrounded sums, which the rankings go by."""
        return loyalty.customer_totals(self.business_customers)

    @cached_property
    def top_ten_customers_by_business_value(self) -> DataFrame:
        return loyalty.top_customers_by_value(self.customer_totals, self.top_k)

    @cached_property
    def top_ten_customers_by_num_purchases(self) -> DataFrame:
        return loyalty.top_customers_by_purchases(self.customer_totals, self.top_k)

    # -- Q3 ----------------------------------------------------------------------------------
    @cached_property
    def business_employees(self) -> DataFrame:
        if not self.receipt_local and self._unique is None:
            return self.service.distinct()
        return self._by_form("business_employees", lambda: workforce.business_employees_in_receipt(self.staging),
                             lambda: workforce.business_employees(self.receipt_businesses, self.receipt_cashiers, self.receipts))

    @cached_property
    def service(self) -> DataFrame:
        """The rows of ``business_employees`` with repeats, where leaving these in saves a shuffle."""
        if "business_employees" in self._served:
            return self.business_employees
        if self.receipt_local:
            return workforce.service_in_receipt(self.staging)
        if self._unique is False:
            return self.business_employees
        alone, shared = self.parts
        return alone.service.unionByName(shared.business_employees)

    @cached_property
    def business_employee_stats(self) -> DataFrame:
        return workforce.business_employee_stats(self.business_employees)

    @cached_property
    def employee_attendences(self) -> DataFrame:
        return workforce.employee_attendences(self.business_employees)

    @cached_property
    def june_july_headcount(self) -> DataFrame:
        return workforce.june_july_headcount(self.business_employee_stats)

    @cached_property
    def employees_left(self) -> DataFrame:
        if self._leavers is not None:
            return self._leavers
        return workforce.employees_left(self.business_employees)

    @cached_property
    def turnover_by_period(self) -> DataFrame:
        if self._leavers is None and not self._served & {"business_employee_stats", "employees_left"}:
            return workforce.turnover_from_service(self.service)
        return workforce.turnover_by_period(self.business_employee_stats, self.employees_left)

    @cached_property
    def turnover_summary(self) -> DataFrame:
        return workforce.turnover_summary(self.turnover_by_period)

    # -- product lines -----------------------------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        return self._by_form("products", lambda: lines.products_in_receipt(self.staging),
                             lambda: lines.products(self.receipt_products, self.receipt_promotions))

    @cached_property
    def sales_details(self) -> DataFrame:
        return self._by_form("sales_details", lambda: lines.sales_details_in_receipt(self.staging),
                             lambda: lines.sales_details(self.receipts, self.receipt_businesses, self.receipt_products))

    # -- load checks and small readers ---------------------------------------------------------
    @cached_property
    def staging_row_count(self) -> DataFrame:
        return staging_row_count(self.staging)

    @cached_property
    def businesses(self) -> DataFrame:
        return self.receipt_businesses.select("business_name").distinct()

    @cached_property
    def contract_report(self) -> DataFrame:
        """NULL counts of the NOT NULL columns of all normalised tables, one staging pass."""
        return quality.contract_report_in_receipt(self.staging)
