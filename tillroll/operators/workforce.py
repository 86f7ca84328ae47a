"""Q3: staff per business month, attendance lists and yearly turnover (M10-M12, Q3-T1..T9).

Turnover rate of a fiscal year (July to June) = staff who left / mean of the July and June
headcounts x 100. A cashier has left in the fiscal year of the last month in which they
served a business, unless that month is the last month of the whole data set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.medians import exact_median
from tillroll.functions import (calendar_month, calendar_year, fiscal_year, month_index,
                                month_name, month_year_label, parse_receipt_date, period_label)

MONTH_KEYS = ["business_name", "year", "month", "month_name"]
# The two months whose headcounts bracket a fiscal year, by number and name.
PERIOD_MONTHS = [6, 7]
PERIOD_MONTH_NAMES = ["July", "June"]


def business_employees(businesses: DataFrame, cashiers: DataFrame, receipts: DataFrame
                       ) -> DataFrame:
    """Distinct (business, year, month, month name, cashier).

    The result is a set, so each input is reduced to its distinct (receipt, value) pairs before
    the joins: copies of a receipt then add no join rows (the plain three-way join would form
    k^3 rows for k copies before the DISTINCT).
    """
    d = parse_receipt_date(F.col("receipt_date"))
    return (businesses.select("receipt_ref", "business_name").distinct()
                      .join(cashiers.select("receipt_ref", "cashier_name").distinct(),
                            "receipt_ref", "inner")
                      .join(receipts.select("receipt_ref", "receipt_date").distinct(),
                            "receipt_ref", "inner")
                      .select("business_name", calendar_year(d).alias("year"),
                              calendar_month(d).alias("month"), month_name(d).alias("month_name"),
                              "cashier_name")
                      .distinct())


def business_employee_stats(employees: DataFrame) -> DataFrame:
    """Monthly headcount: distinct non-NULL cashier names."""
    return employees.groupBy(*MONTH_KEYS).agg(F.count("cashier_name").alias("num_employees"))


def employee_attendences(employees: DataFrame) -> DataFrame:
    """Monthly list of cashier names, sorted, comma separated; NULL if a month has none. The
    input holds a name once a month."""
    names = F.when(F.count("cashier_name") > 0,
                   F.array_join(F.array_sort(F.collect_list("cashier_name")), ", "))
    return employees.groupBy(*MONTH_KEYS).agg(names.alias("unique_employees"))


def june_july_headcount(stats: DataFrame) -> DataFrame:
    """Headcounts of June and July, with a ``month_year`` label."""
    return (stats.filter(F.col("month").isin(*PERIOD_MONTHS))
                 .withColumn("month_year", month_year_label(F.col("month"), F.col("year"))))


def employees_left(employees: DataFrame) -> DataFrame:
    """Leavers per (business, fiscal year), computed from the last month each cashier served.

    The latest month of the data set is a scalar subquery, so no row is joined against it.
    """
    idx = month_index(F.col("year"), F.col("month"))
    named = employees.filter(F.col("cashier_name").isNotNull())
    last_seen = named.groupBy("business_name", "cashier_name").agg(F.max(idx).alias("last_idx"))
    # A global max: each task sends one partial maximum, no hash shuffle.
    data_end = named.select(F.max(idx)).scalar()
    last_year = F.floor(F.col("last_idx") / 12).cast("bigint")
    last_month = (F.col("last_idx") % 12 + 1).cast("bigint")
    return (last_seen.filter(F.col("last_idx") < data_end)
                     .groupBy("business_name",
                              fiscal_year(last_year, last_month).alias("fiscal_year"))
                     .agg(F.count(F.lit(1)).alias("num_employee_left")))


def _one(value: str, rows: Column, what: str, *keys: str) -> Column:
    """The only value of a group; a group of more rows fails the job and names its key."""
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return F.when(rows > 1, F.raise_error(F.concat(F.lit(f"{what}: "), text))).otherwise(F.max(value))


def turnover_by_period(stats: DataFrame, leavers: DataFrame) -> DataFrame:
    """One row per (business, fiscal year) that has a June or July headcount.

    ``leavers`` has (business_name, fiscal_year, num_employee_left), for example a user's table. A
    fiscal year without leavers has 0; a year missing June or July has a NULL average and rate. Two
    headcounts of one business and month, or two leavers rows of one business and fiscal year, fail
    the job with the key in the message, as a pivot or a lookup of them has no single answer.
    """
    # Pivot of the two month names as conditional aggregation: one exchange (the two-phase
    # pivot operator needs two). Cells are counted in the same pass. Headcounts are DOUBLE
    # here, with NULL for a missing month, as in a pivoted frame.
    cells = [(m, F.when(F.col("month_name") == m, F.col("num_employees"))) for m in PERIOD_MONTH_NAMES]
    wide = (june_july_headcount(stats)
            .withColumn("fiscal_year", fiscal_year(F.col("year"), F.col("month")))
            .withColumns({f"_{m}": cell for m, cell in cells})
            .groupBy("business_name", "fiscal_year")
            .agg(*[_one(f"_{m}", F.count_if(F.col("month_name") == m), f"several headcounts of {m}", "business_name", "fiscal_year")
                   .cast("double").alias(m) for m in PERIOD_MONTH_NAMES]))
    lookup = leavers.groupBy("business_name", "fiscal_year").agg(
        _one("num_employee_left", F.count(F.lit(1)), "several leavers rows", "business_name", "fiscal_year").alias("num_employee_left"))
    return _rates(wide.join(lookup, ["business_name", "fiscal_year"], "left"))


def _rates(wide: DataFrame) -> DataFrame:
    left = F.coalesce(F.col("num_employee_left"), F.lit(0)).cast("bigint")
    avg = (F.col("July") + F.col("June")) / 2
    return (wide.select("business_name", "fiscal_year",
                        period_label(F.col("fiscal_year")).alias("year_period"),
                        "July", "June", avg.alias("annual_avg_employee"),
                        left.alias("num_employee_left"))
                .withColumn("annual_turnover_rate",
                            F.try_divide(F.col("num_employee_left"),
                                         F.col("annual_avg_employee")) * 100))


# Fiscal years that the bitmaps of turnover_from_service cover: two bits (July, June) a year,
# 30 years a word.
FIRST_FISCAL_YEAR, YEARS_A_WORD, WORDS = 1900, 30, 7


def service_bitmaps(service: DataFrame) -> DataFrame:
    """(business_name, cashier_name, last_idx, words): per cashier of a business the last month
    served and, as bits, in which Julys and Junes they served.

    ``service`` has (business_name, cashier_name, year, month), one row per receipt or fewer. Only
    ``max`` and ``bit_or`` of fixed size are aggregated, so a hot business is reduced in every map
    task, and repeats need no DISTINCT before. Fiscal years outside the covered range fail."""
    fy = fiscal_year(F.col("year"), F.col("month"))
    at = fy - FIRST_FISCAL_YEAR
    checked = F.when((at < 0) | (at >= YEARS_A_WORD * WORDS), F.raise_error(F.concat(
        F.lit("fiscal year outside the turnover bitmaps: "), fy.cast("string"))).cast("bigint")).otherwise(at)
    rows = service.select("business_name", "cashier_name", month_index(F.col("year"), F.col("month")).alias("_idx"), checked.alias("_at"),
                          F.when(F.col("month") == PERIOD_MONTHS[1], 0).when(F.col("month") == PERIOD_MONTHS[0], 1).alias("_bit"))
    bit = F.expr(f"shiftleft(1L, cast(_at % {YEARS_A_WORD} * 2 + _bit as int))")
    word = lambda k: F.bit_or(F.when(F.col("_bit").isNotNull() & (F.expr(f"_at div {YEARS_A_WORD}") == k), bit))
    return rows.groupBy("business_name", "cashier_name").agg(
        F.max("_idx").alias("last_idx"), F.array(*[F.coalesce(word(k), F.lit(0).cast("bigint")) for k in range(WORDS)]).alias("words"))


def turnover_from_service(service: DataFrame) -> DataFrame:
    """:func:`turnover_by_period` with computed leavers, from one aggregated state.

    Headcounts of July and June, the last month of every cashier and the leavers all come from
    :func:`service_bitmaps`, so the rows are scanned once; two exchanges (by business and cashier, by
    business and fiscal year) and one scalar, the last month of the data, from the same state.
    """
    state = service_bitmaps(service)
    named = F.col("cashier_name").isNotNull()
    # Words are never negative; reading them here gives the scalar the very state that the rows
    # come from, so its exchange is reused instead of a second scan.
    data_end = state.select(F.max(F.when(named & (F.array_max("words") >= 0), F.col("last_idx")))).scalar()
    last_year, last_month = F.floor(F.col("last_idx") / 12).cast("bigint"), (F.col("last_idx") % 12 + 1).cast("bigint")
    bits = f"(shiftright(words[cast(k div {YEARS_A_WORD} as int)], cast(k % {YEARS_A_WORD} * 2 as int)) & 3)"
    served = F.expr(f"""transform(filter(sequence(0, {YEARS_A_WORD * WORDS - 1}), k -> {bits} <> 0),
        k -> named_struct('fiscal_year', cast(k + {FIRST_FISCAL_YEAR} as bigint), 'months', cast({bits} as int), 'gone', 0))""")
    # A NULL business has no leavers: a lookup by its name finds none.
    gone = F.when(named & F.col("business_name").isNotNull() & (F.col("last_idx") < data_end), F.array(F.struct(
        fiscal_year(last_year, last_month).alias("fiscal_year"), F.lit(0).alias("months"), F.lit(1).alias("gone"))))
    events = state.select("business_name", named.cast("int").alias("staff"), F.explode(F.concat(served, F.coalesce(
        gone, F.expr("cast(array() as array<struct<fiscal_year:bigint,months:int,gone:int>>)")))).alias("e"))
    count = lambda bit: F.sum(F.when(F.col("e.months").bitwiseAND(F.lit(bit)) > 0, F.col("staff"))).cast("double")
    wide = events.groupBy("business_name", F.col("e.fiscal_year").alias("fiscal_year")).agg(
        count(1).alias("July"), count(2).alias("June"), F.sum("e.gone").alias("num_employee_left"))
    return _rates(wide.filter("July is not null or June is not null"))


def turnover_summary(by_period: DataFrame) -> DataFrame:
    """Per business: mean (rounded to 2 places) and median of the yearly rates, NULLs skipped."""
    rate = F.col("annual_turnover_rate")
    return by_period.groupBy("business_name").agg(
        F.round(F.avg(rate), 2).alias("avg_turnover_rate"),
        F.median(rate).alias("median_turnover_rate"))


def turnover_summary_by_rank(by_period: DataFrame) -> DataFrame:
    """:func:`turnover_summary` with the median by rank selection, for groups too large for one task."""
    mean = by_period.groupBy("business_name").agg(F.round(F.avg("annual_turnover_rate"), 2).alias("avg_turnover_rate"))
    median = exact_median(by_period, ["business_name"], "annual_turnover_rate", "median_turnover_rate")
    named = median.withColumnRenamed("business_name", "_business")
    return mean.join(named, F.col("business_name").eqNullSafe(F.col("_business"))).drop("_business")


def service_in_receipt(stg: DataFrame) -> DataFrame:
    """One row per staging row with a Reference: who served which business in which month."""
    d = parse_receipt_date(F.col("Date"))
    return (stg.filter(F.col("Reference").isNotNull())
               .select(F.col("Business.Name").alias("business_name"),
                       calendar_year(d).alias("year"), calendar_month(d).alias("month"),
                       month_name(d).alias("month_name"), F.col("Cashier").alias("cashier_name")))


def business_employees_in_receipt(stg: DataFrame) -> DataFrame:
    """:func:`business_employees` for staging rows with unique, non-NULL Reference: the three
    joined tables are projections of the same row."""
    return service_in_receipt(stg).distinct()
