"""Table contracts: NULL counts of the declared NOT NULL columns, per table (one pass each,
for any tables) or for all normalised tables from one pass over the staging rows; counts of values
outside the declared types; both also as metrics gathered while the staging rows are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import try_receipt_date
from tillroll.operators import normalise
from tillroll.schemas import DECLARED_TYPES, NOT_NULL_CONTRACT


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """(table_name, column_name, null_count) for the given columns, from one aggregation."""
    sums = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in columns])
    return (sums.unpivot([], columns, "column_name", "null_count")
                .select(F.lit(table).alias("table_name"), "column_name",
                        F.coalesce(F.col("null_count"), F.lit(0)).cast("bigint")
                         .alias("null_count")))


def contract_report(tables: dict[str, DataFrame], contract: dict | None = None) -> DataFrame:
    """NULL counts of every NOT NULL column of the given normalised tables."""
    contract = contract or NOT_NULL_CONTRACT
    parts = [null_counts(df, name, contract[name]) for name, df in tables.items()
             if name in contract]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contract_violations(tables: dict[str, DataFrame], contract: dict | None = None) -> DataFrame:
    """Only the columns that break their NOT NULL contract."""
    return contract_report(tables, contract).filter(F.col("null_count") > 0)


def _is_null_in(element, column: str):
    """Predicate on one list element: its ``column`` is NULL (one-argument lambda; a second
    argument would receive the element's index)."""
    return lambda p: element(p)[column].isNull()


def contract_report_in_receipt(stg: DataFrame, contract: dict | None = None) -> DataFrame:
    """:func:`contract_report` of the normalised tables, computed from one aggregation over the
    staging rows: row tables count NULL expressions, list tables count the list elements whose
    column is NULL (and all elements of a receipt without Reference for ``receipt_ref``)."""
    return _report(stg, _null_counts_in_receipt(contract or NOT_NULL_CONTRACT), "null_count")


def _null_counts_in_receipt(contract: dict) -> dict[str, Column]:
    """NULLs that one staging row adds, by ``table:column``."""
    counts: dict[str, Column] = {}
    for table, cols in contract.items():
        if table in normalise.ROW_TABLES:
            exprs = normalise.ROW_TABLES[table]()
            for c in cols:
                counts[f"{table}:{c}"] = exprs[c].isNull().cast("bigint")
            continue
        field, element = normalise.LINE_TABLES[table]
        items = F.col(field)
        for c in cols:
            if c == "receipt_ref":
                n = F.when(F.col("Reference").isNull() & items.isNotNull(), F.size(items))
            else:
                n = F.size(F.filter(items, _is_null_in(element, c)))
            counts[f"{table}:{c}"] = F.coalesce(n, F.lit(0)).cast("bigint")
    return counts


def _report(stg: DataFrame, counts: dict[str, Column], name: str) -> DataFrame:
    sums = stg.agg(*[F.sum(e).alias(k) for k, e in counts.items()])
    return (sums.unpivot([], list(counts), "key", name)
                .select(F.split("key", ":")[0].alias("table_name"),
                        F.split("key", ":")[1].alias("column_name"),
                        F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)))


def _integer_misfit(c: Column) -> Column:
    return (c < -2 ** 31) | (c >= 2 ** 31)


def _float_misfit(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == float("inf"))


def _date_misfit(c: Column) -> Column:
    return c.isNotNull() & try_receipt_date(c).isNull()


_MISFITS = {"INTEGER": _integer_misfit, "FLOAT": _float_misfit, "DATE": _date_misfit}


def _misfit_in(element, column: str, misfit) -> Callable[[Column], Column]:
    return lambda p: misfit(element(p)[column])


def _misfit_counts_in_receipt(declared: dict) -> dict[str, Column]:
    """Values outside their declared type that one staging row adds, by ``table:column``."""
    counts: dict[str, Column] = {}
    for table, columns in declared.items():
        for c, kind in columns.items():
            if table in normalise.ROW_TABLES:
                n = _MISFITS[kind](normalise.ROW_TABLES[table]()[c]).cast("bigint")
            else:
                field, element = normalise.LINE_TABLES[table]
                n = F.size(F.filter(F.col(field), _misfit_in(element, c, _MISFITS[kind])))
            counts[f"{table}:{c}"] = F.coalesce(n, F.lit(0)).cast("bigint")
    return counts


def type_report_in_receipt(stg: DataFrame, declared: dict | None = None) -> DataFrame:
    """(table_name, column_name, misfit_count): values that don't fit the declared type of their column,
    from one aggregation over the staging rows. Text that is no receipt date, integers beyond 32 bits
    and numbers that aren't finite don't fit; NULL does."""
    return _report(stg, _misfit_counts_in_receipt(declared or DECLARED_TYPES), "misfit_count")


def observe_contracts(stg: DataFrame, observation: Observation) -> DataFrame:
    """The same rows, whose next write or read gathers both reports' counts in ``observation``: no scan
    of their own (see :func:`reports_from_metrics`)."""
    counts = ({f"null:{k}": e for k, e in _null_counts_in_receipt(NOT_NULL_CONTRACT).items()}
              | {f"type:{k}": e for k, e in _misfit_counts_in_receipt(DECLARED_TYPES).items()})
    return stg.observe(observation, *[F.coalesce(F.sum(e), F.lit(0)).alias(k) for k, e in counts.items()])


def reports_from_metrics(spark: SparkSession, metrics: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """``contract_report`` and ``type_report`` of the rows that were observed."""
    split = [(*key.split(":"), n) for key, n in metrics.items()]
    return tuple(spark.createDataFrame([(t, c, n) for k, t, c, n in split if k == kind],
                                       f"table_name string, column_name string, {name} long")
                 for kind, name in (("null", "null_count"), ("type", "misfit_count")))
