"""Models kept up to date load by load: every load adds partial states, readers merge them.

``load_receipts`` stages one load (a day's receipts) and writes the states of that load alone: sums
and counts of profits by business month and of spend by customer, the distinct service rows, the
businesses, row and NULL counts. Its work grows with the load, not with the history, of which it
reads the Reference column only (nothing, if the caller states that no Reference repeats).
``loaded_models`` merges the states of all loads; they are as small as the models themselves. Models
of single receipts read staging. All results equal a full rebuild over the receipts of all loads.

References that repeat, inside a load or across loads, multiply in the joins of the models. Each load
writes down those it finds; states hold the profits of receipts that are alone in their load, and
readers replace those of repeated ones by the join forms over these receipts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import loyalty, profit
from tillroll.plans.pipeline import ReceiptModels
from tillroll.schemas import RECEIPT
from tillroll.session import scratch_path
from tillroll.sources.runs import LoadStore
from tillroll.sources.staging import STAGING_KEY, STAGING_TABLE, reference_conflicts, split_by_conflict

#: The models of which loads keep partial states.
PARTIAL_NAMES = ["business_monthly_profits", "customer_totals", "business_employees", "businesses", "staging_row_count", "contract_report"]
_REPEATED = "repeated_references"
_REPEATED_SCHEMA = T.StructType([T.StructField(STAGING_KEY, T.StringType()), T.StructField("in_load", T.BooleanType())])


def load_receipts(spark: SparkSession, root: str, load: str, receipts: DataFrame, unique_reference: bool = False) -> tuple[str, str]:
    """Add (or, under a name that was loaded before, replace) one load; readers see it once it is
    committed. ``unique_reference`` states that no Reference repeats in any load. One load runs at a time."""
    store = LoadStore(spark, root)
    run = store.new_load(load)
    others = {k: v for k, v in store.current().items() if k != load}
    staged = store.write(receipts.select(RECEIPT.fieldNames()), run, STAGING_TABLE)
    alone = staged
    if not unique_reference:
        repeated = store.write(_repeated_references(staged, store.loads(STAGING_TABLE, RECEIPT, others)), run, _REPEATED)
        in_load = repeated.filter("in_load")
        if n := in_load.count():
            alone, _ = split_by_conflict(staged, in_load, n)
    else:
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in _REPEATED_SCHEMA]
        store.write(spark.range(0).select(*none), run, _REPEATED)
    _write_states(store, run, partial_states(staged, alone))
    store.commit(run)
    return run


def _write_states(store: LoadStore, run: tuple[str, str], states: dict[str, DataFrame]) -> None:
    """Write the states, each by a job of its own. The jobs are given to Spark together, so that cores that
    one has no more tasks for serve the next; the first failure fails the load."""
    write = inheritable_thread_target(store.spark)(lambda name: store.write(states[name], run, f"state_{name}"))
    with ThreadPoolExecutor(len(states)) as pool:
        list(pool.map(write, states))


def partial_states(staged: DataFrame, alone: DataFrame) -> dict[str, DataFrame]:
    """The states of one load's receipts, of which ``alone`` are those with a Reference of their own (or none)."""
    models = ReceiptModels(staged, unique_reference=True)
    models.use("business_monthly_profits", ReceiptModels(alone, unique_reference=True).business_monthly_profits)
    return {name: getattr(models, name) for name in PARTIAL_NAMES}


def _repeated_references(staged: DataFrame, others: DataFrame) -> DataFrame:
    """References on several rows of the load, or on one of it and in other loads."""
    here = staged.filter(F.col(STAGING_KEY).isNotNull()).groupBy(STAGING_KEY).agg((F.count(F.lit(1)) > 1).alias("in_load"))
    both = others.select(STAGING_KEY).join(here.select(STAGING_KEY), STAGING_KEY).select(STAGING_KEY, F.lit(False).alias("in_load"))
    return (here.filter("in_load").unionByName(both).groupBy(STAGING_KEY).agg(F.max("in_load").alias("in_load")))


def loaded_models(spark: SparkSession, root: str, leavers: DataFrame | None = None, top_k: int = loyalty.TOP_K) -> ReceiptModels:
    """All models over the receipts of all committed loads."""
    store = LoadStore(spark, root)
    runs = store.current()
    staging = store.loads(STAGING_TABLE, RECEIPT, runs)
    found = store.loads(_REPEATED, _REPEATED_SCHEMA, runs)
    repeated = found.select(STAGING_KEY).distinct()
    n = repeated.count()
    models = ReceiptModels(staging.drop("load"), unique_reference=None if n else True, leavers=leavers, top_k=top_k, conflicts=(repeated, n))
    empty = partial_states(staging.drop("load"), staging.drop("load"))  # for their schemas
    states = {name: store.loads(f"state_{name}", empty[name].schema, runs).drop("load") for name in PARTIAL_NAMES}
    if n:
        monthly, service = _of_repeated(staging, found, repeated, n)
        states["business_monthly_profits"] = states["business_monthly_profits"].unionByName(monthly)
        states["business_employees"] = states["business_employees"].unionByName(service)
    models.use("business_monthly_profits", profit.merged_monthly_profits(states["business_monthly_profits"]))
    models.use("customer_totals", loyalty.merged_customer_totals(states["customer_totals"]))
    models.use("business_employees", states["business_employees"].distinct())
    models.use("businesses", states["businesses"].distinct())
    models.use("staging_row_count", states["staging_row_count"].agg(F.coalesce(F.sum("num_rows"), F.lit(0)).alias("num_rows")))
    if runs:
        models.use("contract_report", states["contract_report"].groupBy("table_name", "column_name").agg(F.sum("null_count").alias("null_count")))
    return models


def _of_repeated(staging: DataFrame, found: DataFrame, repeated: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """What repeated receipts add to the loads' states: monthly profits (those of the join forms, less
    what the loads hold of these receipts) and service rows."""
    _, rows = split_by_conflict(staging, repeated, n)
    path = scratch_path(staging.sparkSession, "repeated-receipts")
    rows.write.parquet(path)  # the join forms read them list by list, staging is read once
    shared = staging.sparkSession.read.schema(rows.schema).parquet(path)
    joined = ReceiptModels(shared.drop("load"), unique_reference=False)
    # A receipt that is alone in its load is in that load's state. Its key with the load's name is unique.
    held = shared.join(found.filter("in_load").select("load", STAGING_KEY), ["load", STAGING_KEY], "left_anti")
    held = held.withColumn(STAGING_KEY, F.concat_ws("\t", "load", STAGING_KEY)).drop("load")
    taken = profit.without_monthly_profits(ReceiptModels(held, unique_reference=True).business_monthly_profits)
    return joined.business_monthly_profits.unionByName(taken), joined.business_employees
