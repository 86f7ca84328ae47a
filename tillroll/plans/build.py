"""The daily job: load the receipt folder, stage it, and write every model as a table.

Models are written in dependency order (MODEL_NAMES is topologically sorted). Models that sum up
another one read its written table; the receipt-level ones start from staging, as their rows are
projections of a staging row. Written tables also cut the lineage: a lost executor costs a
recomputation from the last written table, not from the raw files.

``run_daily`` writes to a run folder and commits it (``RunStore``): repeatable in any session and
atomic for readers. ``run_pipeline`` replaces tables of the session catalog, for use within one
session or with a persistent catalog. ``bucket_receipt_tables=True`` buckets the tables keyed by
``receipt_ref``, for users who join them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.loyalty import TOP_K
from tillroll.operators.quality import observe_contracts
from tillroll.plans.pipeline import MODEL_NAMES, SERVED_BY, STATE_NAMES, ReceiptModels
from tillroll.schemas import RECEIPT
from tillroll.sources.receipts import load_outcome, read_receipts, split_load
from tillroll.sources.runs import RunStore
from tillroll.sources.staging import STAGING_TABLE, materialise, stage_receipts


def build_all(models: ReceiptModels, prefix: str = "", names: list[str] | None = None,
              num_buckets: int | None = None, bucket_receipt_tables: bool = False
              ) -> dict[str, DataFrame]:
    """Write each model as table ``prefix + name`` (full refresh); return the tables."""
    written = {}
    for name in names or MODEL_NAMES:
        df = models.table(name)
        bucket = ("receipt_ref" if bucket_receipt_tables and "receipt_ref" in df.columns
                  else None)
        table = materialise(df, prefix + name, bucket_by=bucket, num_buckets=num_buckets)
        models.use(name, table)
        written[name] = table
    return written


def _observed(receipts: DataFrame, load: Observation | None, contracts: Observation | None) -> DataFrame:
    if load is not None:
        receipts = receipts.observe(load, F.count(F.lit(1)).alias("num_rows"))
    return receipts if contracts is None else observe_contracts(receipts, contracts)


def run_daily(spark: SparkSession, root: str, source_dir: str | None = None, layout: str = "document",
              staging: str | None = None, strict: bool = True, unique_reference: bool | None = None,
              leavers: DataFrame | None = None, top_k: int = TOP_K,
              load: Observation | None = None, contracts: Observation | None = None) -> tuple[str, dict[str, DataFrame]]:
    """One run of the daily job into ``root``; returns its id and tables once it is committed.

    The receipts come from the files of ``source_dir``, which are staged in the run's folder, or
    from ``staging``, a Parquet path that ``ingest_new_receipts`` keeps up to date. With
    ``strict=False`` malformed documents are set aside in the run's table ``rejected_documents``
    instead of failing the load, with the path of their file, and ``load_outcome`` counts the good
    and bad documents of every file. ``contracts`` receives the NULL and type counts of the declared
    contracts while staging is written (``operators.quality.reports_from_metrics`` reads it)."""
    store = RunStore(spark, root)
    run = store.new_run()
    tables: dict[str, DataFrame] = {}
    if staging is not None:
        staged = spark.read.schema(RECEIPT).parquet(staging)
        if load is not None or contracts is not None:
            staged = store.write(_observed(staged, load, contracts), run, STAGING_TABLE)
    else:
        raw = read_receipts(spark, source_dir, layout, strict)
        if not strict:
            loaded = store.write(raw, run, "loaded_documents")
            good, bad = split_load(loaded)
            tables["rejected_documents"] = store.write(bad, run, "rejected_documents")
            tables["load_outcome"] = store.write(load_outcome(loaded), run, "load_outcome")
            raw = good
        staged = store.write(_observed(raw, load, contracts), run, STAGING_TABLE)
    models = ReceiptModels(staged, unique_reference=unique_reference, leavers=leavers, top_k=top_k)
    tables[STAGING_TABLE] = staged
    for name in STATE_NAMES:
        models.use(name, store.write(getattr(models, name), run, f"state_{name}"))
    for name in MODEL_NAMES:
        tables[name] = store.write(models.table(name), run, name, cluster_by=SERVED_BY.get(name))
        models.use(name, tables[name])
    store.commit(run)
    return run, tables


def run_pipeline(spark: SparkSession, source_dir: str, layout: str = "document",
                 prefix: str = "", num_buckets: int | None = None,
                 unique_reference: bool | None = None,
                 load: Observation | None = None) -> dict[str, DataFrame]:
    """Read every receipt file of ``source_dir`` (JSON and CSV), replace the staging table,
    and rebuild every model table. Returns the written tables, staging included.

    ``load`` (an ``Observation``) receives ``num_rows``, the number of receipts loaded, counted
    while the staging table is written: no second pass over the files or the table."""
    raw = read_receipts(spark, source_dir, layout)
    if load is not None:
        raw = raw.observe(load, F.count(F.lit(1)).alias("num_rows"))
    staged = stage_receipts(raw, table=prefix + STAGING_TABLE, num_buckets=num_buckets)
    models = ReceiptModels(staged, unique_reference=unique_reference)
    tables = {STAGING_TABLE: staged}
    tables.update(build_all(models, prefix, num_buckets=num_buckets))
    return tables
