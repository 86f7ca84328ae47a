"""Incremental ingest of receipt files with Structured Streaming.

The batch load replaces the staging table with every file of the receipt folder each day. With
immutable receipt files the same staging rows come from appending only the files that arrived
since the last run: a file stream with ``trigger(availableNow=True)`` reads exactly the new
files, JSON documents and CSV headers alike (its checkpoint remembers the ones already read),
appends them to a Parquet staging path through the exactly-once file sink, and stops. A lost
executor or a failed run is retried from the checkpoint without duplicating or losing files. Rows
are kept as a bag, like the batch load (no deduplication, so no unbounded streaming state).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import RECEIPT, RECEIPT_CSV
from tillroll.sources.csv_parts import CSV_OPTIONS, PART_SCHEMAS, assemble_receipts, part_path
from tillroll.sources.receipts import shape_csv


def receipt_stream(spark: SparkSession, source_dir: str, layout: str = "document",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the receipt files arriving in ``source_dir`` (fixed schemas)."""
    def reader(suffix: str):
        out = spark.readStream.option("pathGlobFilter", f"*.{suffix}").option("mode", "FAILFAST")
        return out.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else out

    documents = reader("json").schema(RECEIPT).option("multiLine", layout == "document").json(source_dir)
    headers = reader("csv").schema(RECEIPT_CSV).option("header", True).csv(source_dir)
    return documents.unionByName(shape_csv(headers))


def _staged_rows(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.schema(RECEIPT).parquet(path).count()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def ingest_new_receipts(spark: SparkSession, source_dir: str, staging_path: str,
                        checkpoint: str | None = None, layout: str = "document",
                        max_files_per_trigger: int | None = None) -> int:
    """Append the receipts of files not yet ingested to ``staging_path``; return how many.

    ``checkpoint`` defaults to a folder beside the staging path; it must survive between runs, as
    the staging path itself must. The count is that of the staged rows after the run less those
    before (Parquet footers only), whatever the number of micro-batches.
    """
    checkpoint = checkpoint or staging_path.rstrip("/") + "_checkpoint"
    before = _staged_rows(spark, staging_path)
    _append(receipt_stream(spark, source_dir, layout, max_files_per_trigger), staging_path, checkpoint)
    return _staged_rows(spark, staging_path) - before


def _append(stream: DataFrame, path: str, checkpoint: str) -> None:
    query = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start(path))
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc


def ingest_new_csv_parts(spark: SparkSession, source_dir: str, staging_path: str, checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None) -> None:
    """Append the rows of CSV files by kind that were not yet ingested to ``staging_path``, a folder
    per kind. Headers and lines may arrive in any order, in different runs: rows are staged as they
    come, without state, and :func:`staged_csv_receipts` assembles what is there. The folders of all
    kinds must exist in ``source_dir``."""
    checkpoint = checkpoint or staging_path.rstrip("/") + "_checkpoint"
    for kind, schema in PART_SCHEMAS.items():
        reader = (spark.readStream.options(**CSV_OPTIONS).option("mode", "FAILFAST").option("pathGlobFilter", "*.csv"))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        _append(reader.schema(schema).csv(part_path(source_dir, kind)), part_path(staging_path, kind), part_path(checkpoint, kind))


def staged_csv_receipts(spark: SparkSession, staging_path: str, strict: bool = False) -> DataFrame:
    """The receipts of all ingested headers, each with the lines that have arrived. Unless ``strict``,
    lines wait for their header."""
    return assemble_receipts({kind: spark.read.schema(schema).parquet(part_path(staging_path, kind))
                              for kind, schema in PART_SCHEMAS.items()}, strict)
