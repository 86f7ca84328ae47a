"""Staging and model tables: full-refresh writes, reads, counts, drops.

Tables are Parquet in the session catalog (``spark.sql.warehouse.dir`` on shared storage on a
cluster). The daily job writes run folders instead (``tillroll.sources.runs``).

Staging is written as it is read, without a shuffle: after the explode all lines of a receipt are
in one task, so an aggregation by receipt only moves one small row per receipt, while bucketing
the documents by ``Reference`` would move all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGING_TABLE = "stg_receipts"
STAGING_KEY = "Reference"
# References (of some ten bytes each) that one broadcast may hold.
MAX_BROADCAST_KEYS = 1_000_000


def stage_receipts(df: DataFrame, table: str = STAGING_TABLE, num_buckets: int | None = None
                   ) -> DataFrame:
    """Replace the staging table with ``df`` (full refresh) and return the table.

    With ``num_buckets`` the table is bucketed by Reference, for users who join it again and
    again: the rows are first rebalanced by Reference into that many partitions, so each write
    task writes one bucket (without it every input task writes a file per bucket).
    """
    spark = df.sparkSession
    writer = df.hint("rebalance", num_buckets, STAGING_KEY) if num_buckets else df
    writer = writer.write.mode("overwrite").format("parquet")
    if num_buckets:
        writer = writer.bucketBy(num_buckets, STAGING_KEY)
    writer.saveAsTable(table)
    return spark.table(table)


def staging_row_count(df: DataFrame) -> DataFrame:
    """Number of staged rows, as a one-row DataFrame (the load check)."""
    return df.agg(F.count(F.lit(1)).alias("num_rows"))


def materialise(df: DataFrame, table: str, bucket_by: str | None = None,
                num_buckets: int | None = None, partition_by: list[str] | None = None
                ) -> DataFrame:
    """Write one model as a table (full refresh) and return the table. With ``bucket_by`` the
    rows are rebalanced by that column first (one file per bucket, see ``stage_receipts``)."""
    n = None
    if bucket_by:
        n = num_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.hint("rebalance", n, bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(n, bucket_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def read_table(spark: SparkSession, table: str, columns: list[str] | None = None,
               order_by: list | None = None, where=None) -> DataFrame:
    """Serve a finished table, optionally with a filter (pushed down to the files, for example
    one business), a column list and a presentation order."""
    df = spark.table(table)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    if order_by:
        df = df.orderBy(*order_by)
    return df


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def reference_conflicts(stg: DataFrame) -> DataFrame:
    """References that appear on more than one staging row, with their count. (Rows without
    Reference join nothing and need no check.)

    An aggregation over the Reference column alone, which is all that it shuffles (nothing, on a
    table bucketed by Reference).
    """
    counts = stg.groupBy(STAGING_KEY).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") > 1) & F.col(STAGING_KEY).isNotNull())


def split_by_conflict(stg: DataFrame, conflicts: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose Reference no other row has, or that have none; rows whose Reference repeats), by
    the ``n`` References of ``conflicts`` (as :func:`reference_conflicts` gives them).

    Up to ``MAX_BROADCAST_KEYS`` of them are sent to every task, so the wide rows are filtered where
    they are read; more are joined."""
    keys = conflicts.select(F.col(STAGING_KEY).alias("_repeated"))
    keys = F.broadcast(keys) if n <= MAX_BROADCAST_KEYS else keys
    same = stg[STAGING_KEY] == keys["_repeated"]
    return stg.join(keys, same, "left_anti"), stg.join(keys, same, "left_semi")


def reference_is_unique(stg: DataFrame) -> bool:
    """True when no two staging rows share a Reference; only a boolean reaches the driver."""
    return reference_conflicts(stg).isEmpty()
