"""Daily runs as folders under one root, with an append-only list of the finished ones.

A run writes its tables to a folder of its own and is then committed by one small file that names
it; readers take the latest committed run. So a run can be repeated in any session without a
shared catalog, a failed or killed run changes nothing for readers, and the tables that a reader
sees all come from the same run. Folders of earlier runs stay until someone removes them.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class RunStore:
    """Tables by run under ``root`` (any path that Spark can write and all executors share)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def new_run(self) -> str:
        """An id that sorts after those of earlier runs."""
        seconds, rest = divmod(time.time_ns(), 10 ** 9)
        return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime(seconds))}-{rest:09d}-{uuid.uuid4().hex[:8]}"

    def path(self, run: str, table: str) -> str:
        return f"{self.root}/runs/{run}/{table}"

    def write(self, df: DataFrame, run: str, table: str, cluster_by: list[str] | None = None) -> DataFrame:
        """Write one table of a run and return it re-read. Without ``cluster_by`` no shuffle is
        added; with it rows are dealt into ranges of these columns and sorted, so that a reader of one
        business reads few files and row groups. Name columns that tell a hot business's rows apart
        too (its months, say): its range then falls into several files."""
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        df.write.mode("error").parquet(self.path(run, table))
        return self.spark.read.schema(df.schema).parquet(self.path(run, table))

    def commit(self, run: str) -> None:
        """Make a finished run the current one: one new file, nothing is replaced."""
        (self.spark.createDataFrame([(run,)], "run string").coalesce(1)
         .write.mode("error").text(f"{self.root}/commits/{run}"))

    def current(self) -> str | None:
        """The latest committed run, or None."""
        try:
            runs = self.spark.read.text(f"{self.root}/commits/*")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return runs.selectExpr("max(value)").first()[0]

    def table(self, name: str, columns: list[str] | None = None, where=None,
              order_by: list | None = None) -> DataFrame:
        """A table of the current run, optionally with a column list, a filter (pushed down to
        the files) and a presentation order."""
        run = self.current()
        if run is None:
            raise LookupError(f"no finished run under {self.root}")
        df = self.spark.read.parquet(self.path(run, name))
        df = df.filter(where) if where is not None else df
        df = df.select(*columns) if columns else df
        return df.orderBy(*order_by) if order_by else df


class LoadStore(RunStore):
    """Tables by load (a day, say), each written by a run of its own: ``table/load=.../run=...``.

    A load that is delivered again gets a new run, whose commit replaces the former one for readers.
    The driver holds one short line per committed run.
    """

    def new_load(self, load: str) -> tuple[str, str]:
        if not re.fullmatch(r"[\w.-]+", load):
            raise ValueError(f"a load is named by letters, digits, '_', '.' and '-', not {load!r}")
        return load, self.new_run()

    def path(self, run: tuple[str, str], table: str) -> str:
        return f"{self.root}/{table}/load={run[0]}/run={run[1]}"

    def commit(self, run: tuple[str, str]) -> None:
        (self.spark.createDataFrame([("\t".join(run),)], "run string").coalesce(1)
         .write.mode("error").text(f"{self.root}/commits/{run[1]}"))

    def current(self) -> dict[str, str]:
        """The latest committed run of every load."""
        try:
            lines = self.spark.read.text(f"{self.root}/commits/*").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {load: run for run, load in sorted(line.value.split("\t")[::-1] for line in lines)}

    def loads(self, table: str, schema: T.StructType, runs: dict[str, str]) -> DataFrame:
        """A table's rows of the given runs, with their ``load``."""
        columns = T.StructType([*schema, T.StructField("load", T.StringType()), T.StructField("run", T.StringType())])
        paths = [self.path(run, table) for run in runs.items()]
        if not paths:
            return self.spark.createDataFrame([], columns).drop("run")
        return self.spark.read.schema(columns).option("basePath", f"{self.root}/{table}").parquet(*paths).drop("run")
