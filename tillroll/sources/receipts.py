"""Receipt readers: JSON documents and flat CSV headers, always with the fixed schema.

Layouts:

* ``document``: one pretty-printed JSON object per file, as a till exports it. Such a file
  cannot be split, so each file is one task input; many small files are packed into one
  partition by ``spark.sql.files.maxPartitionBytes`` / ``openCostInBytes``.
* ``lines``: JSON Lines, one receipt per line. Splittable; the layout to compact into.

Any Hadoop URI works as ``path``. Only files matching the suffix are read, without recursion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import CUSTOMER, RECEIPT, RECEIPT_CSV

CORRUPT_COLUMN, PATH_COLUMN = "_corrupt_record", "_file_path"


def read_receipt_json(spark: SparkSession, path: str, layout: str = "document",
                      strict: bool = True) -> DataFrame:
    """Read receipts from ``*.json`` files.

    ``strict`` fails the whole load on a malformed file, as a batch reload should. With
    ``strict=False`` malformed documents are kept as rows whose ``_corrupt_record`` holds the
    text, and every row carries its file's path in ``_file_path``, so that bad files can be counted,
    named and set aside (:func:`split_load`, :func:`load_outcome`).
    """
    if layout not in ("document", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    schema = RECEIPT
    reader = (spark.read.option("multiLine", layout == "document")
              .option("pathGlobFilter", "*.json")
              .option("recursiveFileLookup", "false"))
    if strict:
        reader = reader.option("mode", "FAILFAST")
    else:
        schema = T.StructType(RECEIPT.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = (reader.option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    read = reader.schema(schema).json(path)
    return read if strict else read.select("*", F.col("_metadata.file_path").alias(PATH_COLUMN))


def split_load(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(receipts, rejected documents: file path and text) of a tolerant load."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return loaded.filter(~bad).drop(CORRUPT_COLUMN, PATH_COLUMN), loaded.filter(bad).select(PATH_COLUMN, CORRUPT_COLUMN)


def load_outcome(loaded: DataFrame) -> DataFrame:
    """(_file_path, num_good, num_bad): what became of every file's documents in a tolerant load."""
    return loaded.groupBy(PATH_COLUMN).agg(F.count_if(F.col(CORRUPT_COLUMN).isNull()).alias("num_good"),
                                           F.count(CORRUPT_COLUMN).alias("num_bad"))


def read_receipt_csv(spark: SparkSession, path: str, with_path: bool = False) -> DataFrame:
    """Read flat receipt headers from ``*.csv`` files (header line required) into the
    receipt shape. Line-item lists are NULL, which every explode treats as empty."""
    flat = (spark.read.option("header", True).option("mode", "FAILFAST")
            .option("pathGlobFilter", "*.csv").schema(RECEIPT_CSV).csv(path))
    if not with_path:
        return shape_csv(flat)
    flat = flat.select("*", F.col("_metadata.file_path").alias(PATH_COLUMN))
    return shape_csv(flat, PATH_COLUMN)


def shape_csv(flat: DataFrame, *more: str) -> DataFrame:
    """Flat header rows, of a batch or a stream, in the receipt shape (``more``: further columns to keep)."""
    customer = F.when(F.col("Customer_Name").isNotNull() | F.col("Customer_Points").isNotNull(),
                      F.struct(F.col("Customer_Name").alias("Name"),
                               F.col("Customer_Points").alias("Points_Earnt")))
    business = F.when(F.col("Business_ABN").isNotNull() | F.col("Business_Name").isNotNull(),
                      F.struct(F.col("Business_ABN").alias("ABN"),
                               F.col("Business_Name").alias("Name")))
    shaped = flat.select(
        business.alias("Business"), "Cashier", customer.cast(CUSTOMER).alias("Customer"), "Date",
        "GST", "Reference", "Sequence", "Terminal", "Total", *more)
    return shaped.select(*[F.col(f.name) if f.name in shaped.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in RECEIPT], *more)


def read_receipts(spark: SparkSession, path: str, layout: str = "document", strict: bool = True) -> DataFrame:
    """All receipts of a directory: JSON documents plus CSV headers, as one bag. A suffix with
    no file simply contributes no row (the schemas are fixed, nothing is inferred). ``strict`` as
    in :func:`read_receipt_json`."""
    return read_receipt_json(spark, path, layout, strict).unionByName(
        read_receipt_csv(spark, path, with_path=not strict), allowMissingColumns=True)


def write_receipts_json(df: DataFrame, path: str) -> None:
    """Write receipts as JSON Lines (the splittable ``lines`` layout), full refresh."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def flat_headers(df: DataFrame) -> DataFrame:
    """The flat header of each receipt, as CSV files carry it."""
    return df.select(
        "Reference", "Sequence", "Terminal", "Date", "Total", "GST", "Cashier",
        F.col("Business.ABN").alias("Business_ABN"), F.col("Business.Name").alias("Business_Name"),
        F.col("Customer.Name").alias("Customer_Name"),
        F.col("Customer.Points_Earnt").alias("Customer_Points"))


def write_receipt_headers_csv(df: DataFrame, path: str) -> None:
    """Write the flat header of each receipt as CSV with a header line (no line items)."""
    flat_headers(df).write.mode("overwrite").option("header", True).csv(path)
