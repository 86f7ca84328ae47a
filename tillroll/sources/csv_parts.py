"""Receipts delivered as four kinds of CSV files: headers, payments, products and promotions (S2).

A delivery is a folder with one sub-folder of ``*.csv`` files (header line required) per kind. A
line names its receipt by ``Reference`` and its place in the receipt's list by ``Line``.
:func:`assemble_receipts` builds the nested documents from them: all kinds are tagged rows of one
relation, aggregated once by Reference, so a delivery is shuffled once and nothing is joined. Lists
are the size of one receipt, as in the document itself.

Defined results:

* A line that is delivered again (same receipt, kind, place and values) is one line, so a folder
  delivered twice gives every header twice, each with its own lines, as two copies of a document do.
* A header without lines has empty lists.
* Different lines at one place fail the load, with the Reference in the message.
* A line without Reference, or whose header is missing, fails a ``strict`` load; else it is left out
  (:func:`orphan_lines` returns such lines).
* An empty text is NULL, as CSV doesn't tell them apart.
* Headers without Reference stay, with empty lists; they don't pass through the aggregation, so
  many of them are no hot group.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import PAYMENT, PRODUCT, PROMOTION, RECEIPT, RECEIPT_CSV
from tillroll.sources.receipts import flat_headers, shape_csv

LINE_KINDS = {"Payments": PAYMENT, "Products": PRODUCT, "Promotions": PROMOTION}
_KEY = [T.StructField("Reference", T.StringType()), T.StructField("Line", T.LongType())]
PART_SCHEMAS = {"Headers": RECEIPT_CSV} | {kind: T.StructType(_KEY + line.fields) for kind, line in LINE_KINDS.items()}
# Texts as they are: quotes doubled, blanks at the ends kept.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def part_path(path: str, kind: str) -> str:
    return f"{path.rstrip('/')}/{kind.lower()}"


def read_csv_parts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The delivered rows by kind. A kind of line without a folder has no rows."""
    parts = {}
    for kind, schema in PART_SCHEMAS.items():
        reader = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").option("pathGlobFilter", "*.csv")
        try:
            parts[kind] = reader.schema(schema).csv(part_path(path, kind))
        except AnalysisException as missing:
            if kind == "Headers" or missing.getCondition() != "PATH_NOT_FOUND":
                raise
            parts[kind] = spark.createDataFrame([], schema)
    return parts


def _tagged(parts: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """All rows that have a Reference: (Reference, Header or the place and values of one line). A line
    without one fails if ``strict``, else it is left out."""
    columns = {"Header": shape_csv(parts["Headers"]).select("Reference", F.struct(*RECEIPT.fieldNames()).alias("Header"))}
    for kind, line in LINE_KINDS.items():
        rows = parts[kind].withColumn("Reference", _reference_or_fails(kind)) if strict else parts[kind]
        columns[kind] = rows.select("Reference", F.struct("Line", *line.fieldNames()).alias(kind))
    first, *others = columns.values()
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first.filter(F.col("Reference").isNotNull())


def _list(kind: str):
    """The lines of one receipt in order; a place taken twice fails."""
    lines = F.array_sort(F.transform(F.filter("_lines", lambda x: x[kind].isNotNull()), lambda x: x[kind]))
    places = F.transform(lines, lambda x: x["Line"])
    checked = F.when(F.size(F.array_distinct(places)) == F.size(places), lines).otherwise(F.raise_error(F.concat(
        F.lit(f"different {kind} at one line of receipt "), F.col("Reference"))))
    return F.transform(checked, lambda x: F.struct(*[x[f.name].alias(f.name) for f in LINE_KINDS[kind]])).alias(kind)


def assemble_receipts(parts: dict[str, DataFrame], strict: bool = True) -> DataFrame:
    """Receipt documents from the rows by kind (as :func:`read_csv_parts` returns them)."""
    # One set for the lines of all kinds: every set more is one more object per receipt in each task.
    line = F.when(F.col("Header").isNull(), F.struct(*LINE_KINDS))
    grouped = (_tagged(parts, strict).groupBy("Reference").agg(F.collect_list("Header").alias("_headers"), F.collect_set(line).alias("_lines"))
               .select("Reference", "_headers", *map(_list, LINE_KINDS)))
    if strict:
        grouped = grouped.withColumn("_headers", F.when(F.size("_headers") > 0, F.col("_headers")).otherwise(
            F.raise_error(F.concat(F.lit("lines without a header: receipt "), F.col("Reference")))))
    document = [F.col(f.name if f.name in LINE_KINDS else f"_header.{f.name}").cast(f.dataType).alias(f.name) for f in RECEIPT]
    known = grouped.select(F.explode("_headers").alias("_header"), *LINE_KINDS).select(*document)
    nameless = shape_csv(parts["Headers"]).filter(F.col("Reference").isNull()).select(
        *[F.array().cast(f.dataType).alias(f.name) if f.name in LINE_KINDS else F.col(f.name) for f in RECEIPT])
    return known.unionByName(nameless)


def _reference_or_fails(kind: str):
    """A line's Reference; the load fails without one."""
    return F.when(F.col("Reference").isNotNull(), F.col("Reference")).otherwise(F.raise_error(F.concat(
        F.lit(f"{kind} without a Reference, line "), F.coalesce(F.col("Line").cast("string"), F.lit("?")))))


def orphan_lines(parts: dict[str, DataFrame]) -> DataFrame:
    """(kind, Reference, Line) of the lines that belong to no header. One aggregation by Reference; lines
    without Reference don't pass through it."""
    kinds = list(LINE_KINDS)
    nameless = [parts[k].filter(F.col("Reference").isNull()).select(F.lit(k).alias("kind"), "Reference", "Line") for k in kinds]
    def placed(kind: str):
        return F.transform(F.collect_list(kind), lambda x: F.struct(F.lit(kind).alias("kind"), x["Line"].alias("Line")))

    lost = (_tagged(parts).groupBy("Reference").agg(F.count("Header").alias("_headers"), F.concat(*map(placed, kinds)).alias("_lines"))
            .filter("_headers = 0").select("Reference", F.explode("_lines").alias("_line"))
            .select("_line.kind", "Reference", "_line.Line"))
    for rows in nameless:
        lost = lost.unionByName(rows)
    return lost


def read_receipt_csv_parts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The receipts of a folder of CSV files by kind."""
    return assemble_receipts(read_csv_parts(spark, path), strict)


def write_receipt_csv_parts(receipts: DataFrame, path: str) -> None:
    """Write receipts as CSV files by kind, full refresh. Lines of a receipt without Reference are
    written without one, so only a load that isn't strict reads them back, and leaves them out."""
    flat_headers(receipts).write.mode("overwrite").options(**CSV_OPTIONS).csv(part_path(path, "Headers"))
    for kind, line in LINE_KINDS.items():
        lines = receipts.select("Reference", F.posexplode(kind).alias("_at", "_line")).select(
            "Reference", (F.col("_at") + 1).alias("Line"), *[F.col(f"_line.{f.name}") for f in line])
        lines.write.mode("overwrite").options(**CSV_OPTIONS).csv(part_path(path, kind))
