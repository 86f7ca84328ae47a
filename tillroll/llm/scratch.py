"""Lineage cuts: intermediate tables written to the shared checkpoint folder and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import scratch_path, ship_package

#: Bits of the fixed-size filter (2 MB), whatever the number of keys.
FILTER_BITS = 1 << 24
#: Bits of one row of Spark's bitmap functions.
_ROW_BITS = 32768


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: survives lost executors, cuts lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_bitmap(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """(part, bitmap) of the hashed keys: at most ``bits / 8`` bytes, built by partial aggregation."""
    slot = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    return (keys.select(slot.alias("slot"))
            .groupBy(F.bitmap_bucket_number("slot").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")))


def _flagged(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The frame with a column that says whether the key may be among ``keys``.

    The broadcast side is the bitmap, whose size is fixed by ``bits`` and not by the data.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    part, bitmap, position = "__filter_part", "__filter_bitmap", "__filter_position"
    byte = F.conv(F.hex(F.expr(f"substring({bitmap}, cast({position} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = byte.bitwiseAND(F.expr(f"cast(pow(2, {position} % 8) as int)")) > 0
    bitmaps = key_bitmap(keys, key, bits).toDF(part, bitmap)
    return (df.withColumns({part: F.bitmap_bucket_number(slot), position: F.bitmap_bit_position(slot)})
            .join(F.broadcast(bitmaps), part, "left")
            .withColumn("__maybe", F.coalesce(found, F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns], "__maybe"))


def probably_in(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose key may be among ``keys``: no false negatives, so a join after it stays exact."""
    return _flagged(df, column, keys, key, bits).filter("__maybe").drop("__maybe")


def parted(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is surely not among ``keys``, the rest). Only the rest needs a shuffle to
    be looked up exactly, so wide rows mostly stay where they are."""
    flagged = _flagged(df, column, keys, key, bits)
    return flagged.filter("not __maybe").drop("__maybe"), flagged.filter("__maybe").drop("__maybe")


def without(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The frame less the rows whose key is among ``keys`` (rows without a key stay)."""
    surely, rest = parted(df, column, keys, key)
    names = keys.select(F.col(key).alias("__gone"))
    return surely.unionByName(rest.join(names, rest[column] == names["__gone"], "left_anti"))


def row_key(id_col: str, text_col: str) -> Column:
    """16 bytes that rows share only if they have the same id and text (nulls count as values)."""
    parts = [F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(text_col).isNull().cast("string"), F.coalesce(F.col(text_col), F.lit(""))]
    return F.unhex(F.md5(F.concat(parts[0], F.lit(":"), parts[1], F.lit(":"), parts[2])))


#: Rows and bytes of an Arrow batch that goes to a Python worker, where the session has Spark's
#: defaults. Texts and sets are long values: batches of the default size cost each task several
#: hundred MB outside the heap.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
              "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b")}


def prepare(spark: SparkSession) -> None:
    """What the operators' Python workers need: the package, and batches of bounded size (texts
    are long rows, so Spark's default of 10,000 rows makes large ones)."""
    ship_package(spark)
    for key, (default, ours) in BATCH_CONF.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
