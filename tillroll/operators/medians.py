"""Exact median of groups of any size by rank selection in two passes (A10).

``F.median`` keeps a map of a group's values in one task. Here the first pass sketches each group
in bounded space (``approx_percentile``, whose rank error is at most 1 / accuracy) and so brackets
the middle ranks; the second counts the rows below the bracket and the values inside it. Both are
partial aggregations, so a hot group is reduced in every map task; only the bracket's different
values, some thousandths of a group, are ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def exact_median(df: DataFrame, keys: list[str], value: str, name: str, accuracy: int = ACCURACY) -> DataFrame:
    """(keys, ``name``): the median of the non-NULL values of each group, as ``F.median`` gives it.

    A NULL key is a group; a group without values has a NULL median. NaN fails the job. The columns
    of the keys must not start with two underscores.
    """
    v = F.col(value).cast("double")
    checked = F.when(F.isnan(v), F.raise_error(F.lit(f"no median: NaN in {value}")).cast("double")).otherwise(v)
    rows = df.select(*keys, checked.alias("__v"))
    margin = 2.0 / accuracy
    groups = rows.groupBy(*keys).agg(
        F.count("__v").alias("__n"),
        F.percentile_approx("__v", [0.5 - margin, 0.5 + margin], accuracy).alias("__ends"))
    ends = groups.filter("__n > 0").select(*[F.col(k).alias(f"__{k}") for k in keys], "__n", "__ends")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    low, high = F.col("__ends")[0], F.col("__ends")[1]
    near = (rows.filter("__v is not null").join(ends, same).filter(F.col("__v") <= high)
            .groupBy(*keys, "__n", F.when(F.col("__v") >= low, F.col("__v")).alias("__at")).agg(F.count("*").alias("__c")))
    ordered = Window.partitionBy(*keys).orderBy(F.col("__at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = near.withColumn("__upto", F.sum("__c").over(ordered))

    def ranked(rank: str):
        r = F.expr(rank)
        return F.max(F.when((F.col("__upto") >= r) & (F.col("__upto") - F.col("__c") < r), F.col("__at")))

    middle = upto.groupBy(*keys).agg((0.5 * ranked("(__n + 1) div 2") + 0.5 * ranked("__n div 2 + 1")).alias("__m"))
    found = F.when(F.col("__m").isNull(), F.raise_error(F.lit(f"no median: the bracket of {value} misses the middle")).cast("double"))
    return (middle.select(*keys, found.otherwise(F.col("__m")).alias(name))
            .unionByName(groups.filter("__n = 0").select(*keys, F.lit(None).cast("double").alias(name))))
