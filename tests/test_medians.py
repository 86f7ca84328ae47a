"""The median by rank selection against ``F.median``."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.operators.medians import exact_median


def _same(df, keys, **more):
    want = df.groupBy(*keys).agg(F.median("v").alias("m"))
    got = exact_median(df, keys, "v", "m", **more)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


@pytest.mark.parametrize("seed", range(3))
def test_random_groups(spark, seed):
    deal = random.Random(seed)
    values = [lambda: deal.gauss(0, 1e3), lambda: float(deal.randrange(3)), lambda: None, lambda: deal.choice([1e300, -1e300, 0.0]),
              lambda: deal.lognormvariate(0, 9), lambda: 7.25]
    data = [(f"g{g}" if g % 5 else None, g % 2, values[g % 6]() if deal.random() < 0.9 else None)
            for g in range(12) for _ in range(deal.choice([1, 2, 3, 400]))]
    df = spark.createDataFrame(data, "k string, j int, v double").repartition(5)
    _same(df, ["k", "j"])
    _same(df, ["k"], accuracy=20)


def test_a_hot_group_with_a_coarse_sketch(spark):
    """A group of 300,000 rows, nearly all values different, beside small ones; the bracket holds few of them."""
    df = spark.range(300_000).select(F.lit("hot").alias("k"), (F.xxhash64("id") / 1e9).alias("v")).unionByName(
        spark.range(30).select(F.concat(F.lit("k"), F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v")))
    _same(df, ["k"], accuracy=200)
    _same(df, ["k"])


def test_empty_and_nan(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_median(empty, ["k"], "v", "m").collect() == []
    with pytest.raises(Exception, match="no median: NaN in v"):
        exact_median(spark.createDataFrame([("a", 1.0), ("a", float("nan"))], "k string, v double"), ["k"], "v", "m").collect()


def test_no_task_holds_a_groups_values(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = exact_median(df, ["k"], "v", "m")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "median(" not in plan and "percentile(" not in plan
