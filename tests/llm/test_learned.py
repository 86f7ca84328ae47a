import glob

import pytest
from pyspark.sql import functions as F

from tillroll.llm import langid, queries, quality
from tillroll.llm.oracle import oracle_sql

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not glob.glob(SF), reason="needs the given tables")


def test_held_out_language_accuracy(spark):
    got = queries.op1_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    n, right, low, high = got.filter("held_out").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")),
                                                    F.min("score"), F.max("score")).first()
    assert n > 200 and right >= 0.99 * n and 0 <= low <= high <= 1


def test_language_ignores_other_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    train = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("source", F.lit("?")).withColumn("lang", F.lit(None).cast("string"))
    both = [dict(langid.identify_languages(train.unionByName(d.withColumn("doc_id", F.col("doc_id") + 10 ** 6)),
                                           F.col("doc_id") < 10 ** 6).filter("doc_id >= 1000000").select("doc_id", "lang_pred").collect())
            for d in (docs, changed)]
    assert both[0] == both[1]


def test_held_out_quality(spark):
    got = queries.op4_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert n > 40 and right >= 0.97 * n


def test_attention_finds_the_bad_passage():
    import numpy as np
    from tillroll.llm import bytesets as bs
    import pyarrow as pa
    clean = "some calm words make a plain sentence here. " * 16
    noise = "@@## $$%% ^^&& ~~** ##@@ " * 26
    texts = [clean * 3 if k % 2 else clean + noise + clean for k in range(120)]
    offsets, data = bs.string_buffers(pa.array(texts))
    codes, counts = quality.encode_passages(offsets, data, 0, len(texts), 64)
    bags = np.split(codes, np.cumsum(counts)[:-1])
    model = quality.fit(bags, np.array([k % 2 for k in range(120)]))
    weight, score = model.attention(codes, counts)
    assert (score[1::2] > 0.9).all() and (score[0::2] < 0.1).all()
    first = np.split(weight, np.cumsum(counts)[:-1])[0]
    symbols = np.split(codes[:, 6], np.cumsum(counts)[:-1])[0]
    assert symbols[first.argmax()] > 0.3
    np.testing.assert_allclose(first.sum(), 1)


def test_quality_without_labels(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.score_quality(make([(1, "x y")]), none).collect()] == [0.5]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    small = "/root/testdata/sf0.001"
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    want = con.sql(oracle_sql()[name])
    columns = sorted(want.columns)
    got = queries.queries()[name](spark, small)
    assert sorted(got.columns) == columns
    order = lambda rows: sorted(map(repr, rows))
    assert order(tuple(r) for r in got.select(columns).collect()) == order(want.select(*columns).fetchall())
