import os

from tests.edge_receipts import EDGE_RECEIPTS, write_documents
from tillroll.plans import ReceiptModels
from tillroll.streaming import ingest_new_receipts


def test_incremental_ingest_reads_each_file_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    out = os.path.join(tmp_dir, "stg")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write_documents(src, EDGE_RECEIPTS[:5])
    assert ingest_new_receipts(spark, src, out, ckpt) == 5
    write_documents(src, EDGE_RECEIPTS[5:])  # rewrites nothing old: new names only
    for i, doc in enumerate(EDGE_RECEIPTS[:5]):
        os.remove(os.path.join(src, f"{doc['Reference']}-{i}.json"))
    assert ingest_new_receipts(spark, src, out, ckpt) == 3
    assert ingest_new_receipts(spark, src, out, ckpt) == 0
    staged = spark.read.parquet(out)
    assert staged.count() == 8
    assert ReceiptModels(staged).sale_profits.count() == 7


def test_incremental_ingest_of_json_lines(spark, tmp_dir):
    from tests.conftest import SMALL_SF
    from tillroll.sources import receipts_from_tables, write_receipts_json

    src = os.path.join(tmp_dir, "lines")
    write_receipts_json(receipts_from_tables(spark, SMALL_SF), src)
    out = os.path.join(tmp_dir, "stg")
    n = ingest_new_receipts(spark, src, out, os.path.join(tmp_dir, "ckpt"), layout="lines")
    assert n == spark.read.parquet(out).count() == 1500


def test_count_covers_more_batches_than_spark_remembers(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "stg")
    docs = [{**EDGE_RECEIPTS[0], "Reference": f"M{i}"} for i in range(112)]
    write_documents(src, docs)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        assert ingest_new_receipts(spark, src, out, max_files_per_trigger=10) == 112
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert spark.read.parquet(out).count() == 112


def test_ingest_stages_the_rows_of_the_batch_load(spark, tmp_dir):
    from tests.conftest import rows
    from tillroll.sources import read_receipts

    src, out = write_documents(os.path.join(tmp_dir, "in")), os.path.join(tmp_dir, "stg")
    header = "Reference,Sequence,Terminal,Date,Total,GST,Cashier,Business_ABN,Business_Name,Customer_Name,Customer_Points"
    with open(os.path.join(src, "flat.csv"), "w") as f:
        f.write(header + "\nCR1,1,1,2022/07/02,5.0,0.5,Ann,1,Shop A,Lisa,3\n")
    assert ingest_new_receipts(spark, src, out) == len(EDGE_RECEIPTS) + 1
    assert rows(spark.read.parquet(out)) == rows(read_receipts(spark, src))
