import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_SF, rows
from tests.edge_receipts import EDGE_RECEIPTS, write_documents
from tillroll.schemas import RECEIPT
from tillroll.sources import (drop_table, materialise, read_receipt_csv, read_receipt_json,
                              read_receipts, read_table, receipts_from_tables, stage_receipts,
                              staging_row_count, write_receipt_headers_csv, write_receipts_json)
from tillroll.sources.receipts import CORRUPT_COLUMN
from tillroll.sources.staging import reference_is_unique


def test_document_layout_uses_fixed_schema(spark, tmp_dir):
    df = read_receipt_json(spark, write_documents(tmp_dir))
    assert df.schema == RECEIPT
    r = df.filter("Reference = 'R1'").first()
    assert r.Promotions[0].Per_Quantity == 3 and r.Customer.Name == "Lisa"
    assert df.filter("Reference = 'R5'").first().Customer is None


def test_other_suffixes_are_ignored(spark, tmp_dir):
    write_documents(tmp_dir)
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as f:
        f.write("not a receipt")
    assert read_receipt_json(spark, tmp_dir).count() == len(EDGE_RECEIPTS)


def test_malformed_file_fails_strict_and_is_kept_permissive(spark, tmp_dir):
    write_documents(tmp_dir)
    with open(os.path.join(tmp_dir, "broken.json"), "w") as f:
        f.write('{"Reference": "X1", "Total": ')
    with pytest.raises(Exception):
        read_receipt_json(spark, tmp_dir).count()
    tolerant = read_receipt_json(spark, tmp_dir, strict=False).cache()
    assert tolerant.count() == len(EDGE_RECEIPTS) + 1
    assert tolerant.filter(F.col(CORRUPT_COLUMN).isNotNull()).count() == 1


def test_lines_layout_round_trip(spark, tmp_dir):
    stg = receipts_from_tables(spark, SMALL_SF)
    write_receipts_json(stg, tmp_dir + "/lines")
    back = read_receipt_json(spark, tmp_dir + "/lines", layout="lines")
    assert back.schema == RECEIPT
    assert rows(back.select("Reference", "Total", F.size("Products"))) == \
        rows(stg.select("Reference", "Total", F.size("Products")))


def test_csv_headers_and_union_with_json(spark, tmp_dir):
    docs = write_documents(tmp_dir + "/mixed")
    json_only = read_receipt_json(spark, docs)
    write_receipt_headers_csv(json_only.filter("Reference in ('R1', 'R2')")
                              .withColumn("Reference", F.concat(F.lit("C"), "Reference")),
                              tmp_dir + "/csv")
    for name in os.listdir(tmp_dir + "/csv"):
        if name.endswith(".csv"):
            os.rename(os.path.join(tmp_dir, "csv", name), os.path.join(docs, "h-" + name))
    csv = read_receipt_csv(spark, docs)
    assert csv.schema == RECEIPT
    got = {r.Reference: (r.Business.Name, r.Customer.Name, r.Products) for r in csv.collect()}
    assert got == {"CR1": ("Shop A", "Lisa", None), "CR2": ("Shop A", "Lisa", None)}
    both = read_receipts(spark, docs)
    assert both.count() == len(EDGE_RECEIPTS) + 2


def test_json_only_directory(spark, tmp_dir):
    assert read_receipts(spark, write_documents(tmp_dir)).count() == len(EDGE_RECEIPTS)


def test_staging_table_is_bucketed_and_counted(spark, tmp_dir):
    stg = read_receipt_json(spark, write_documents(tmp_dir))
    table = stage_receipts(stg, table="stg_edge", num_buckets=4)
    assert staging_row_count(table).first().num_rows == len(EDGE_RECEIPTS)
    detail = spark.sql("DESCRIBE TABLE EXTENDED stg_edge").collect()
    assert any(r.col_name == "Bucket Columns" and "Reference" in r.data_type for r in detail)
    assert reference_is_unique(table)
    # a second load replaces the table (full refresh)
    stage_receipts(stg.limit(3), table="stg_edge", num_buckets=4)
    assert spark.table("stg_edge").count() == 3
    drop_table(spark, "stg_edge")
    assert not spark.catalog.tableExists("stg_edge")


def test_materialise_and_read_back(spark, tmp_dir):
    stg = read_receipt_json(spark, write_documents(tmp_dir))
    from tillroll.operators import normalise

    materialise(normalise.receipts(stg), "receipts_edge")
    served = read_table(spark, "receipts_edge", ["receipt_ref", "receipt_total"],
                        order_by=["receipt_ref"])
    assert [r.receipt_ref for r in served.collect()] == [f"R{i}" for i in range(1, 9)]
    drop_table(spark, "receipts_edge")


def test_staging_writes_one_file_per_bucket(spark):
    stg = receipts_from_tables(spark, SMALL_SF).repartition(12)
    table = stage_receipts(stg, table="stg_files", num_buckets=3)
    location = spark.sql("DESCRIBE TABLE EXTENDED stg_files").filter(
        "col_name = 'Location'").first().data_type
    files = [f for f in os.listdir(location.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) <= 3
    assert table.count() == stg.count()
    drop_table(spark, "stg_files")
