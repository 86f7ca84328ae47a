"""Money by hand: more than two decimals, fractional and large quantities, values out of range."""

import pytest

from tests.edge_receipts import EDGE_RECEIPTS, write_documents
from tillroll.plans import ReceiptModels
from tillroll.sources import read_receipt_json


def _models(spark, folder, lines, promotions, unique):
    doc = {**EDGE_RECEIPTS[0], "Reference": "H1",
           "Products": [{"Cost": c, "Name": n, "Price": p, "Quantity": q} for n, c, p, q in lines],
           "Promotions": [{"Product": n, "Discount": d, "Per_Quantity": k} for n, d, k in promotions]}
    return ReceiptModels(read_receipt_json(spark, write_documents(folder, [doc])), unique_reference=unique)


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("lines, promotions, expected", [
    ([("a", 0.0, 100.0, 1)], [("a", 0.125, 1)], (0.0, 100.0, 87.5, 87.5)),
    ([("a", 1.5, 1.899, 40)], [], (60.0, 75.96, 75.96, 15.96)),
    ([("a", 1.0, 3.0, 1.5)], [], (1.5, 4.5, 4.5, 3.0)),
    ([("a", 1.0, 2.0, 1_000_000)], [("a", 0.5, 3)], (1e6, 2e6, 1e6, 0.0)),
    ([("a", 0.0, 1.0, 2.5)], [("a", 0.1, 2), ("a", 0.2, 3)], (0.0, 5.0, 4.75, 4.75)),
    ([("a", 0.0, 0.004, 1), ("b", 0.0, 0.004, 1)], [], (0.0, 0.01, 0.01, 0.01)),
])
def test_by_hand(spark, tmp_dir, lines, promotions, expected, unique):
    row = _models(spark, tmp_dir, lines, promotions, unique).sale_profits.first()
    assert tuple(row)[1:] == expected


def test_out_of_range_fails(spark, tmp_dir):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range"):
        _models(spark, tmp_dir, [("a", 1.0, 1e12, 1)], [], True).sale_profits.collect()


def test_ranking_goes_by_unrounded_sums(spark):
    from pyspark.sql import Row

    from tillroll.operators import loyalty
    rows = [Row(receipt_ref=str(i), customer_name=n, business_name="b", amount_spent=x)
            for i, (n, x) in enumerate([("a", 1.001), ("z", 1.004)])]
    totals = loyalty.customer_totals(spark.createDataFrame(rows))
    top = loyalty.top_customers_by_value(totals).orderBy("ranking").collect()
    assert [r.customer_name for r in top] == ["z", "a"] and [r.amount_spent for r in top] == [1.0, 1.0]


def test_dates_in_all_forms(spark):
    from pyspark.sql import functions as F

    from tillroll.functions import parse_receipt_date
    frame = spark.createDataFrame([("2022/07/02",), ("2022-07-02",), ("2022/7/2",), (None,)], "d string")
    got = [str(r[0]) for r in frame.select(parse_receipt_date(F.col("d"))).collect()]
    assert got == ["2022-07-02"] * 3 + ["None"]
    with pytest.raises(Exception, match="not a receipt date"):
        spark.createDataFrame([("02.07.2022",)], "d string").select(parse_receipt_date(F.col("d"))).collect()
