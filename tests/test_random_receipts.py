"""Randomised receipts against a brute-force Python rendering of the model semantics.

The generator favours the hard cases: a product repeated within a receipt, several promotions
for one product (fan-out), zero and negative per_quantity, empty lists, absent or NULL
customers, zero totals, and (in one variant) the same Reference delivered more than once.
"""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.edge_receipts import write_documents
from tillroll.plans import ReceiptModels
from tillroll.sources import read_receipt_json

CENT = Decimal("0.01")
NAMES = ["Latte", "Mocha", "Scone", "Cut", "Lesson"]
CASHIERS = ["Ann", "Bob", "Cy", "Di"]
CUSTOMERS = ["Lisa", "Scott", "Anna", "Ravi"]


def _money(x):
    return Decimal(str(x)).quantize(CENT)


def generate(seed, n=150, duplicates=False, hot=False):
    """``hot``: one business holds nine receipts in ten and one customer a third of all."""
    rnd = random.Random(seed)
    docs = []
    for i in range(n):
        products = [{"Cost": round(rnd.uniform(0.5, 9), 2), "Name": rnd.choice(NAMES),
                     "Price": round(rnd.uniform(1, 20), 2), "Quantity": rnd.randint(0, 6)}
                    for _ in range(rnd.choice([0, 1, 1, 2, 3, 4]))]
        promotions = [{"Product": rnd.choice(NAMES),
                       "Discount": rnd.choice([0, 0.05, 0.1, 0.25, 0.5]),
                       "Per_Quantity": rnd.choice([0, 1, 2, 3, 5, -2])}
                      for _ in range(rnd.choice([0, 0, 1, 2, 3]))]
        total = rnd.choice([0.0, round(rnd.uniform(1, 200), 2)])
        business = ("Shop A" if hot and rnd.random() < 0.9 else rnd.choice(["Shop A", "Shop B"]))
        doc = {"Business": {"ABN": "9", "Name": business},
               "Cashier": rnd.choice(CASHIERS),
               "Date": f"{rnd.choice([2022, 2023])}/{rnd.randint(1, 12):02d}/{rnd.randint(1, 28):02d}",
               "GST": round(total / 11, 2),
               "Payments": [{"Amount": total, "Method": "Card"}],
               "Products": products, "Promotions": promotions,
               "Reference": None if rnd.random() < 0.05 else f"T{i}", "Sequence": i,
               "Terminal": 1, "Total": total}
        c = rnd.random()
        if hot and i % 3 == 0:
            doc["Customer"] = {"Name": "Lisa", "Points_Earnt": 1}
        elif c < 0.6:
            doc["Customer"] = {"Name": rnd.choice(CUSTOMERS), "Points_Earnt": 1}
        elif c < 0.7:
            doc["Customer"] = {"Name": None, "Points_Earnt": 1}
        elif c < 0.85:
            doc["Customer"] = None
        docs.append(doc)
    if duplicates:
        docs += [dict(d) for d in rnd.sample(docs, n // 10)]
    return docs


def brute_sale_profits(docs):
    """Left join of every product line with the promotions of the same Reference and product
    name (all documents of that Reference; a NULL Reference matches nothing), summed per
    Reference (the NULL ones form one group)."""
    promos = defaultdict(list)
    for d in docs:
        for p in d["Promotions"]:
            if d["Reference"] is not None:
                promos[(d["Reference"], p["Product"])].append(p)
    sums = {}
    for d in docs:
        for p in d["Products"]:
            qty = Decimal(p["Quantity"])
            cost = _money(p["Cost"]) * qty
            price = _money(p["Price"]) * qty
            rows = promos.get((d["Reference"], p["Name"])) or [None]
            for m in rows:
                after = price
                if m is not None and m["Per_Quantity"] != 0:
                    n = m["Per_Quantity"]
                    if (p["Quantity"] // n) * n > 0:
                        after = price * (Decimal("1.00") - _money(m["Discount"]))
                s = sums.setdefault(d["Reference"], [Decimal(0)] * 4)
                for k, v in enumerate([cost, price, after, after - cost]):
                    s[k] += v
    return {ref: tuple(float(v.quantize(CENT, ROUND_HALF_UP)) for v in s)
            for ref, s in sums.items()}


def brute_top_customers(docs, k=10):
    agg = defaultdict(lambda: [Decimal(0), 0])
    for d in docs:
        if d.get("Customer") is not None and d["Business"] is not None and d["Total"] > 0:
            a = agg[(d["Business"]["Name"], d["Customer"]["Name"])]
            a[0] += _money(d["Total"])
            a[1] += d["Reference"] is not None  # purchases count receipt references
    out = {}
    for biz in {b for b, _ in agg}:
        rows = [(c, v[0], v[1]) for (b, c), v in agg.items() if b == biz]
        rows.sort(key=lambda r: (-r[1], -r[2], r[0] is None, r[0] or ""))
        for rank, (c, amount, n) in enumerate(rows[:k], start=1):
            out[(biz, rank)] = (c, float(amount), n)
    return out


@pytest.mark.parametrize("seed,duplicates,hot", [(1, False, False), (2, False, False),
                                                 (3, True, False), (4, False, True)])
def test_random_receipts_match_brute_force(spark, tmp_dir, seed, duplicates, hot):
    docs = generate(seed, n=300 if hot else 150, duplicates=duplicates, hot=hot)
    stg = read_receipt_json(spark, write_documents(tmp_dir, docs, indent=None))
    m = ReceiptModels(stg)
    assert m.receipt_local is (not duplicates)
    got = {r.receipt_ref: (r.total_cost, r.total_price, r.total_price_after_discount,
                           r.total_profit) for r in m.sale_profits.collect()}
    assert got == brute_sale_profits(docs)
    top = {(r.business_name, r.ranking): (r.customer_name, r.amount_spent, r.num_purchases)
           for r in m.top_ten_customers_by_business_value.collect()}
    assert top == brute_top_customers(docs)
    if not duplicates:
        joined = ReceiptModels(stg, unique_reference=False)
        for name in ["business_sales_profits", "products", "sales_details", "business_employees"]:
            a = sorted(map(tuple, m.table(name).collect()), key=str)
            b = sorted(map(tuple, joined.table(name).collect()), key=str)
            assert a == b, name


def test_many_copies_of_one_receipt(spark, tmp_dir):
    # One receipt delivered 30 times (a "group of copies"), with a repeated product and two
    # promotions for it: the left-join sums grow with the square of the copies.
    base = generate(7, n=5)
    hot = dict(base[0], Reference="HOT",
               Products=[{"Cost": 2.5, "Name": "Latte", "Price": 4.0, "Quantity": 3},
                         {"Cost": 2.5, "Name": "Latte", "Price": 4.0, "Quantity": 1}],
               Promotions=[{"Product": "Latte", "Discount": 0.1, "Per_Quantity": 2},
                           {"Product": "Latte", "Discount": 0.25, "Per_Quantity": -2}])
    docs = base + [dict(hot) for _ in range(30)]
    stg = read_receipt_json(spark, write_documents(tmp_dir, docs, indent=None))
    m = ReceiptModels(stg)
    assert m.receipt_local is False
    got = {r.receipt_ref: (r.total_cost, r.total_price, r.total_price_after_discount,
                           r.total_profit) for r in m.sale_profits.collect()}
    assert got == brute_sale_profits(docs)
    # cost 2.5 x (3 + 1) units per copy, 30 copies, each line counted once per promotion
    # of all copies (30 x 2)
    assert got["HOT"][0] == 2.5 * (3 + 1) * 30 * 60


def test_monthly_profit_by_counts_equals_sum_over_pairs(spark, tmp_dir):
    from tillroll.operators import profit

    base = generate(8, n=60, duplicates=True)
    docs = base + [dict(base[1]) for _ in range(12)]
    stg = read_receipt_json(spark, write_documents(tmp_dir, docs, indent=None))
    m = ReceiptModels(stg)
    assert m.receipt_local is False
    by_pairs = profit.business_monthly_profits(m.business_sales_profits)
    assert sorted(map(tuple, m.business_monthly_profits.collect()), key=str) == \
        sorted(map(tuple, by_pairs.collect()), key=str)
