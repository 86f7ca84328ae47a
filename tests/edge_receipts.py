"""Hand-made receipts with known results: promotion threshold, fan-out, repeated product,
zero per_quantity, empty lists, NULL and absent customer, zero total."""

import json
import os

_MISSING = object()


def _receipt(ref, date, products, promotions, total, customer=_MISSING, cashier="Ann",
             payments=None):
    doc = {
        "Business": {"ABN": "1 2 3", "Name": "Shop A"},
        "Cashier": cashier,
        "Date": date,
        "GST": round(total / 11, 2),
        "Payments": payments if payments is not None else [{"Amount": total, "Method": "Card"}],
        "Products": [{"Cost": c, "Name": n, "Price": p, "Quantity": q} for n, c, p, q in products],
        "Promotions": [{"Product": n, "Discount": d, "Per_Quantity": k} for n, d, k in promotions],
        "Reference": ref,
        "Sequence": int(ref[1:]),
        "Terminal": 1,
        "Total": total,
    }
    if customer is not _MISSING:
        doc["Customer"] = customer
    return doc


def lisa():
    return {"Name": "Lisa", "Points_Earnt": 4}


def scott():
    return {"Name": "Scott", "Points_Earnt": 1}


EDGE_RECEIPTS = [
    _receipt("R1", "2022/07/02", [("A", 4, 10, 5)], [("A", 0.1, 3)], 45.0, lisa()),
    _receipt("R2", "2022/07/03", [("A", 4, 10, 2)], [("A", 0.1, 3)], 20.0, lisa()),
    _receipt("R3", "2022/08/01", [("A", 4, 10, 1)], [("B", 0.1, 1)], 10.0, scott()),
    _receipt("R4", "2022/08/02", [("A", 4, 10, 1)], [("A", 0.1, 1), ("A", 0.2, 1)], 10.0, None),
    _receipt("R5", "2023/06/30", [("A", 4, 10, 1), ("A", 4, 10, 2)], [("A", 0.1, 2)], 28.0,
             cashier="Bob", payments=[{"Amount": 20.0, "Method": "Cash"},
                                      {"Amount": 8.0, "Method": "BPAY"}]),
    _receipt("R6", "2023/06/30", [("A", 4, 10, 1)], [("A", 0.1, 0)], 10.0,
             {"Name": None, "Points_Earnt": 1}),
    _receipt("R7", "2023/07/01", [], [], 5.0, lisa(), payments=[]),
    _receipt("R8", "2023/07/02", [("B", 1.5, 3.5, 2)], [("B", 0, 1)], 0.0, scott(),
             cashier="Bob"),
]

# Expected sale_profits: receipt -> (cost, price, price after discount, profit).
EXPECTED_SALE_PROFITS = {
    "R1": ("20.00", "50.00", "45.00", "25.00"),
    "R2": ("8.00", "20.00", "20.00", "12.00"),
    "R3": ("4.00", "10.00", "10.00", "6.00"),
    "R4": ("8.00", "20.00", "17.00", "9.00"),
    "R5": ("12.00", "30.00", "28.00", "16.00"),
    "R6": ("4.00", "10.00", "10.00", "6.00"),
    "R8": ("3.00", "7.00", "7.00", "4.00"),
}


def write_documents(directory, receipts=None, indent=4):
    """One pretty-printed JSON document per file, as a till exports them."""
    os.makedirs(directory, exist_ok=True)
    for i, doc in enumerate(receipts or EDGE_RECEIPTS):
        with open(os.path.join(directory, f"{doc['Reference'] or 'none'}-{i}.json"), "w") as f:
            json.dump(doc, f, indent=indent)
    return directory
