"""Models built load by load against a full rebuild over all receipts."""

import copy

import pytest

from tests.conftest import rows
from tests.edge_receipts import EDGE_RECEIPTS, write_documents
from tillroll.plans import MODEL_NAMES, ReceiptModels, load_receipts, loaded_models
from tillroll.plans.incremental import PARTIAL_NAMES, partial_states
from tillroll.sources import LoadStore, read_receipt_json


def _again(k, **changes):
    receipt = copy.deepcopy(EDGE_RECEIPTS[k])
    receipt.update(changes)
    return receipt


# R1 comes twice in one load and in a later one with other values, R5 in two loads, R4 three times in
# two; one load has receipts without Reference.
LOADS = {
    "2022-07-03": [*EDGE_RECEIPTS[:2], _again(0, Total=46.0)],
    "2022-08-02": [*EDGE_RECEIPTS[2:5], _again(3, Cashier="Cy"), _again(1, Reference=None), _again(2, Reference=None)],
    "2023-07-02": [*EDGE_RECEIPTS[4:], _again(0, Date="2023/07/01", Business={"ABN": "9", "Name": "Shop B"}), _again(3)],
}


def _receipts(spark, folder, documents):
    return read_receipt_json(spark, write_documents(str(folder), documents))


@pytest.fixture()
def loaded(spark, tmp_path):
    parts = {load: _receipts(spark, tmp_path / "in" / load, documents) for load, documents in LOADS.items()}
    for load, part in parts.items():
        load_receipts(spark, str(tmp_path / "root"), load, part)
    return str(tmp_path / "root"), parts


def test_every_model_equals_the_full_rebuild(spark, loaded):
    root, parts = loaded
    first, *rest = parts.values()
    for part in rest:
        first = first.unionByName(part)
    whole, models = ReceiptModels(first, unique_reference=None), loaded_models(spark, root)
    joins = ReceiptModels(first, unique_reference=False)
    for name in MODEL_NAMES:
        got = models.table(name)
        assert got.schema.simpleString() == whole.table(name).schema.simpleString(), name
        assert rows(got) == rows(whole.table(name)) == rows(joins.table(name)), name


def test_a_load_reads_its_own_staging_alone(spark, loaded):
    root, parts = loaded
    store = LoadStore(spark, root)
    run = load_receipts(spark, root, "2023-08-01", _receipts(spark, f"{root}-more", [_again(0, Reference="R100")]), unique_reference=True)
    staged = spark.read.parquet(store.path(run, "stg_receipts"))
    for name, state in partial_states(staged, staged).items():
        assert state.inputFiles() and all("load=2023-08-01" in f for f in state.inputFiles()), name
    models = loaded_models(spark, root)
    assert models.staging_row_count.first().num_rows == sum(map(len, LOADS.values())) + 1
    # what repeated References don't change is merged from states, though some repeat here
    for name in ("business_customers_summary", "contract_report"):
        files = models.table(name).inputFiles()
        assert files and all("/state_" in f for f in files), name


def test_models_without_repeats_read_no_staging(spark, tmp_path):
    root = str(tmp_path / "root")
    for k in range(2):
        load_receipts(spark, root, f"day-{k}", _receipts(spark, tmp_path / f"in{k}", EDGE_RECEIPTS[k::2]), unique_reference=k == 1)
    models = loaded_models(spark, root)
    for name in ("business_monthly_profits", "business_customers_summary", "top_ten_customers_by_business_value", "business_employee_stats",
                 "turnover_summary", "businesses", "staging_row_count", "contract_report"):
        files = models.table(name).inputFiles()
        assert files and all("/state_" in f for f in files), name


def test_repeated_receipts_are_read_from_staging_once(spark, loaded):
    root, _ = loaded
    models = loaded_models(spark, root)
    for name in ("business_monthly_profits", "business_employees", "turnover_by_period"):
        files = models.table(name).inputFiles()
        assert files and not any("/stg_receipts/" in f for f in files), name


def test_a_state_that_fails_fails_its_load(spark, tmp_path):
    root = str(tmp_path / "root")
    bad = _receipts(spark, tmp_path / "in", [_again(0, Date="soon")])
    with pytest.raises(Exception, match="not a receipt date"):
        load_receipts(spark, root, "bad", bad, unique_reference=True)
    assert LoadStore(spark, root).current() == {}


def test_monthly_profits_compute_the_profit_alone(spark, tmp_path):
    staged = _receipts(spark, tmp_path / "in", EDGE_RECEIPTS)
    plan = partial_states(staged, staged)["business_monthly_profits"]._jdf.queryExecution().optimizedPlan().toString()
    assert "total_monthly_profit" in plan and "price_after_discount" not in plan and "total_cost" not in plan


def test_a_load_delivered_again_replaces_the_former(spark, loaded):
    root, parts = loaded
    store = LoadStore(spark, root)
    before = store.current()
    half = store.new_load("2022-08-02")  # written but not committed: nothing changes for readers
    store.write(parts["2022-07-03"], half, "stg_receipts")
    assert store.current() == before
    corrected = _receipts(spark, f"{root}-again", EDGE_RECEIPTS[2:4])
    load_receipts(spark, root, "2022-08-02", corrected)
    assert set(store.current()) == set(before) and store.current()["2022-08-02"] > before["2022-08-02"]
    whole = ReceiptModels(parts["2022-07-03"].unionByName(corrected).unionByName(parts["2023-07-02"]), unique_reference=False)
    models = loaded_models(spark, root)
    for name in ("business_monthly_profits", "business_employees", "sale_profits", "businesses", "contract_report"):
        assert rows(models.table(name)) == rows(whole.table(name)), name


def test_nothing_loaded_and_empty_loads(spark, tmp_path):
    root = str(tmp_path / "root")
    empty = loaded_models(spark, root)
    assert empty.staging_row_count.first().num_rows == 0 and empty.business_monthly_profits.collect() == []
    assert {r.null_count for r in empty.contract_report.collect()} == {0}
    some = _receipts(spark, tmp_path / "in", EDGE_RECEIPTS)
    load_receipts(spark, root, "none", some.limit(0))
    load_receipts(spark, root, "all", some)
    models, whole = loaded_models(spark, root), ReceiptModels(some, unique_reference=True)
    for name in [n for n in PARTIAL_NAMES if n != "customer_totals"] + ["business_customers_summary"]:
        assert rows(models.table(name)) == rows(whole.table(name)), name
    with pytest.raises(ValueError, match="a load is named"):
        load_receipts(spark, root, "../x", some)


def test_command_line_load(spark, tmp_path, capsys):
    import json

    from tillroll.__main__ import main

    main(["load", "--root", str(tmp_path / "root"), "--source", write_documents(str(tmp_path / "in")), "--load", "2022"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["load"] == "2022"
    assert loaded_models(spark, str(tmp_path / "root")).staging_row_count.first().num_rows == len(EDGE_RECEIPTS)
