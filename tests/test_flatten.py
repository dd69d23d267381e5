from ledger_data import output, rows, spend, transaction

from coinstrata import explode_inputs, explode_outputs
from coinstrata.schemas import TRANSACTION_SCHEMA


def test_two_outputs_become_two_rows(ledger):
    tx = transaction("abc123", [output(0, 50_000_000, ["1A"]), output(1, 30_000_000, ["1B"])])
    flat = explode_outputs(ledger(tx))
    assert rows(flat, "tx_hash", "output_index", "value", "addresses") == [
        ("abc123", 0, 50_000_000, ["1A"]),
        ("abc123", 1, 30_000_000, ["1B"]),
    ]


def test_json_record(spark, tmp_path):
    line = (
        '{"hash":"f4184fc5","block_number":170,"block_timestamp":1231731025,"is_coinbase":false,'
        '"inputs":[{"index":0,"spent_transaction_hash":"0437cd7f","spent_output_index":0,'
        '"addresses":["12cbQ"],"value":5000000000}],'
        '"outputs":[{"index":0,"addresses":["1Q2TW"],"value":1000000000,"type":"pubkeyhash"},'
        '{"index":1,"addresses":["12cbQ"],"value":4000000000}]}'
    )
    (tmp_path / "tx.json").write_text(line)
    tx = spark.read.schema(TRANSACTION_SCHEMA).json(str(tmp_path / "tx.json"))
    assert rows(explode_inputs(tx)) == [
        ("f4184fc5", 170, 1231731025, False, 0, "0437cd7f", 0, ["12cbQ"], 5000000000)
    ]
    assert rows(explode_outputs(tx), "output_index", "value", "output_type") == [
        (0, 1000000000, "pubkeyhash"),
        (1, 4000000000, None),
    ]


def test_missing_and_empty_arrays_give_one_null_row(ledger):
    tx = ledger(transaction("none"), transaction("empty", [], []))
    for explode, index in ((explode_outputs, "output_index"), (explode_inputs, "input_index")):
        assert rows(explode(tx), "tx_hash", index) == [("empty", None), ("none", None)]
        assert explode(tx, drop_empty=True).count() == 0


def test_input_columns(ledger):
    tx = transaction("t", inputs=[spend(0, "s", 3, ["A"], 7)], at=86400)
    assert explode_inputs(ledger(tx)).columns == [
        "tx_hash",
        "block_number",
        "block_timestamp",
        "is_coinbase",
        "input_index",
        "spent_tx_hash",
        "spent_output_index",
        "addresses",
        "value",
    ]


def test_scan_reads_only_needed_nested_fields(ledger, spark, tmp_path):
    path = str(tmp_path / "tx")
    ledger(transaction("t", [output(0, 1, ["A"])])).write.parquet(path)
    flat = explode_outputs(spark.read.parquet(path))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "script_hex" not in plan and "inputs" not in plan
