import datetime as dt
import json

import pytest
from ledger_data import rows

from coinstrata import (
    LedgerPipeline,
    explode_outputs,
    get_data_summary,
    load_blocks,
    load_results,
    load_transactions,
    save_results,
)


def write(base, batch, kind, day, *records):
    folder = base / batch / kind / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records))


def tx(name, inputs, outputs, at, coinbase=False):
    return {
        "hash": name,
        "block_number": at // 86400,
        "block_timestamp": at,
        "is_coinbase": coinbase,
        "inputs": [
            {"index": i, "spent_transaction_hash": h, "spent_output_index": n}
            for i, (h, n) in enumerate(inputs)
        ],
        "outputs": [
            {"index": i, "value": v, "addresses": [a], "type": "pubkeyhash", "script_hex": "00"}
            for i, (v, a) in enumerate(outputs)
        ],
        "input_count": len(inputs),
        "output_count": len(outputs),
    }


@pytest.fixture
def export(tmp_path):
    base = tmp_path / "exports"
    write(base, "b1", "transactions", "1970-01-02", tx("a", [], [(5, "A"), (7, "B")], 86400, True))
    write(
        base,
        "b2",
        "transactions",
        "1970-01-03",
        tx("b", [("a", 0), ("a", 1)], [(12, "C")], 2 * 86400),
    )
    write(base, "b1", "blocks", "1970-01-02", {"hash": "h1", "number": 1, "timestamp": 86400})
    write(base, "b2", "blocks", "1970-01-03", {"hash": "h2", "number": 2, "timestamp": 172800})
    write(base, ".hidden", "transactions", "1970-01-02", tx("x", [], [(1, "X")], 0))
    (base / "notes").mkdir()
    (base / "readme.txt").write_text("not a batch")
    return base


@pytest.mark.parametrize("use_schema", [True, False])
def test_batches_are_read_together(spark, export, use_schema):
    found = load_transactions(spark, str(export), use_schema=use_schema)
    assert rows(found, "hash", "date") == [
        ("a", dt.date(1970, 1, 2)),
        ("b", dt.date(1970, 1, 3)),
    ]
    assert explode_outputs(found).count() == 3
    seconds = found.selectExpr("unix_seconds(block_datetime) - block_timestamp").distinct()
    assert rows(seconds) == [(0,)]


def test_blocks(spark, export):
    found = load_blocks(spark, str(export))
    assert rows(found, "hash", "number", "date") == [
        ("h1", 1, dt.date(1970, 1, 2)),
        ("h2", 2, dt.date(1970, 1, 3)),
    ]
    assert "timestamp_dt" in found.columns


def test_dates_prune_folders(spark, export):
    found = load_transactions(spark, str(export), start_date="1970-01-03", end_date="1970-02-01")
    assert rows(found, "hash") == [("b",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert ">= 1970-01-03" in filters and "<= 1970-02-01" in filters


def test_batches_with_and_without_folders(spark, export):
    """A batch without ``date=`` folders takes part in a date range by its block time."""
    flat = export / "b3" / "transactions"
    flat.mkdir(parents=True)
    (flat / "part.json").write_text(
        "\n".join(json.dumps(tx(f"c{day}", [], [(1, "D")], day * 86400)) for day in (1, 2, 40))
    )
    everything = load_transactions(spark, str(export))
    assert rows(everything, "hash", "date") == [
        ("a", dt.date(1970, 1, 2)),
        ("b", dt.date(1970, 1, 3)),
        ("c1", dt.date(1970, 1, 2)),
        ("c2", dt.date(1970, 1, 3)),
        ("c40", dt.date(1970, 2, 10)),
    ]
    found = load_transactions(spark, str(export), start_date="1970-01-03", end_date="1970-02-01")
    assert rows(found, "hash") == [("b",), ("c2",)]
    whole = load_transactions(spark, str(export), start_date="1970-01-01", end_date="1971-01-01")
    assert whole.count() == 5


def test_export_with_split_records(spark, tmp_path, monkeypatch):
    """Transactions that span several records are one before an export and after it."""
    from coinstrata.plans.queries import _exported
    from coinstrata.sources import orders_ledger

    monkeypatch.setattr(orders_ledger, "RECORD_CHUNK", 2)
    before = LedgerPipeline.from_orders(spark, "/root/testdata/sf0.001", folder=str(tmp_path / "a"))
    assert before.records.filter("record_part > 0").count() > 100
    after = LedgerPipeline.from_export(spark, _exported(before), folder=str(tmp_path / "b"))

    def sizes(p):
        tables = (p.transactions, p.outputs, p.inputs, p.utxos, p.clustering_inputs, p.entities)
        return [t.count() for t in tables]

    assert sizes(after) == sizes(before)
    assert sizes(before)[:3] == [1500, 6027, 4237]


def test_missing_folders_raise(spark, tmp_path):
    with pytest.raises(ValueError):
        load_transactions(spark, str(tmp_path))
    (tmp_path / "batch").mkdir()
    with pytest.raises(ValueError):
        load_transactions(spark, str(tmp_path))
    with pytest.raises(ValueError):
        load_blocks(spark, str(tmp_path))


def test_summary(spark, export):
    summary = get_data_summary(
        load_transactions(spark, str(export)), load_blocks(spark, str(export))
    )
    assert summary == {
        "total_transactions": 2,
        "total_blocks": 2,
        "min_block": 1,
        "max_block": 2,
        "multi_input_transactions": 1,
        "multi_input_ratio": 0.5,
    }


def test_pipeline_over_an_export(spark, export, tmp_path):
    (tmp_path / "stages").mkdir()
    (tmp_path / "stages" / "foreign.txt").write_text("not ours")
    pipeline = LedgerPipeline.from_export(spark, str(export), folder=str(tmp_path / "stages"))
    assert rows(pipeline.entities) == [("A", "A"), ("B", "A")]
    assert rows(pipeline.utxos, "tx_hash", "output_index") == [("b", 0)]
    assert rows(pipeline.timeline, "entity_id", "daily_delta") == [("A", -12), ("A", 12)]
    paths = pipeline.save(str(tmp_path / "results"))
    assert sorted(paths) == ["entities", "inputs", "outputs", "utxos"]
    assert load_results(spark, str(tmp_path / "results"), "outputs").count() == 3
    pipeline.drop()
    assert [p.name for p in (tmp_path / "stages").iterdir()] == ["foreign.txt"]
    assert pipeline.utxos.count() == 1


def test_results_are_replaced(spark, tmp_path):
    save_results(str(tmp_path), numbers=spark.range(5))
    save_results(str(tmp_path), numbers=spark.range(2))
    assert load_results(spark, str(tmp_path), "numbers").count() == 2
