from ledger_data import BTC, output, rows, spend, transaction

from coinstrata import compute_utxo_set, explode_inputs, explode_outputs
from coinstrata.operators.spends import link_outputs, link_spends, linked_spends, unspent_outputs
from coinstrata.operators.utxo import spent_summary
from coinstrata.plans.pipeline import LedgerPipeline


def unspent(tx):
    return compute_utxo_set(explode_outputs(tx), explode_inputs(tx))


def test_spent_output_leaves_the_set(ledger):
    tx = ledger(
        transaction("tx1", [output(0, 5, ["A"]), output(1, 3, ["B"])]),
        transaction("tx2", [output(0, 2, ["C"])], [spend(0, "tx1", 0)]),
    )
    assert rows(unspent(tx), "tx_hash", "output_index", "value") == [
        ("tx1", 1, 3),
        ("tx2", 0, 2),
    ]


def test_worked_example_sums_to_13(ledger):
    tx = ledger(
        transaction("TX-1", [output(0, 5 * BTC, ["A"]), output(1, 2 * BTC, ["B"])], coinbase=True),
        transaction("TX-2", [output(0, 10 * BTC, ["C"])], [spend(0, "TX-1", 0)]),
        transaction("TX-3", [output(0, 1 * BTC, ["D"])], coinbase=True),
    )
    left = unspent(tx).filter("output_index is not null")
    assert (left.count(), left.agg({"value": "sum"}).first()[0]) == (3, 13 * BTC)


def test_null_coinbase_flag_spends_nothing(ledger):
    tx = ledger(
        transaction("a", [output(0, 5, ["A"])], coinbase=True),
        transaction("b", [output(0, 5, ["B"])], [spend(0, "a", 0)], coinbase=None),
    )
    assert rows(unspent(tx), "tx_hash") == [("a",), ("b",)]


def test_transaction_without_outputs_stays_as_null_row(ledger):
    tx = ledger(transaction("none"), transaction("empty", []))
    assert rows(unspent(tx), "tx_hash", "output_index") == [("empty", None), ("none", None)]


def test_repeated_and_unknown_references(ledger):
    tx = ledger(
        transaction("a", [output(0, 5, ["A"]), output(1, 6, ["A"])], coinbase=True),
        transaction("b", [output(0, 1, ["B"])], [spend(0, "a", 0), spend(1, "a", 0)]),
        transaction("c", [output(0, 1, ["C"])], [spend(0, "a", 0), spend(1, "elsewhere", 4)]),
    )
    assert rows(unspent(tx), "tx_hash", "output_index") == [("a", 1), ("b", 0), ("c", 0)]


def test_summary_adds_up(ledger):
    tx = ledger(
        transaction("a", [output(0, 5, ["A"]), output(1, 6, ["A"])], coinbase=True),
        transaction("b", [output(0, 1, ["B"]), output(1, 1, ["B"])], [spend(0, "a", 0)]),
    )
    outputs = explode_outputs(tx)
    summary = spent_summary(outputs, unspent(tx)).first()
    assert tuple(summary) == (4, 1, 3, 25.0, 75.0)
    nothing = spent_summary(outputs.limit(0), unspent(tx).limit(0)).first()
    assert tuple(nothing) == (0, 0, 0, None, None)


ODD = [
    transaction("a", [output(0, 5, ["A"], "one"), output(1, 6, ["A", "B"])], coinbase=True, at=10),
    transaction("a", [output(0, 7, None)], coinbase=True, at=20),
    transaction("b", [output(17, 1, []), output(None, 2, ["N"])], [spend(0, "a", 0), spend(1, "a", 0)]),
    transaction("c", [], [spend(0, "a", 17), spend(1, "b", 17), spend(2, "elsewhere", 4)]),
    transaction("d", None, [spend(0, None, 0, ["R"]), spend(1, "a", None), spend(2, "a", -1)]),
    transaction("e", [output(0, 9, ["E"])], [spend(0, "a", 1)], coinbase=None),
]


def test_links_are_spends_and_unspent_outputs(ledger):
    tx = ledger(*ODD)
    outputs, inputs = explode_outputs(tx), explode_inputs(tx)
    links = link_outputs(tx, outputs, inputs)
    assert rows(linked_spends(links)) == rows(link_spends(tx, outputs))
    assert rows(unspent_outputs(links)) == rows(unspent(tx))
    assert len(rows(unspent_outputs(links))) == 5
    assert linked_spends(links).columns == link_spends(tx, outputs).columns
    assert unspent_outputs(links).columns == outputs.columns


def test_outputs_of_links_are_shuffled_once(spark, ledger, workdir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pipeline = LedgerPipeline(spark, lambda p: ledger(*ODD), lambda p: None, folder=workdir)
        links = link_outputs(pipeline.records, pipeline.outputs, pipeline.references)
        execution = links._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        assert "ReusedExchange" in execution.executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
