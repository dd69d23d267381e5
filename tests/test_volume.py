"""What the stages shuffle and write: no more than their results are made of."""

import datetime
from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from coinstrata.operators.components import _stars_by_window, connected_groups
from coinstrata.operators.history import balance_events, daily_changes
from coinstrata.operators.skew import WINDOW_ROWS, with_neighbours
from coinstrata.operators.spends import link_spends
from coinstrata.operators.utxo import compute_utxo_set
from coinstrata.plans.pipeline import LedgerPipeline
from coinstrata.plans.queries import _write_export
from coinstrata.sources import orders_ledger
from coinstrata.sources.orders_ledger import derive_transactions


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles_by_block(df):
    exchanges = [x for x in plan_of(df).split("\n") if "Exchange hashpartitioning" in x]
    return [x for x in exchanges if "block" in x or "shiftright" in x]


def test_small_groups_are_linked_without_ranges(spark, tmp_path):
    rows = spark.range(600).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("key"), "id")
    linked = with_neighbours(rows, "key", ["id"], ["id"], str(tmp_path))
    found = {r.id: (r.p, r.f) for r in linked.select("id", "previous.id", "following.id").toDF("id", "p", "f").collect()}
    expected = {
        i: (i - 7 if i > 7 else None, i + 7 if i + 7 < 600 else None) for i in range(600) if i % 7
    }
    assert found == expected
    assert not list(tmp_path.glob("ranges-*"))


def test_only_large_groups_go_by_ranges(spark, tmp_path):
    n = 2 * WINDOW_ROWS
    rows = spark.range(n).select(F.when(F.col("id") % 4 > 0, -1).otherwise(F.col("id") % 100).alias("key"), "id")
    linked = with_neighbours(rows, "key", ["id"], ["id"], str(tmp_path)).select("key", "id", "following.id").toDF("key", "id", "f")
    groups = {}
    for r in sorted(linked.collect(), key=lambda r: r.id):
        groups.setdefault(r.key, []).append((r.id, r.f))
    assert sum(len(g) for g in groups.values()) == n
    for group in groups.values():
        assert [f for _, f in group] == [i for i, _ in group[1:]] + [None]
    (dealt,) = tmp_path.glob("ranges-*")
    assert [r.key for r in spark.read.parquet(str(dealt)).select("key").distinct().collect()] == [-1]


def _orders(spark, folder):
    day = F.lit(datetime.datetime(1996, 1, 1))
    orders = spark.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"),
        F.timestamp_add("DAY", F.col("id").cast("int"), day).cast("timestamp_ntz").alias("o_orderdate"),
    )
    lines = spark.range(200).select(
        (F.col("id") % 39).alias("l_orderkey"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 97 % 500 - 50).alias("l_partkey"),
        F.col("id").alias("l_suppkey"), (F.col("id") % 8).cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), (F.col("id") * 1.1).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit(datetime.datetime(1996, 2, 1)).cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return orders, lines


def test_records_are_made_after_the_last_shuffle(spark, tmp_path):
    """Only marks and amounts move; the texts and nested records they stand for do not."""
    _, lines = _orders(spark, str(tmp_path))
    records = derive_transactions(spark, str(tmp_path), str(tmp_path / "stages"))
    above, _, below = plan_of(records).partition("Exchange hashpartitioning(ok")
    assert "pubkeyhash" in above and "pubkeyhash" not in below
    found, lines = {r["hash"]: r for r in records.collect()}, lines.collect()
    assert len(found) == 40 and found["tx39"].outputs is None
    for ok in range(39):
        own = sorted(
            (r for r in lines if r.l_orderkey == ok),
            key=lambda r: (r.l_linenumber, r.l_partkey is not None, r.l_partkey or 0, r.l_suppkey),
        )
        outputs = found[f"tx{ok}"].outputs
        assert [o["index"] for o in outputs] == list(range(len(own)))
        for line, output in zip(own, outputs, strict=True):
            part = line.l_partkey
            number = None if part is None else abs(part) % 16 * (1 if part >= 0 else -1)
            first = None if number is None else f"c{ok % 3}-{number}"
            nobody, two = part is not None and part % 97 == 0, line.l_linenumber == 7
            assert output.type == ("nulldata" if nobody else "multisig" if two else "pubkeyhash")
            assert output.addresses == ([] if nobody else [first, f"m{ok % 3 // 2}"] if two else [first])
            assert output.value == round(line.l_extendedprice * 10) * 10 ** (ok % 3)
        if ok + 3 < 39:
            inputs = found[f"tx{ok + 3}"].inputs or []
            spent = [o for o in outputs if (ok + o["index"]) % 4]
            assert [(i["index"], i.spent_transaction_hash, i.spent_output_index, i.value, i.addresses) for i in inputs] == [
                (k, f"tx{ok}", o["index"], o.value, o.addresses if (ok + o["index"]) % 3 == 0 else None)
                for k, o in enumerate(spent)
            ]


def test_records_take_two_shuffles_unless_keys_repeat(spark, tmp_path, monkeypatch):
    """The way by customers gives what the way by sides gives; the latter is for odd customers."""
    orders, lines = _orders(spark, str(tmp_path))
    records = derive_transactions(spark, str(tmp_path), str(tmp_path / "stages"))
    assert not (tmp_path / "stages" / "headers").exists()
    assert sum("Exchange " in x and "BroadcastExchange" not in x for x in plan_of(records).split("\n")) <= 3
    usual = sorted(map(str, records.collect()))

    monkeypatch.setattr(orders_ledger, "_odd_customers", lambda orders, _: orders.select("ck").distinct())
    by_sides = derive_transactions(spark, str(tmp_path), str(tmp_path / "all"))
    assert sorted(map(str, by_sides.collect())) == usual
    monkeypatch.undo()

    again = tmp_path / "again"
    again.mkdir()
    orders.unionByName(orders.filter("o_orderkey = 3")).write.parquet(f"{again}/orders.parquet")
    lines.write.parquet(f"{again}/lineitem.parquet")
    found = derive_transactions(spark, str(again), str(again / "stages")).collect()
    assert len(found) == 40 and len({r["hash"] for r in found}) == 40
    odd = {r.ck for r in spark.read.parquet(f"{again}/stages/odd-customers").collect()}
    assert odd == {0}
    assert {str(r) for r in found if int(r["hash"][2:]) % 3} == {x for x in usual if int(x.split("'")[1][2:]) % 3}


def test_groups_are_shuffled_once_where_large_ones_are_known(spark, tmp_path):
    rows = [("t", "a"), ("t", "b"), ("t", "b"), ("u", "b"), ("u", "c"), ("v", "d"), ("v", "d"), ("w", "e"), ("w", "f"), (None, "g"), (None, "h")]
    members = spark.createDataFrame(rows, "group string, id string")
    expected = sorted(map(str, connected_groups(members, str(tmp_path / "join")).collect()))
    assert len(expected) == 5
    for large in ([], [("u",)], [("t",), ("u",), ("w",)]):
        known = spark.createDataFrame(large, "group string")
        folder = tmp_path / f"large-{len(large)}"
        assert sorted(map(str, connected_groups(members, str(folder), known).collect())) == expected
    stars = _stars_by_window(members.withColumn("v", F.ascii("id")))
    assert plan_of(stars).count("Exchange ") == 1
    assert sorted(tuple(r) for r in stars.collect()) == [(97, 98), (98, 99), (101, 102)]


def test_daily_changes_write_no_bookings(spark, ledger, tmp_path):
    events = spark.createDataFrame(
        [("e", 1, 5), ("e", 1, -7), ("e", 2, None), ("e", 3, None), ("e", 3, -1), ("f", 1, 2)],
        "entity_id string, event_date int, delta long",
    )
    changes = sorted(tuple(r) for r in daily_changes(events).collect())
    assert changes == [("e", 1, -2, 5, -7), ("e", 2, None, 0, 0), ("e", 3, -1, 0, -1), ("f", 1, 2, 2, 0)]
    pay = {"index": 0, "type": "pubkeyhash", "addresses": ["A"], "value": 5}
    tx = {"hash": "a", "block_number": 1, "output_count": 1, "is_coinbase": True, "input_count": 0, "block_timestamp": 86400, "inputs": [], "outputs": [pay]}
    p = LedgerPipeline(spark, lambda _: ledger(tx), lambda _: None, folder=str(tmp_path))
    assert p.daily.count() == 0 and "bookings" not in p._stages


def test_unspent_outputs_meet_references_by_blocks(spark):
    pays = [("t", i, 10 * i) for i in range(40)] + [("u", 3, 1), ("e", None, None)]
    outputs = spark.createDataFrame(pays, "tx_hash string, output_index int, value long")
    spent = [0, 15, 16, 17, 31, 32, 39, 39, 39, 70]
    rows = [(False, "t", i) for i in spent] + [(True, "u", 3), (False, None, 3), (False, "u", None), (None, "u", 3)]
    inputs = spark.createDataFrame(rows, "is_coinbase boolean, spent_tx_hash string, spent_output_index int")
    unspent = compute_utxo_set(outputs, inputs)
    assert shuffles_by_block(unspent) or "BroadcastHashJoin" in plan_of(unspent)
    assert "spent_bits" in plan_of(unspent)  # one row for the references to a block
    assert sorted(map(str, unspent.collect())) == sorted(
        map(str, outputs.filter("tx_hash <> 't' or output_index not in (0,15,16,17,31,32,39)").collect())
    )


def test_spends_meet_outputs_by_blocks(spark, ledger):
    places = [0, 15, 16, 39, 41]
    spending = [
        {"index": k, "spent_transaction_hash": "t", "spent_output_index": i, "addresses": None, "value": None}
        for k, i in enumerate([*places, None])
    ]
    records = ledger({"hash": "s", "is_coinbase": False, "input_count": 6, "block_timestamp": 9, "inputs": spending, "outputs": []})
    outputs = spark.range(40).select(
        F.lit("t").alias("tx_hash"), F.col("id").cast("int").alias("output_index"), (F.col("id") * 10).alias("value")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        linked = link_spends(records, outputs)
        assert len(shuffles_by_block(linked)) == 2
        found = {(r.source_tx_hash, r.source_output_index, r.source_value, r.has_source) for r in linked.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {*(("t", i, 10 * i if i < 40 else None, i < 40) for i in places), ("s", -1, None, False)}


def test_events_need_no_whole_history(spark, ledger, tmp_path):
    pay = lambda index, address: {"index": index, "type": "pubkeyhash", "addresses": [address], "value": 5 + index}
    spend = lambda index: {"index": index, "spent_transaction_hash": "a", "spent_output_index": index, "addresses": None, "value": None}
    head = {"block_number": 1, "output_count": 2}
    first = {**head, "hash": "a", "is_coinbase": True, "input_count": 0, "block_timestamp": 86400, "inputs": [], "outputs": [pay(0, "A"), pay(1, "B")]}
    second = {**head, "hash": "b", "is_coinbase": False, "input_count": 2, "block_timestamp": 2 * 86400, "inputs": [spend(0), spend(1)], "outputs": [pay(0, "A")]}
    p = LedgerPipeline(spark, lambda _: ledger(first, second), lambda _: None, folder=str(tmp_path))
    events = sorted(map(str, p.events.collect()))
    assert "history" not in p._stages and len(events) == 5
    assert p._stages["bookings"].columns == ["entity_id", "value", "created_timestamp", "spent_timestamp"]
    assert events == sorted(map(str, balance_events(p.history).collect()))


def test_exports_are_compressed(spark, tmp_path):
    days = spark.range(9000, 11000, 100)
    p = SimpleNamespace(
        spark=spark,
        records=days.select(F.col("id").alias("block_number"), F.lit("x").alias("hash")),
        blocks=days.select(F.col("id").alias("number")),
    )
    _write_export(p, str(tmp_path))
    files = [x for x in Path(tmp_path).rglob("part-*")]
    assert files and all(x.name.endswith(".json.gz") for x in files)
