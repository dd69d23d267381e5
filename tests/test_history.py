import datetime as dt
import random

from ledger_data import BTC, output, rows, spend, transaction
from pyspark.sql import functions as F

from coinstrata import (
    balance_events,
    balance_timeline,
    compute_utxo_set,
    entity_balances,
    explode_inputs,
    explode_outputs,
    utxo_history,
)
from coinstrata.operators import history as h
from coinstrata.operators.spends import link_spends, spent_by_transaction, spent_outputs
from coinstrata.plans.pipeline import LedgerPipeline
from coinstrata.plans.reports import global_counts


def epoch(day, seconds=0):
    moment = dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc)
    return int(moment.timestamp()) + seconds


def owners(spark, *addresses, entity="E"):
    return spark.createDataFrame([(a, entity) for a in addresses], "address string, entity_id string")


def full_history(tx, entities):
    return utxo_history(explode_outputs(tx), explode_inputs(tx), entities)


def test_worked_example(ledger, spark):
    born, moved = epoch("2015-01-01"), epoch("2018-06-15")
    tx = ledger(
        transaction(
            "abc123", [output(0, 50, ["1A"]), output(1, 10, ["1B"])], at=born, coinbase=True
        ),
        transaction("def456", [output(0, 30, ["1A"])], [spend(0, "abc123", 0)], at=moved),
    )
    found = full_history(tx, owners(spark, "1A", "1B"))
    assert rows(found, "tx_hash", "output_index", "created_timestamp", "spent_timestamp") == [
        ("abc123", 0, born, moved),
        ("abc123", 1, born, None),
        ("def456", 0, moved, None),
    ]
    assert tuple(h.history_counts(found).first()) == (3, 1, 2)
    assert rows(h.event_counts(balance_events(found))) == [("CREATED", 3), ("SPENT", 1)]
    linked = h.owned_history(
        spent_outputs(link_spends(tx, explode_outputs(tx))),
        compute_utxo_set(explode_outputs(tx), explode_inputs(tx)),
        owners(spark, "1A", "1B"),
    )
    assert rows(found) == rows(linked)


def test_repeated_reference_repeats_the_output(ledger, spark):
    tx = ledger(
        transaction("a", [output(0, 5, ["A"])], coinbase=True),
        transaction("b", [], [spend(0, "a", 0)], at=86400),
        transaction("c", [], [spend(0, "a", 0)], at=2 * 86400),
    )
    assert rows(full_history(tx, owners(spark, "A")), "tx_hash", "spent_timestamp") == [
        ("a", 172800),
        ("a", 86400),
    ]


def test_outputs_without_address_or_owner_are_left_out(ledger, spark):
    tx = ledger(
        transaction("a", [output(0, 5, []), output(1, 5, None), output(2, 5, ["Z"])]),
        transaction("b", None),
    )
    assert full_history(tx, owners(spark, "A")).count() == 0


def test_only_the_first_address_owns_in_the_history(ledger, spark):
    tx = ledger(transaction("a", [output(0, 10, ["A", "B"])], coinbase=True))
    entities = owners(spark, "A", "B")
    snapshot = entity_balances(explode_outputs(tx), entities).first()["balance_satoshi"]
    events = balance_events(full_history(tx, entities)).collect()
    assert (snapshot, [e["delta"] for e in events]) == (20, [10])


def events(spark, *items):
    data = [(e, dt.date.fromisoformat(day), delta * BTC, "x") for e, day, delta in items]
    return spark.createDataFrame(
        data, "entity_id string, event_date date, delta long, event_type string"
    )


def test_running_balance(spark):
    booked = events(
        spark,
        ("1", "2020-01-01", 100),
        ("1", "2015-01-01", 50),
        ("1", "2018-06-15", -50),
        ("1", "2016-03-15", 15),
        ("1", "2016-03-15", 5),
    )
    timeline = balance_timeline(h.daily_changes(booked))
    assert [r["cumulative_btc"] for r in timeline.orderBy("event_date").collect()] == [
        50.0,
        70.0,
        20.0,
        120.0,
    ]
    assert tuple(h.timeline_counts(timeline).first()) == (4, 1)


def test_days_do_not_depend_on_the_session_zone(ledger, spark):
    late = epoch("2014-12-31", 86399)
    tx = ledger(transaction("a", [output(0, 1, ["A"])], at=late, coinbase=True))
    found = balance_events(full_history(tx, owners(spark, "A")))
    assert rows(found, "event_date") == [(dt.date(2014, 12, 31),)]


def current(spark, **btc):
    data = [(e, int(x * BTC), 1, float(x)) for e, x in btc.items()]
    return spark.createDataFrame(
        data, "entity_id string, balance_satoshi long, utxo_count long, balance_btc double"
    )


def test_months_sort_as_text(spark):
    daily = h.daily_changes(events(spark, ("1", "2011-10-03", 1), ("1", "2011-02-03", 2)))
    flow = h.holder_monthly_flow(daily, current(spark, **{"1": 100}))
    assert [r["year_month"] for r in flow.collect()] == ["2011-02", "2011-10"]


def test_monthly_flow_of_large_holders_only(spark):
    daily = h.daily_changes(
        events(
            spark,
            ("big", "2011-01-01", 300),
            ("big", "2011-01-01", -100),
            ("big", "2011-02-01", -50),
            ("small", "2011-01-01", 99),
        )
    )
    flow = h.holder_monthly_flow(daily, current(spark, big=150, small=99))
    assert [tuple(r)[4:] for r in flow.collect()] == [(200.0, 300.0, -100.0), (-50.0, 0.0, -50.0)]
    trend = h.holder_trend(flow).collect()
    assert [(r["cumulative_net_btc"], r["trend"]) for r in trend] == [
        (200.0, "accumulation"),
        (150.0, "accumulation"),
    ]
    assert [r["cumulative_net_btc"] for r in h.holder_trend(flow, months=1).collect()] == [-50.0]


def test_month_views_against_brute_force(spark):
    rng = random.Random(5)
    start = dt.date(2010, 11, 20)
    booked = []
    for entity, count in (("a", 40), ("b", 3), ("c", 1), ("d", 12)):
        for _ in range(count):
            day = start + dt.timedelta(days=rng.randrange(400))
            booked.append((entity, day.isoformat(), rng.randrange(1, 500)))
    balance = {e: sum(x for f, _, x in booked if f == e) for e in "abcd"}
    owned = current(spark, **balance)
    daily = h.daily_changes(events(spark, *booked))

    def category(btc):
        bounds = [(1000, "Mega Whale (1000+ BTC)"), (100, "Whale (100-1000 BTC)")]
        bounds.append((10, "Large (10-100 BTC)"))
        return next((c for b, c in bounds if btc >= b), "Small/Medium (<10 BTC)")

    months = sorted({day[:7] for _, day, _ in booked})
    every_month = []
    year, month = map(int, months[0].split("-"))
    while f"{year}-{month:02}" <= months[-1]:
        every_month.append(f"{year}-{month:02}")
        year, month = (year + month // 12, month % 12 + 1)

    month_end, activity = {}, {}
    for entity, total in balance.items():
        of_entity = [(day, x) for f, day, x in booked if f == entity]
        for m in every_month:
            if min(day for day, _ in of_entity)[:7] <= m:
                key = (m, category(total))
                held = sum(x for day, x in of_entity if day[:7] <= m)
                month_end[key] = month_end.get(key, 0) + held
        for day in {d for d, _ in of_entity}:
            key = (day[:7], category(total))
            activity[key] = activity.get(key, 0) + sum(x for d, x in of_entity if d <= day)

    by_end = {(r[0], r[1]): r[2] for r in h.category_month_end(daily, owned).collect()}
    assert by_end == month_end
    by_activity = h.category_by_month(balance_timeline(daily), owned).collect()
    assert {(r[0], r[1]): r[2] for r in by_activity} == activity


def test_trajectories_of_the_largest(spark):
    daily = h.daily_changes(
        events(spark, ("a", "2011-01-01", 3), ("b", "2011-01-01", 2), ("c", "2011-01-02", 1))
    )
    found = h.holder_trajectories(daily, current(spark, a=3, b=2, c=1), k=2)
    assert rows(found, "entity_id", "cumulative_btc") == [("a", 3.0), ("b", 2.0)]


def test_days_from_spends_by_transaction(spark, ledger, workdir):
    day = 86400
    records = ledger(
        transaction("a", [output(0, 5, ["A"]), output(1, 6, ["B"]), output(2, -4, ["A"]), output(3, 0, ["B"])], coinbase=True, at=10),
        transaction("b", [output(0, 7, ["A"]), output(1, None, ["C"]), output(2, 8, []), output(3, 9, [None])], coinbase=True, at=day + 5),
        transaction("c", [output(0, 3, ["A"]), output(1, 2, ["D"])], [spend(i, "a", i) for i in range(4)], at=2 * day + 1),
        transaction("d", [output(0, 1, ["C"])], [spend(i, "b", i, ["X"]) for i in range(4)], at=2 * day + 9),
        transaction("e", None, [spend(0, "c", 0), spend(1, "d", 0), spend(2, "c", 0)], at=3 * day),
        transaction("f", None, [spend(0, "c", 1)], at=3 * day),
        transaction("g", None, [spend(0, "c", 0), spend(1, "c", 1), spend(2, "a", 1), spend(3, "none", 1)], at=4 * day),
    )
    for bounds in ({}, {"max_inputs": 3}, {"min_inputs": 4}):
        # One pipeline takes days from bookings, the other from what transactions spend.
        booked, added = (
            LedgerPipeline(spark, lambda p: records, lambda p: None, folder=workdir, **bounds) for _ in range(2)
        )
        assert rows(h.daily_changes(booked.events)) == rows(added.daily)
        assert "bookings" not in added._stages and added.daily.count() > 0
        spent = spent_by_transaction(added.spends.filter("has_source"), F.col("input_count") >= 2)
        assert spent.count() < spent_outputs(added.spends).count()


def test_global_counts_do_not_write_the_history(spark, ledger, workdir):
    records = ledger(
        transaction("a", [output(0, 5, ["A"]), output(1, 6, ["B"]), output(2, 7, ["C"])], coinbase=True),
        transaction("b", [output(0, 3, ["A"])], [spend(0, "a", 0), spend(1, "a", 1)]),
    )
    pipeline = LedgerPipeline(
        spark, lambda p: records, lambda p: records.select("block_number").distinct(), folder=workdir
    )
    counts = global_counts(pipeline).first()
    assert "history" not in pipeline._stages
    assert counts.history_rows == pipeline.history.count() == 3
    assert tuple(counts) == tuple(global_counts(pipeline).first())
