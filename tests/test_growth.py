"""Ledgers that grow: entities by batches, the unspent set as a state, snapshots, layouts
by key, bad lines, files read once."""

import datetime as dt
import json
import random

import pyarrow.parquet as pq
import pytest
from ledger_data import BTC, output, rows, spend, transaction

from coinstrata import explode_inputs, explode_outputs, load_blocks, load_transactions
from coinstrata.functions.labels import HOLDER_CATEGORIES_COARSE
from coinstrata.operators import false_links, keyed, periods
from coinstrata.operators.clustering import cluster_addresses
from coinstrata.operators.entity_index import EntityIndex
from coinstrata.operators.history import balance_timeline, utxo_history
from coinstrata.operators.keyed import KeyedLedger
from coinstrata.operators.spends import link_spends
from coinstrata.operators.utxo import compute_utxo_set
from coinstrata.operators.utxo_state import UtxoState
from coinstrata.sources import ingest as ingesting
from coinstrata.sources.ingest import ingest, ingested, ingested_bad_lines, manifest
from coinstrata.sources.json_export import quarantine_counts, quarantined
from coinstrata.sources.lookup import lookup, write_lookup
from coinstrata.sources.snapshots import (
    commit,
    drop_old_snapshots,
    latest,
    load_snapshot,
    save_snapshot,
    versions,
)

INPUTS = "tx_hash string, address string"


def entities_by_hand(pairs):
    """{address: smallest address of its entity}, for addresses that share a transaction."""
    of_tx = {}
    for tx, address in pairs:
        if tx is not None and address is not None:
            of_tx.setdefault(tx, set()).add(address)
    parent = {}

    def root(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for group in of_tx.values():
        if len(group) > 1:
            first, *rest = sorted(group)
            for other in rest:
                a, b = sorted((root(first), root(other)))
                parent[b] = a
    return {a: root(a) for a in parent}


def test_batches_give_the_same_entities_as_one_run(spark, workdir):
    rng = random.Random(1)
    batches = [
        [(f"t{b}-{rng.randrange(25)}", f"a{rng.randrange(90):02d}") for _ in range(40)] for b in range(5)
    ]
    batches[2] += [(None, "a01"), ("t2-1", None), ("alone", "zz")]
    index, seen, before = EntityIndex(spark, workdir), [], {}
    for number, batch in enumerate(batches, 1):
        assert index.add(spark.createDataFrame(batch, INPUTS)) == number
        seen += batch
        expected = entities_by_hand(seen)
        assert dict(rows(index.entities())) == expected
        renamed = {(e, expected[a], number) for a, e in before.items() if e != expected[a]}
        assert set(rows(index.merges.filter(f"batch = {number}"))) == renamed
        before = expected
        if number == 3:
            index.compact()
            assert index.renames.isEmpty() and dict(rows(index.entities())) == expected
    again = EntityIndex(spark, workdir)
    assert again.batches == 5 and dict(rows(again.entities())) == before
    members = spark.createDataFrame(seen, INPUTS)
    once = cluster_addresses(members.dropna(), workdir)
    assert dict(rows(once.select("address", "entity_id"))) == before


def test_a_small_batch_writes_little_and_repeats_change_nothing(spark, workdir):
    many = [(f"t{i // 2}", f"a{i:05d}") for i in range(4000)]
    index = EntityIndex(spark, workdir)
    index.add(spark.createDataFrame(many, INPUTS))
    small = spark.createDataFrame([("x", "a00001"), ("x", "a03999"), ("x", "new"), ("y", "a00007")], INPUTS)
    index.add(small)
    parts = index._state["labels"]
    assert [spark.read.parquet(f"{workdir}/{p}").count() for p in parts] == [4000, 1]
    assert rows(index.merges) == [("a03998", "a00000", 2)]
    assert rows(index.renames) == [("a03998", "a00000")]
    entities = rows(index.entities())
    index.add(small)
    assert rows(index.entities()) == entities and len(rows(index.merges)) == 1


def test_an_index_without_transactions(spark, workdir):
    index = EntityIndex(spark, workdir)
    assert index.entities().isEmpty() and index.merges.isEmpty()
    index.add(spark.createDataFrame([], INPUTS))
    assert index.entities().isEmpty() and index.batches == 1


def test_a_failed_batch_leaves_the_index_as_it_was(spark, workdir, monkeypatch):
    index = EntityIndex(spark, workdir)
    index.add(spark.createDataFrame([("t", "a"), ("t", "b")], INPUTS))
    more = spark.createDataFrame([("u", "b"), ("u", "c")], INPUTS)

    def broken(*_):
        raise OSError("no more room")

    with monkeypatch.context() as patched:
        patched.setattr("coinstrata.operators.entity_index.commit", broken)
        with pytest.raises(OSError):
            index.add(more)
    assert rows(EntityIndex(spark, workdir).entities()) == [("a", "a"), ("b", "a")]
    assert index.add(more) == 2
    assert rows(index.entities()) == [("a", "a"), ("b", "a"), ("c", "a")]


@pytest.fixture
def blocks(ledger):
    """Flat outputs and inputs of blocks 1 to 12: chains of spends, references that come
    before their output or name none, a repeated one, and transactions without outputs."""
    rng = random.Random(3)
    txs = []
    for block in range(1, 13):
        for k in range(3):
            spent = [(f"t{rng.randrange(1, 14)}-{rng.randrange(3)}", rng.randrange(3)) for _ in range(2)]
            inputs = [spend(i, h, n) for i, (h, n) in enumerate(spent)]
            outputs = [output(i, 10 * block + i, [f"A{block}"]) for i in range(2)] if k else None
            txs.append(
                transaction(f"t{block}-{k}", outputs, inputs, at=block * 86400, coinbase=k == 2 and block % 2 == 0)
            )
    whole = ledger(*txs)
    return explode_outputs(whole), explode_inputs(whole)


KEY = ["tx_hash", "output_index"]


def test_any_sequence_of_apply_and_undo_is_a_rebuild(spark, workdir, blocks):
    outputs, inputs = blocks
    rng = random.Random(4)
    state, applied = UtxoState(spark, workdir), []

    def rebuilt():
        inside = " or ".join(f"block_number between {a} and {b}" for a, b in applied) or "false"
        return rows(compute_utxo_set(outputs.filter(inside), inputs.filter(inside)), *KEY, "value")

    settled = 0
    for _ in range(14):
        last = applied[-1][1] if applied else 0
        open_ = [r for r in applied if r[0] > settled]
        if last < 12 and (rng.random() < 0.6 or not open_):
            first, end = last + 1, min(12, last + rng.randint(1, 3))
            inside = f"block_number between {first} and {end}"
            state.apply(outputs.filter(inside), inputs.filter(inside), first, end)
            applied.append((first, end))
        elif rng.random() < 0.6 and open_:
            first = rng.choice(open_)[0]
            gone = state.undo(first)
            assert gone == [r for r in applied if r[0] >= first]
            applied = [r for r in applied if r[0] < first]
        elif open_:
            settled = open_[0][1]
            state.settle(settled)
        if applied:
            assert rows(state.unspent(), *KEY, "value") == rebuilt()
        assert state.ranges == [r for r in applied if r[0] > settled]
    assert rows(UtxoState(spark, workdir).unspent(), *KEY, "value") == rebuilt()


def test_ranges_must_follow_and_settled_ones_stay(spark, workdir, blocks):
    outputs, inputs = blocks
    state = UtxoState(spark, workdir)
    with pytest.raises(ValueError, match="no blocks"):
        state.unspent()
    for first in (1, 4, 7):
        inside = f"block_number between {first} and {first + 2}"
        state.apply(outputs.filter(inside), inputs.filter(inside), first, first + 2)
    with pytest.raises(ValueError, match="follow"):
        state.apply(outputs, inputs, 9, 10)
    with pytest.raises(ValueError, match="begins at block 5"):
        state.undo(5)
    state.settle(3)
    with pytest.raises(ValueError, match="begins at block 1"):
        state.undo(1)
    assert state.ranges == [(4, 6), (7, 9)] and state.last_block == 9
    early, late = "block_number <= 6", "block_number <= 9"
    before = compute_utxo_set(outputs.filter(early), inputs.filter(early))
    after = compute_utxo_set(outputs.filter(late), inputs.filter(late))
    lost = set(rows(before, *KEY)) - set(rows(after, *KEY))
    assert set(rows(state.spent_since(7), *KEY)) == lost


def test_snapshots_appear_whole(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "results")
    one, two = spark.range(3), spark.range(5)
    assert save_snapshot(base, a=one, b=one) == 0
    reader = load_snapshot(spark, base, "a")
    from coinstrata.sources import snapshots

    written = []
    plain = snapshots.write_table

    def failing(df, path):
        if written:
            raise OSError("lost")
        written.append(path)
        return plain(df, path)

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "write_table", failing)
        with pytest.raises(OSError):
            save_snapshot(base, a=two, b=two)
    assert written and versions(spark, base) == [0]
    assert load_snapshot(spark, base, "a").count() == load_snapshot(spark, base, "b").count() == 3
    assert save_snapshot(base, a=two, b=two) == 1
    assert load_snapshot(spark, base, "b").count() == 5 and reader.count() == 3
    assert load_snapshot(spark, base, "b", version=0).count() == 3
    with pytest.raises(ValueError, match="no table c"):
        load_snapshot(spark, base, "c")
    with pytest.raises(ValueError, match="no snapshot"):
        load_snapshot(spark, str(tmp_path / "nothing"), "a")
    assert drop_old_snapshots(spark, base, keep=1) == [0] and versions(spark, base) == [1]
    assert load_snapshot(spark, base, "a").count() == 5


def test_only_one_writer_gets_a_number(spark, tmp_path):
    base = str(tmp_path / "state")
    commit(spark, base, 0, {"by": "first"})
    with pytest.raises(Exception, match="(?i)exist"):
        commit(spark, base, 0, {"by": "second"})
    assert latest(spark, base) == (0, {"by": "first"})
    assert latest(spark, str(tmp_path / "none")) == (-1, None)


@pytest.mark.parametrize("hot", [1, 10_000])
def test_joins_of_keyed_tables_need_no_shuffle(spark, workdir, ledger, blocks, hot):
    outputs, inputs = blocks
    records = ledger(
        transaction("a", [output(i, i, [f"A{i}"]) for i in range(6)], [spend(0, None, None)], coinbase=True),
        transaction("b", [output(0, 9, ["B"]), output(1, 8, [])], [spend(0, "a", 0, ["raw"]), spend(1, "a", 1)], at=1),
        transaction("c", None, [spend(0, "a", 0), spend(1, "a", 0), spend(2, "none", 4, ["R"])], at=2),
        transaction("d", [output(0, 1, ["D"])], [spend(0, None, 3), spend(1, "b", 1), spend(2, "a", 0)], at=3),
    )
    outputs, inputs = explode_outputs(records), explode_inputs(records)
    entities = spark.createDataFrame([("A0", "A0"), ("A1", "A0"), ("B", "B"), ("A5", "A5")], "address string, entity_id string")
    laid = KeyedLedger.write(spark, records, outputs, workdir, buckets=3, hot=hot)
    assert (laid._hot is not None) == (hot == 1)
    assert rows(laid.unspent()) == rows(compute_utxo_set(outputs, inputs))
    linked = link_spends(records, outputs)
    assert rows(laid.spends(), *linked.columns) == rows(linked)
    history = utxo_history(outputs, inputs, entities)
    assert rows(laid.history(entities), *history.columns) == rows(history)
    assert "Exchange" not in plan(laid.unspent())
    if hot != 1:
        assert "Exchange" not in plan(laid.spends())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_layout_of_an_empty_ledger(spark, workdir, ledger):
    empty = ledger(transaction("a", None, None)).limit(0)
    laid = KeyedLedger.write(spark, empty, explode_outputs(empty), workdir)
    assert laid.unspent().isEmpty() and laid.spends().isEmpty()
    assert keyed.HOT > 1


GOOD = {"hash": "g", "block_number": 1, "block_timestamp": 86400, "outputs": [{"index": 0, "value": 5}]}
LINES = [
    json.dumps(GOOD),
    json.dumps(GOOD)[:-9],
    json.dumps(GOOD | {"hash": "h", "block_number": "one"}),
    json.dumps({k: v for k, v in GOOD.items() if k != "hash"}),
    "",
    "   ",
    "not json",
    json.dumps(GOOD | {"hash": "k", "outputs": [{"index": "x"}]}),
    json.dumps(GOOD | {"hash": "e", "more": [1]}),
]
BAD = [(LINES[1], "torn"), (LINES[2], "mistyped"), (LINES[3], "no key"), ("not json", "torn"), (LINES[7], "mistyped")]


@pytest.fixture
def damaged(tmp_path):
    base = tmp_path / "damaged"
    for kind, lines in (("transactions", LINES), ("blocks", ['{"hash": "b", "number": 3, "timestamp": 5}', '{"number": {}}', "{"])):
        folder = base / "b1" / kind / "date=1970-01-02"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(lines))
    return base


@pytest.mark.parametrize("use_schema", [True, False])
@pytest.mark.parametrize("slim", [True, False])
def test_bad_lines_are_no_records(spark, damaged, use_schema, slim):
    found = load_transactions(spark, str(damaged), use_schema=use_schema, slim=slim)
    assert {r.hash for r in found.select("hash").collect()} >= {"g", "e"}
    assert found.filter("hash is null").count() == 0
    if use_schema:
        assert rows(found, "hash") == [("e",), ("g",)] and found.count() == 2
        assert explode_outputs(found).count() == 2
        assert "_bad_line" not in found.columns


def test_quarantine_and_records_are_all_lines(spark, damaged):
    bad = quarantined(spark, str(damaged))
    assert sorted((r.line, r.reason) for r in bad.collect()) == sorted(BAD)
    good = load_transactions(spark, str(damaged)).count()
    assert good + bad.count() == sum(1 for line in LINES if line.strip())
    counts = rows(quarantine_counts(bad))
    assert [(f.rsplit("/", 1)[1], reason, n) for f, reason, n in counts] == [
        ("part.json", "mistyped", 2), ("part.json", "no key", 1), ("part.json", "torn", 2)
    ]
    assert rows(load_blocks(spark, str(damaged)), "number") == [(3,)]
    assert sorted(r.reason for r in quarantined(spark, str(damaged), "blocks").collect()) == ["mistyped", "torn"]


def test_other_ways_with_bad_lines(spark, damaged):
    kept = load_transactions(spark, str(damaged), bad_lines="keep")
    assert kept.count() == 7 and kept.filter("hash is null").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        load_transactions(spark, str(damaged), bad_lines="fail").collect()
    with pytest.raises(ValueError, match="bad_lines"):
        load_transactions(spark, str(damaged), bad_lines="skip")


def put(base, batch, day, name, *hashes):
    folder = base / batch / "transactions" / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(GOOD | {"hash": h}) for h in hashes))


def test_every_file_is_read_once(spark, tmp_path):
    base, target = tmp_path / "export", str(tmp_path / "read")
    put(base, "b1", "1970-01-02", "p1.json", "a", "b")
    assert ingest(spark, str(base), target) == 1
    assert ingest(spark, str(base), target) == 0
    put(base, "b1", "1970-01-02", "p2.json", "c")  # late, in a folder that was read
    put(base, "b2", "1970-01-01", "p1.json", "d")  # a batch and a day that were not there
    (base / "b2" / "transactions" / "date=1970-01-01" / "p3.json").write_text(LINES[1])
    assert ingest(spark, str(base), target) == 1
    found = ingested(spark, target)
    assert rows(found, "hash") == [(h,) for h in "abcd"]
    assert rows(found, "hash", "block_number", "date", "block_datetime") == rows(
        load_transactions(spark, str(base)), "hash", "block_number", "date", "block_datetime"
    ) or rows(found, "hash") == rows(load_transactions(spark, str(base)), "hash")
    files = [(r.path.rsplit("/", 1)[1], r.run, r.lines) for r in manifest(spark, target).collect()]
    assert sorted(files) == [("p1.json", 0, 2), ("p1.json", 1, 1), ("p2.json", 1, 1), ("p3.json", 1, 1)]
    assert [r.line for r in ingested_bad_lines(spark, target).collect()] == [LINES[1]]
    assert ingested(spark, str(tmp_path / "nothing")).isEmpty()


def test_an_interrupted_run_repeats_nothing(spark, tmp_path, monkeypatch):
    base, target = tmp_path / "export", str(tmp_path / "read")
    for i in range(4):
        put(base, "b1", "1970-01-02", f"p{i}.json", f"h{i}")
    from pyspark.sql import DataFrameWriter

    plain, calls = DataFrameWriter.parquet, []

    def failing(self, path, *args, **kwargs):
        plain(self, path, *args, **kwargs)
        calls.append(path)
        if len(calls) == 2:  # after it was written, before the checkpoint knows
            raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(DataFrameWriter, "parquet", failing)
        with pytest.raises(Exception, match="lost"):
            ingest(spark, str(base), target, files_per_run=1)
    ingest(spark, str(base), target, files_per_run=1)
    assert rows(ingested(spark, target), "hash") == [(f"h{i}",) for i in range(4)]
    assert sorted(r.run for r in manifest(spark, target).collect()) == [0, 1, 2, 3]
    assert ingesting._BAD == "_bad_line"


DAYS = "entity_id string, event_date date, daily_delta long, daily_inflow long, daily_outflow long"


@pytest.fixture
def daily(spark):
    rng = random.Random(5)
    made = []
    for entity in "ABCDE":
        balance = 0
        for day in sorted(rng.sample(range(700), 25)):
            change = rng.choice([-balance, -balance // 2, rng.randrange(1, 300) * BTC])
            balance += change
            made.append((entity, dt.date(2011, 1, 5) + dt.timedelta(day), change, max(change, 0), min(change, 0)))
    return spark.createDataFrame(made, DAYS)


@pytest.mark.parametrize("cuts", [[], [100], [3, 250, 251, 600], [699]])
def test_a_timeline_from_opening_balances_is_the_whole_one(spark, workdir, daily, cuts):
    index, first = periods.TimelineIndex(spark, workdir), dt.date(2011, 1, 5)
    ends = [first + dt.timedelta(d) for d in [*cuts, 10**4]]
    for before, last in zip([None, *ends], ends):
        inside = daily.filter(daily.event_date <= last)
        index.add(inside if before is None else inside.filter(inside.event_date > before), last)
    whole = balance_timeline(daily)
    assert rows(index.timeline(), *whole.columns) == rows(whole)
    assert rows(index.balances()) == rows(daily.groupBy("entity_id").agg({"daily_delta": "sum"}))
    with pytest.raises(ValueError, match="not after"):
        index.add(daily.limit(1), ends[-1] + dt.timedelta(1))
    assert periods.TimelineIndex(spark, workdir).last_day == ends[-1]


def test_categories_of_the_time(spark, daily):
    ends = periods.month_ends(daily)
    held = {}
    for r in daily.orderBy("event_date").collect():
        held.setdefault(r.entity_id, []).append((r.event_date, r.daily_delta))
    label = lambda sat: next(name for bound, name in HOLDER_CATEGORIES_COARSE if bound is None or sat >= bound * BTC)
    months = [(y, m) for y in range(2011, 2014) for m in range(1, 13)]
    last = max((d.year, d.month) for days in held.values() for d, _ in days)
    months = [m for m in months if min((d.year, d.month) for days in held.values() for d, _ in days) <= m <= last]
    expected, spans = {}, []
    for entity, days in held.items():
        before = None
        for y, m in months:
            done = [c for d, c in days if (d.year, d.month) <= (y, m)]
            if done:
                now = label(sum(done))
                total, n = expected.get((f"{y}-{m:02d}", now), (0, 0))
                expected[f"{y}-{m:02d}", now] = (total + sum(done), n + 1)
                if now != before:
                    spans.append((entity, now, dt.date(y, m, 1)))
                before = now
    got = {(r.year_month, r.category): (round(r.total_btc * BTC), r.entity_count) for r in periods.category_month_end_then(ends).collect()}
    assert got == expected
    assert rows(periods.category_intervals(ends), "entity_id", "category", "first_month") == sorted(spans, key=repr)
    open_ = periods.category_intervals(ends).filter("until is null")
    assert rows(open_, "entity_id") == [(e,) for e in "ABCDE"]


def parts_by_hand(pairs, least):
    """Bridges by taking each input away and looking what is still connected."""
    of_tx = {}
    for tx, address in pairs:
        of_tx.setdefault(tx, set()).add(address)

    def reach(start, without=None):
        seen, open_ = {start}, [start]
        while open_:
            a = open_.pop()
            for tx, group in of_tx.items():
                here = group - {without[1]} if without and tx == without[0] else group
                if a in here:
                    more = here - seen
                    seen |= more
                    open_ += more
        return seen

    out = set()
    for tx, group in of_tx.items():
        for a in group if len(group) > 1 else ():
            whole = reach(a)
            side = reach(a, (tx, a))
            if not side & (group - {a}):
                low = min(whole)
                n = len(whole) - len(side) if low in side else len(side)
                if min(n, len(whole) - n) >= least:
                    out.add((tx, a, low, n, len(whole) - n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_bridges_by_taking_inputs_away(spark, workdir, seed):
    rng = random.Random(seed)
    pairs = [(f"t{rng.randrange(22)}", f"a{rng.randrange(34):02d}") for _ in range(56)]
    pairs += [(f"c{i}", f"z{j}") for i in range(6) for j in (i, i + 1)]  # a chain
    pairs += [("big", f"y{i}") for i in range(6)] + [("ring", "y0"), ("ring", "y5"), ("ring2", "y1")]
    inputs = spark.createDataFrame(pairs, INPUTS)
    entities = cluster_addresses(inputs, workdir).select("address", "entity_id")
    for least in (1, 3):
        found = false_links.bridges(inputs, entities, workdir, least_size=least)
        assert rows(found, "tx_hash", "address", "entity_id", "cut_off", "rest") == parts_by_hand(pairs, least)
    none = false_links.bridges(inputs.limit(0), entities.limit(0), workdir)
    assert none.isEmpty()


def test_rounds_of_bridges_read_what_is_left(spark, workdir, monkeypatch):
    """One long chain among many short entities: late rounds don't read those again."""
    pairs = [(f"s{i}", f"b{i}-{j}") for i in range(100) for j in range(3)]
    pairs += [(f"c{i}", f"z{j:02d}") for i in range(5) for j in (i, i + 1)]
    inputs = spark.createDataFrame(pairs, INPUTS)
    entities = cluster_addresses(inputs, workdir).select("address", "entity_id")
    read = {}

    def note(df, path):
        for name in df.inputFiles():
            kind = next((k for k in ("both-ways", "ahead", "numbers") if f"/{k}" in name), None)
            if kind:
                read[kind] = read.get(kind, 0) + pq.read_metadata(name.removeprefix("file://")).num_rows

    def counted(df, path, write=false_links.write_counted):
        note(df, path)
        return write(df, path)

    def written(df, path, write=false_links.write_table):
        note(df, path)
        return write(df, path)

    monkeypatch.setattr(false_links, "write_counted", counted)
    monkeypatch.setattr(false_links, "write_table", written)
    found = false_links.bridges(inputs, entities, workdir)
    assert rows(found, "tx_hash", "address", "entity_id", "cut_off", "rest") == parts_by_hand(pairs, 1)
    # Each of the 11 rounds read all of them before.
    assert read["both-ways"] + read.get("ahead", 0) < 6 * 2 * len(pairs)
    assert "numbers" not in read  # joined once, not in each round up


def test_rounds_of_bridges_do_not_follow_the_depth(spark, workdir, monkeypatch):
    """A chain of 30 transactions took a table for each of 60 levels, down and up again."""
    pairs = [(f"c{i}", f"z{j:02d}") for i in range(30) for j in (i, i + 1)]
    inputs = spark.createDataFrame(pairs, INPUTS)
    entities = spark.createDataFrame([(f"z{j:02d}", "z00") for j in range(31)], "address string, entity_id string")
    written = []
    for name in ("write_counted", "write_table"):
        def noted(df, path, write=getattr(false_links, name)):
            written.append(path)
            return write(df, path)

        monkeypatch.setattr(false_links, name, noted)
    found = rows(false_links.bridges(inputs, entities, workdir, least_size=4), "tx_hash", "address", "cut_off", "rest")
    assert len(written) < 60
    # From z00 on, each transaction cuts off what comes after it, by either of its inputs.
    assert found == sorted((f"c{i}", f"z{j:02d}", 30 - i, i + 1) for i in range(3, 27) for j in (i, i + 1))


def test_bridges_of_large_transactions(spark, workdir):
    """Transactions with too many inputs for one task go by joins, with the same result."""
    rng = random.Random(3)
    pairs = [(f"t{rng.randrange(9)}", f"a{rng.randrange(30):02d}") for _ in range(34)]
    pairs += [("wide", f"a{i:02d}") for i in range(0, 30, 3)] + [("wide", f"y{i}") for i in range(4)] * 2
    inputs = spark.createDataFrame([*pairs, (None, "y0"), (None, "y1")], INPUTS)
    entities = cluster_addresses(inputs.filter("tx_hash is not null"), workdir).select("address", "entity_id")
    for large in ([], [("wide",), ("wide",), (None,), ("t3",)]):
        named = spark.createDataFrame(large, "tx_hash string")
        found = false_links.bridges(inputs, entities, workdir, large=named)
        assert rows(found, "tx_hash", "address", "entity_id", "cut_off", "rest") == parts_by_hand(pairs, 1)


def test_bridges_are_those_on_the_way_to_the_smallest_address(spark, workdir):
    """Of inputs that no longer hold the entity together, those its smallest address reaches."""
    pairs = [("t1", "a"), ("t1", "b"), ("t2", "c"), ("t2", "d"), ("t3", "d"), ("t3", "e"), ("u", "x"), ("u", "y"), ("u", "a")]
    inputs = spark.createDataFrame(pairs, INPUTS)
    known = [(address, "a") for address in "abcde"] + [("x", "x"), ("y", "x")]
    entities = spark.createDataFrame(known, "address string, entity_id string")
    found = false_links.bridges(inputs, entities, workdir)
    assert rows(found, "tx_hash", "address", "entity_id", "cut_off", "rest") == [
        ("t1", "a", "a", 1, 4), ("t1", "b", "a", 1, 4), ("u", "x", "x", 1, 1), ("u", "y", "x", 1, 1),
    ]


def test_a_mixing_transaction_is_named(spark, workdir):
    mixed = [("mix", 100_000)] * 6 + [("mix", 7), ("mix", 9)]
    plain = [("pay", 5), ("pay", 5), ("pay", 8), ("two", 3), ("two", 3), ("two", 3), ("two", 3), ("two", 3)]
    outputs = spark.createDataFrame([*mixed, *plain, ("mix", None), ("mix", 0)], "tx_hash string, value long")
    spent = [("mix", f"o{i}") for i in range(6)] + [("two", "o1"), ("two", "p1"), ("pay", "q")]
    inputs = spark.createDataFrame(spent + spent[:2], INPUTS)
    found = false_links.equal_output_transactions(outputs, inputs)
    assert rows(found) == [("mix", 100_000, 6, 6)]
    near = spark.createDataFrame([("mix", 100_000 + i) for i in range(6)], "tx_hash string, value long")
    assert false_links.equal_output_transactions(near, inputs).isEmpty()
    assert rows(false_links.equal_output_transactions(near, inputs, unit=1000)) == [("mix", 100_000, 6, 6)]
    kept = false_links.without_transactions(inputs, found)
    entities = dict(rows(cluster_addresses(kept, workdir).select("address", "entity_id")))
    assert entities == {"o1": "o1", "p1": "o1"}


def scanned(df):
    """The rows that a query returned, and those that its scan read."""
    found = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return found, leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    table = spark.range(4000).selectExpr("concat('e', id % 400) AS entity_id", "concat('a', id) AS address")
    plain = str(tmp_path / "plain")
    table.repartition(20).write.parquet(plain)
    laid = write_lookup(table, str(tmp_path / "laid"), "entity_id", files=20)
    keys = spark.createDataFrame([("e7",), ("e7",), (None,), ("none",)], "k string")
    expected = sorted(f"a{i}" for i in range(7, 4000, 400))
    whole, read_plain = scanned(lookup(spark.read.parquet(plain), "entity_id", keys))
    found, read = scanned(lookup(laid, "entity_id", keys))
    assert sorted(r.address for r in found) == sorted(r.address for r in whole) == expected
    # Dictionaries let the plain table leave out files too, but keys are spread over many.
    assert read <= 400 < 800 <= read_plain
    joined = lookup(laid, "entity_id", keys, few=1)
    assert sorted(r.address for r in joined.collect()) == expected and joined.columns == laid.columns
    assert lookup(laid, "entity_id", keys.limit(0)).isEmpty()
