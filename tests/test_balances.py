import numpy as np
import pandas as pd
import pytest
from ledger_data import BTC, rows
from pyspark.sql import functions as F

from coinstrata import entity_balances, top_holders
from coinstrata.functions import (
    holder_category,
    holder_category_coarse,
    percent,
    rounded_btc,
    size_identity,
    to_btc,
)
from coinstrata.operators import balances as b


def utxos(spark, *items):
    data = [(f"t{i}", 0, int(value * BTC), addresses) for i, (value, addresses) in enumerate(items)]
    return spark.createDataFrame(
        data, "tx_hash string, output_index int, value long, addresses array<string>"
    )


def entities(spark, **address_to_entity):
    return spark.createDataFrame(
        list(address_to_entity.items()), "address string, entity_id string"
    )


def of_satoshi(spark, *satoshi):
    data = [(f"e{i:05}", s, 1, s / BTC) for i, s in enumerate(satoshi)]
    return spark.createDataFrame(
        data, "entity_id string, balance_satoshi long, utxo_count long, balance_btc double"
    )


def test_worked_example(spark):
    found = entity_balances(
        utxos(spark, (500, ["A"]), (300, ["B"]), (200, ["C"]), (50, ["D"])),
        entities(spark, A="1", B="1", C="1", D="2"),
    )
    assert rows(found) == [("1", 1000 * BTC, 3, 1000.0), ("2", 50 * BTC, 1, 50.0)]
    categories = b.category_statistics(found).collect()
    assert [tuple(c)[:4] for c in categories] == [
        ("Mega Whale (1000+ BTC)", 1, 1000.0, 3),
        ("Large (10-100 BTC)", 1, 50.0, 1),
    ]
    assert [c["entity_pct"] for c in categories] == [50.0, 50.0]
    assert sum(c["btc_pct"] for c in categories) == pytest.approx(100)


def test_output_with_two_addresses_counts_for_both(spark):
    both = utxos(spark, (10, ["A", "B"]))
    found = entity_balances(both, entities(spark, A="A", B="A"))
    assert rows(found, "entity_id", "balance_btc", "utxo_count") == [("A", 20.0, 2)]


def test_addresses_without_entity_or_outputs_without_address_are_left_out(spark):
    found = entity_balances(
        utxos(spark, (1, ["A"]), (2, ["Z"]), (3, []), (4, None)), entities(spark, A="A")
    )
    assert rows(found, "entity_id", "balance_btc") == [("A", 1.0)]


def test_ties_are_ranked_by_entity(spark):
    top = top_holders(of_satoshi(spark, 3, 5, 3, 5, 1).repartition(3), 4)
    assert rows(top, "rank", "entity_id") == [
        (1, "e00001"),
        (2, "e00003"),
        (3, "e00000"),
        (4, "e00002"),
    ]


def test_bucket_bounds(spark):
    satoshi = [1000 * BTC, 1000 * BTC - 1, 100 * BTC, 10 * BTC, 1 * BTC, BTC - 1]
    found = of_satoshi(spark, *satoshi).select(
        "entity_id",
        holder_category(F.col("balance_satoshi")),
        holder_category_coarse(F.col("balance_satoshi")),
    )
    assert [(r[1], r[2]) for r in sorted(found.collect())] == [
        ("Mega Whale (1000+ BTC)", "Mega Whale (1000+ BTC)"),
        ("Whale (100-1000 BTC)", "Whale (100-1000 BTC)"),
        ("Whale (100-1000 BTC)", "Whale (100-1000 BTC)"),
        ("Large (10-100 BTC)", "Large (10-100 BTC)"),
        ("Medium (1-10 BTC)", "Small/Medium (<10 BTC)"),
        ("Small (<1 BTC)", "Small/Medium (<10 BTC)"),
    ]


def test_size_identity_bounds(spark):
    sizes = spark.createDataFrame([(n,) for n in (1, 10, 11, 101, 1001, 10001)], "n long")
    assert [r[0] for r in sizes.orderBy("n").select(size_identity(F.col("n"))).collect()] == [
        "Casual user",
        "Casual user",
        "Active user or trader",
        "Merchant or service",
        "Mining pool",
        "Exchange",
    ]


def test_statistics_against_pandas(spark, workdir):
    rng = np.random.default_rng(7)
    for count in (30_000, 321, 2, 1):
        satoshi = [int(x) for x in rng.integers(0, 5000 * BTC, count)]
        balances = of_satoshi(spark, *satoshi)
        found = b.balance_statistics(balances, workdir).first()
        kept = pd.Series(satoshi) / BTC
        assert found["entity_count"] == count
        expected = [kept.min(), kept.median(), kept.mean(), kept.max()]
        assert list(found)[1:5] == pytest.approx(expected, abs=1e-4)
        assert found["median_btc"] == kept.median()
        bins = b.equal_width_histogram(balances, "balance_satoshi")
        assert bins.agg({"entity_count": "sum"}).first()[0] == count
    nothing = b.balance_statistics(of_satoshi(spark, 1).limit(0), workdir).first()
    assert nothing["entity_count"] == 0 and nothing["median_btc"] is None


def test_histogram_bounds_are_exact(spark):
    values = [0, 2 * 10**14 - 1, 10**16]
    found = b.equal_width_histogram(of_satoshi(spark, *values), "balance_satoshi")
    assert rows(found.filter("entity_count > 0"), "bin", "entity_count") == [(0, 2), (49, 1)]
    wide = of_satoshi(spark, -(2**63), 2**63 - 1, 0)
    assert b.equal_width_histogram(wide, "balance_satoshi").agg({"entity_count": "sum"}).first()[0] == 3


@pytest.mark.parametrize("values", [[5], [3, 3, 3], list(range(101)), [0, 1, 2, 49, 50, 997, 1000]])
def test_histogram_against_numpy(spark, values):
    found = b.equal_width_histogram(of_satoshi(spark, *values), "balance_satoshi").orderBy("bin")
    counts, edges = np.histogram(values, bins=50)
    got = found.collect()
    assert [r["entity_count"] for r in got] == list(counts)
    assert [r["bin_start"] for r in got] == pytest.approx(list(edges[:-1]))
    assert [r["bin_end"] for r in got] == pytest.approx(list(edges[1:]))


def test_empty_balances(spark):
    nothing = of_satoshi(spark, 1).limit(0)
    assert tuple(b.balance_totals(nothing).first()) == (0, None, None)
    assert tuple(b.mega_holder_concentration(nothing).first()) == (0, 0.0, 0.0, 0.0)
    assert tuple(b.top_holder_share(nothing).first()) == (20, 0.0, None)
    assert b.equal_width_histogram(nothing, "balance_satoshi").count() == 0


def test_total_beyond_the_long_range(spark):
    big = of_satoshi(spark, *[9 * 10**18] * 3)
    assert b.balance_totals(big).first()["total_btc"] == 2.7e11


def test_addresses_of_the_largest_entity(spark):
    unspent = utxos(spark, (5, ["A"]), (2, ["B"]), (6, ["D"]), (1, ["A"]))
    owners = entities(spark, A="A", B="A", C="A", D="D")
    largest = b.largest_entity(entity_balances(unspent, owners))
    assert rows(b.entity_addresses(owners, largest), "address") == [("A",), ("B",), ("C",)]
    by_address = b.holder_addresses(unspent, owners, largest)
    assert rows(by_address) == [("A", 6 * BTC, 2, 6.0), ("B", 2 * BTC, 1, 2.0)]
    assert rows(b.top_addresses(by_address, 1), "address") == [("A",)]


def test_amounts(spark):
    """0.5 + 0.3 in and 0.7 + 0.09 out leave a fee of 0.01."""
    one = spark.range(1)
    fee = F.lit(50_000_000 + 30_000_000 - 70_000_000 - 9_000_000)
    assert one.select(to_btc(fee)).first()[0] == 0.01
    assert one.select(rounded_btc(F.lit(-1_500_000), 2)).first()[0] == -0.02
    assert one.select(percent(F.lit(1), F.lit(0))).first()[0] is None
