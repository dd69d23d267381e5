from ledger_data import output, rows, spend, transaction

from coinstrata import (
    cluster_addresses,
    connected_components,
    enrich_clustering_inputs,
    explode_outputs,
    graph_vertices,
    star_edges,
    tx_address_sets,
)
from coinstrata.operators.clustering import (
    clustering_summary,
    entity_sizes,
    top_entities_by_size,
    with_singletons,
)


def enriched(tx, **bounds):
    return rows(enrich_clustering_inputs(tx, explode_outputs(tx), **bounds))


def test_source_address_is_preferred(ledger):
    tx = ledger(
        transaction("src", [output(0, 1, ["S"]), output(1, 1, ["T", "U"])], coinbase=True),
        transaction("t", [], [spend(0, "src", 0, ["R"]), spend(1, "src", 1, None)]),
    )
    assert enriched(tx) == [("t", "S"), ("t", "T")]


def test_raw_address_when_the_source_is_unknown_or_names_none(ledger):
    tx = ledger(
        transaction("src", [output(0, 1, []), output(1, 1, None)], coinbase=True),
        transaction(
            "t",
            [],
            [
                spend(0, "gone", 0, ["X"]),
                spend(1, "gone", 1, None),
                spend(2, "gone", 2, []),
                spend(3, "src", 0, ["Y"]),
                spend(4, "src", 1, ["Z"]),
                spend(5, None, None, ["N"]),
            ],
        ),
    )
    assert enriched(tx) == [("t", "N"), ("t", "X"), ("t", "Y"), ("t", "Z")]


def test_input_count_bounds_use_the_field(ledger):
    def tx(count, coinbase=False):
        name = f"n{count}{coinbase}"
        inputs = [spend(0, "gone", 0, ["X"])]
        return transaction(name, [], inputs, input_count=count, coinbase=coinbase)

    every = ledger(tx(1), tx(2), tx(50), tx(51), tx(3, True), tx(4, None))
    assert enriched(every) == [("n2False", "X"), ("n50False", "X"), ("n51False", "X")]
    assert enriched(every, max_inputs=50) == [("n2False", "X"), ("n50False", "X")]
    assert enriched(every, min_inputs=1, max_inputs=2) == [("n1False", "X"), ("n2False", "X")]


def clustering_inputs(spark):
    pairs = [("1", "A"), ("1", "B"), ("1", "A"), ("2", "C"), ("2", "B"), ("3", "D"), ("3", "E")]
    return spark.createDataFrame([*pairs, ("4", "F")], "tx_hash string, address string")


def test_address_sets_and_stars(spark, workdir):
    sets = tx_address_sets(clustering_inputs(spark), workdir)
    assert rows(sets) == [(t, a) for t, both in (("1", "AB"), ("2", "BC"), ("3", "DE")) for a in both]
    edges = star_edges(clustering_inputs(spark), workdir)
    assert rows(edges) == [("A", "B"), ("B", "C"), ("D", "E")]
    assert rows(graph_vertices(edges)) == [("A",), ("B",), ("C",), ("D",), ("E",)]


def test_a_larger_set_is_one_star(spark, workdir):
    members = [("t", a) for a in "DCBA"]
    wide = spark.createDataFrame(members, "tx_hash string, address string")
    assert rows(tx_address_sets(wide, workdir, 4)) == [("t", a) for a in "ABCD"]
    assert tx_address_sets(wide, workdir, 5).count() == 0
    assert rows(star_edges(wide, workdir)) == [("A", "B"), ("A", "C"), ("A", "D")]


def test_entities(spark, workdir):
    entities = cluster_addresses(clustering_inputs(spark), workdir)
    expected = [("A", "A"), ("B", "A"), ("C", "A"), ("D", "D"), ("E", "D")]
    assert rows(entities) == expected
    everyone = spark.createDataFrame([("A",), ("F",), ("F",), (None,)], "address string")
    assert rows(with_singletons(entities, everyone)) == [*expected, ("F", "F")]

    assert tuple(clustering_summary(entities).first()) == (5, 2, 60.0)
    assert rows(entity_sizes(entities)) == [("A", 3), ("D", 2)]
    top = top_entities_by_size(entity_sizes(entities), 1)
    assert rows(top) == [(1, "A", 3, "Casual user")]


def test_pairs_and_stars_have_the_same_components(spark, workdir):
    inputs = clustering_inputs(spark)
    other = inputs.withColumnRenamed("address", "dst")
    pairs = inputs.join(other, "tx_hash").filter("address < dst").selectExpr("address src", "dst")
    by_pairs = connected_components(pairs, workdir)
    by_stars = connected_components(star_edges(inputs, workdir), workdir)
    assert rows(by_pairs) == rows(by_stars)
