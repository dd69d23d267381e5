import random

import pytest
from ledger_data import rows
from pyspark.sql import functions as F

from coinstrata import connected_components
from coinstrata.operators import components
from coinstrata.operators.components import connected_groups


def brute_force(edges):
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        label[high] = low
    return sorted((x, root(x)) for x in label)


def random_graph(seed, vertices, edges):
    rng = random.Random(seed)
    drawn = [(rng.randrange(vertices), rng.randrange(vertices)) for _ in range(edges)]
    return [(f"v{a:05}", f"v{b:05}") for a, b in drawn if a != b]


GRAPHS = {
    "path": [(f"p{i:04}", f"p{i + 1:04}") for i in range(300)],
    "reversed path": [(f"p{i + 1:04}", f"p{i:04}") for i in range(300)],
    "cycle": [(f"c{i:03}", f"c{(i + 1) % 100:03}") for i in range(100)],
    "star": [("hub", f"leaf{i:04}") for i in range(1000)],
    "star of paths": [
        edge
        for i in range(30)
        for edge in [("m", f"a{i:02}"), (f"a{i:02}", f"b{i:02}"), (f"b{i:02}", f"c{i:02}")]
    ],
    "pairs": [(f"x{i:03}", f"y{i:03}") for i in range(200)],
    "sparse random": random_graph(1, 2000, 1500),
    "dense random": random_graph(2, 300, 2000),
    "doubles both ways": [("a", "b"), ("b", "a"), ("a", "b"), ("b", "c")],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_against_union_find(spark, workdir, name):
    edges = GRAPHS[name]
    found = connected_components(spark.createDataFrame(edges, "src string, dst string"), workdir)
    assert rows(found) == brute_force(edges)


def test_labels_written_between(spark, workdir, monkeypatch):
    monkeypatch.setattr(components, "LEVELS_PER_WRITE", 2)
    edges = GRAPHS["sparse random"]
    found = connected_components(spark.createDataFrame(edges, "src string, dst string"), workdir)
    assert rows(found) == brute_force(edges)


def test_edge_order_does_not_matter(spark, workdir):
    edges = random_graph(3, 500, 450)
    turned = [(b, a) for a, b in reversed(edges)]
    one, two = (
        connected_components(spark.createDataFrame(e, "src string, dst string"), workdir)
        for e in (edges, turned)
    )
    assert rows(one) == rows(two)


def test_loops_and_nulls_are_no_edges(spark, workdir):
    edges = spark.createDataFrame(
        [("a", "a"), ("b", None), (None, "c")], "src string, dst string"
    )
    assert connected_components(edges, workdir).count() == 0


def test_number_ids(spark, workdir):
    edges = spark.createDataFrame([(3, 2), (9, 3), (5, 7)], "src long, dst long")
    assert rows(connected_components(edges, workdir)) == [(2, 2), (3, 2), (5, 5), (7, 5), (9, 2)]


def test_groups(spark, workdir):
    rng = random.Random(4)
    groups = [[f"m{rng.randrange(400):03}" for _ in range(rng.randrange(1, 6))] for _ in range(150)]
    members = [(f"g{i}", m) for i, group in enumerate(groups) for m in group]
    edges = [(g[0], other) for g in groups for other in g[1:] if other != g[0]]
    found = connected_groups(spark.createDataFrame(members, "group string, id string"), workdir)
    assert rows(found) == brute_force(edges)


def test_no_shared_group(spark, workdir):
    members = spark.createDataFrame([("g", "a"), ("g", "a"), ("h", "b")], "group string, id string")
    assert connected_groups(members, workdir).count() == 0


def test_vertices_of_one_hash_meet(spark, monkeypatch):
    monkeypatch.setattr(components, "_order", lambda vertex, seed: F.lit(7))
    picks = spark.createDataFrame([(1, 2), (2, 1), (3, 2)], "v long, w long")
    assert rows(components._moves(picks, 0)) == [(1, 1), (2, 1), (3, 1)]
