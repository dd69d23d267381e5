"""Connected components by randomised contraction.

After Bögeholz, Brand and Todor, "In-database connected component analysis", ICDE 2020.
Each round every vertex picks the neighbour with the smallest hash under that round's
seed, then moves to the smaller-hashed of its pick and its pick's pick. Two vertices that
pick each other always meet, and so do all that picked one of them: a star collapses in
one round. Edges are rewritten to the new places and loops fall away. Any mapping within
a component is correct; the fresh hash per round makes long chains of picks unlikely, so
that a good part of the vertices disappears whatever the shape of the graph. Rounds get
smaller and smaller, and labels are handed back from the last round to the first.

Skew: the pick is a partial aggregation, so a hub with a third of all edges leaves each
map task as one row. All joins of a large graph are equi-joins of two written tables with
one row per vertex on the right, the shape whose oversized partitions adaptive execution
splits.
"""

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.sources.files import delete, visible_folders
from coinstrata.sources.tables import write_counted, write_table

# A label table is written out after this many joins, to keep plans short.
LEVELS_PER_WRITE = 6

def connected_components(edges: DataFrame, workdir: str) -> DataFrame:
    """(id, component) for the ends of undirected ``edges`` (src, dst).

    ``component`` is the smallest id of the component. Intermediate tables are written
    below ``workdir``, which must be a folder that all executors share; they also cut
    the lineage, so a lost executor costs at most the round being computed. In the end
    only the tables that the result reads are left there.
    """
    root = _new_folder(workdir)
    edges = edges.select("src", "dst").filter(
        F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))
    )
    edges = write_table(edges, f"{root}/edges")
    vertices = _numbered_ids(edges.select(F.explode(F.array("src", "dst")).alias("id")), root)
    numbered = (
        edges.join(vertices.select(F.col("id").alias("src"), F.col("v").alias("a")), "src")
        .join(vertices.select(F.col("id").alias("dst"), F.col("v").alias("b")), "dst")
        .select("a", "b")
    )
    return _components(numbered, vertices, root)


def connected_groups(
    members: DataFrame, workdir: str, large: DataFrame | None = None
) -> DataFrame:
    """(id, component) for ``members`` (group, id): ids that share a group are connected.

    The same as ``connected_components`` over the edges between a group's smallest id and
    its others, but ids turn into numbers first, so no edge is ever made of texts. An id
    that never shares a group is left out. Groups may be of any size: the smallest is an
    aggregation, and the join back to the members can be split.

    Where the groups of more members than one task should sort are known, ``large`` (group)
    names them; all others are shuffled once, to a window that streams over them.
    """
    root = _new_folder(workdir)
    vertices = _numbered_ids(members.select("id"), root)
    if large is None:
        return _components(_stars_by_join(members.join(vertices, "id"), root).distinct(), vertices, root)
    large = write_table(large.select("group").distinct(), f"{root}/large")
    if large.isEmpty():
        return _components(_stars_by_window(members.join(vertices, "id")), vertices, root)
    usual, rest = (members.join(large, "group", how) for how in ("left_anti", "left_semi"))
    stars = _stars_by_window(usual.join(vertices, "id")).unionByName(
        _stars_by_join(rest.join(vertices, "id"), root)
    )
    return _components(stars, vertices, root)


def _stars_by_join(numbered: DataFrame, root: str) -> DataFrame:
    """(a, b): the smallest number of a group with each larger one."""
    numbered = write_table(numbered.select("group", "v"), f"{root}/members-of")
    first = write_table(numbered.groupBy("group").agg(F.min("v").alias("a")), f"{root}/first")
    return (
        numbered.join(first, "group")
        .select("a", F.col("v").alias("b"))
        .filter(F.col("a") < F.col("b"))
    )


def _stars_by_window(numbered: DataFrame) -> DataFrame:
    """The same, each edge once for a group. The frames run along, so that no group is held
    in memory."""
    in_group = Window.partitionBy("group").orderBy("v")
    stars = numbered.filter(F.col("group").isNotNull()).select(
        F.min("v").over(in_group).alias("a"),
        F.col("v").alias("b"),
        F.lag("v").over(in_group).alias("before"),
    )
    return stars.filter(F.col("before") < F.col("b")).select("a", "b")


def _new_folder(workdir: str) -> str:
    return f"{workdir}/components-{uuid.uuid4().hex}"


def _numbered_ids(ids: DataFrame, root: str) -> DataFrame:
    """(v, id): a number for each distinct id.

    Numbers instead of texts make small shuffles and hash aggregation in the rounds. They
    depend on task layout, so they are only ever read from the written table.
    """
    numbers = ids.distinct().select(F.monotonically_increasing_id().alias("v"), "id")
    return write_table(numbers, f"{root}/vertices")


def _components(numbered: DataFrame, vertices: DataFrame, root: str) -> DataFrame:
    """(id, component) for the ends of the ``numbered`` edges (a, b)."""
    moves = []
    current, edge_count = write_counted(numbered, f"{root}/round-0")
    while edge_count > 0:
        seed = len(moves)
        # Written, since adaptive execution only splits sides that come straight from a
        # shuffle, and a hub's share of the joins below may need it.
        picks = write_table(_picks(current, seed), f"{root}/picks-{seed}")
        moves.append(write_table(_moves(picks, seed), f"{root}/moves-{seed}"))
        current, edge_count = write_counted(
            _rewrite(current, moves[-1]), f"{root}/round-{seed + 1}"
        )

    nobody = vertices.select("v", F.col("v").alias("label")).limit(0)
    labels = _labels(moves, root) if moves else nobody
    members = write_table(
        vertices.join(labels, "v").select("id", "label"), f"{root}/members"
    )
    names = write_table(
        members.groupBy("label").agg(F.min("id").alias("component")), f"{root}/names"
    )
    for folder in visible_folders(vertices.sparkSession, root):
        if not folder.endswith(("/members", "/names")):
            delete(vertices.sparkSession, folder)
    return members.join(names, "label").select("id", "component")


def _order(vertex: Column, seed: int) -> Column:
    # Of 32 bits, since it moves with each edge. Two vertices of one hash go by their numbers
    # in ``_moves``; the next round has another seed.
    return F.hash(vertex, F.lit(seed))


def _place(vertex: str, seed: int) -> Column:
    return F.struct(_order(F.col(vertex), seed), F.col(vertex))


def _picks(edges: DataFrame, seed: int) -> DataFrame:
    """v -> w: the neighbour of smallest hash."""
    both_ways = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("v"), F.col("b").alias("w")),
                F.struct(F.col("b").alias("v"), F.col("a").alias("w")),
            )
        )
    )
    return both_ways.groupBy("v").agg(F.min_by("w", _order(F.col("w"), seed)).alias("w"))


def _moves(picks: DataFrame, seed: int) -> DataFrame:
    """v -> r: the smaller-hashed of the pick and the pick's pick."""
    second = picks.select(F.col("v").alias("w"), F.col("w").alias("x"))
    first_is_smaller = _place("w", seed) <= _place("x", seed)
    return picks.join(second, "w").select(
        "v", F.when(first_is_smaller, F.col("w")).otherwise(F.col("x")).alias("r")
    )


def _rewrite(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """Edges between the new places, without loops and doubles."""
    return (
        edges.join(moves.select(F.col("v").alias("a"), F.col("r").alias("ra")), "a")
        .join(moves.select(F.col("v").alias("b"), F.col("r").alias("rb")), "b")
        .filter(F.col("ra") != F.col("rb"))
        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        .distinct()
    )


def _labels(moves: list[DataFrame], root: str) -> DataFrame:
    """v -> label of the first round's vertices. A place without edges left is final."""
    labels = moves[-1].select("v", F.col("r").alias("label"))
    for level in range(len(moves) - 2, -1, -1):
        later = labels.select(F.col("v").alias("r"), "label")
        labels = (
            moves[level]
            .join(later, "r", "left")
            .select("v", F.coalesce("label", "r").alias("label"))
        )
        if level % LEVELS_PER_WRITE == LEVELS_PER_WRITE - 1:
            labels = write_table(labels, f"{root}/labels-{level}")
    return labels
