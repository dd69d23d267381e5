"""Transactions that may join owners who are not the same.

Common spending links addresses by each transaction. Two kinds of links deserve a look:

* a transaction that is the only thing that holds two large parts of an entity together (a
  bridge in the graph of transactions and addresses);
* a transaction with many outputs of one value and many input addresses, as services make
  that mix the coins of strangers.
"""

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from coinstrata.sources.files import delete, visible_folders
from coinstrata.sources.tables import write_counted, write_table


# What tells the edges of the tree: transaction, address and the transaction's first address.
_INPUT = "t long, m long, first long"


def equal_output_transactions(
    outputs: DataFrame, clustering_inputs: DataFrame, least_equal: int = 5, least_addresses: int = 5,
    unit: int = 1,
) -> DataFrame:
    """(tx_hash, value, equal_outputs, input_addresses): transactions with ``least_equal``
    outputs or more of one value (of several such values the one with most, then the
    largest) and as many input addresses as ``least_addresses``. With a ``unit`` above 1
    values that differ by less than that, rounded down, are one."""
    rounded = (F.col("value") - F.col("value") % unit).alias("value")
    values = outputs.filter("value > 0").select("tx_hash", rounded).groupBy("tx_hash", "value").agg(F.count(F.lit(1)).alias("n"))
    values = values.filter(F.col("n") >= least_equal)
    most = F.max(F.struct("n", "value")).alias("most")
    equal = values.groupBy("tx_hash").agg(most)
    spenders = clustering_inputs.select("tx_hash", "address").distinct().groupBy("tx_hash")
    spenders = spenders.agg(F.count(F.lit(1)).alias("input_addresses"))
    spenders = spenders.filter(F.col("input_addresses") >= least_addresses)
    return equal.join(spenders, "tx_hash").select(
        "tx_hash", "most.value", F.col("most.n").alias("equal_outputs"), "input_addresses"
    )


def without_transactions(clustering_inputs: DataFrame, transactions: DataFrame) -> DataFrame:
    """``clustering_inputs`` without those of ``transactions`` (tx_hash)."""
    return clustering_inputs.join(transactions.select("tx_hash"), "tx_hash", "left_anti")


def bridges(
    clustering_inputs: DataFrame, entities: DataFrame, workdir: str, least_size: int = 1,
    large: DataFrame | None = None,
) -> DataFrame:
    """(tx_hash, address, entity_id, cut_off, rest): inputs without which an entity falls
    apart. Without ``address`` among the inputs of ``tx_hash`` the entity is two, of
    ``cut_off`` addresses (on the side away from the entity's smallest) and of ``rest``; both
    have ``least_size`` or more. ``large`` (tx_hash) are the transactions with too many inputs
    for one task, if they are known.

    Transactions and addresses are the vertices, inputs the edges. A spanning tree is grown by
    contraction: first each transaction moves to its first address, then in each round all
    vertices pick a neighbour, and those that no other vertex picked move to theirs, along an
    edge that becomes one of the tree. About half of the vertices go in a round, however deep
    the tree, so all rounds together move little more than the first ones.

    Every other edge gets a random number, which counts (by exclusive or) at both of its ends.
    The numbers of all edges of a tree edge's one side add up to those that lead out of it, and
    they must be the same for the tree edge: this is what the rounds, from the last to the first,
    find out for the edges on which vertices moved, since in its round a vertex knows the
    numbers of all its other edges. A tree edge that none leads past has 0 and is a bridge;
    another one has 0 once in 2^64. The addresses that a bridge cuts off are found alike: each
    sends one unit along the tree to the entity's smallest, which never moves.
    """
    root, spark = f"{workdir}/bridges-{uuid.uuid4().hex}", clustering_inputs.sparkSession
    # Numbers for texts; the smallest address of an entity has one below 0.
    number = F.monotonically_increasing_id()
    is_first = F.col("address") == F.col("entity_id")
    ids = write_table(
        entities.select("address", "entity_id", F.when(is_first, -1 - number).otherwise(number).alias("m")),
        f"{root}/addresses",
    )
    # An input is (t, m), transaction and address. Its edge (a, b) is followed both ways.
    stars = write_table(_stars(clustering_inputs, ids, large, root), f"{root}/both-ways")
    nothing = F.lit(0).cast("long")
    edges = stars.filter("a <> m").select(
        "a", F.col("m").alias("b"), "t", "m", F.col("a").alias("first"), nothing.alias("z")
    )

    rounds, gathered = [], None
    vertices, moved, firsts = 0, 0, 0
    while True:
        seed, seen = len(rounds), Observation()
        picks = _picks(edges, gathered, seed).observe(
            seen, F.count(F.lit(1)).alias("n"), F.count_if("moves").alias("moved"), F.count_if(F.col("v") < 0).alias("firsts")
        )
        picks = write_table(picks, f"{root}/picks-{seed}")
        if not rounds:
            vertices, firsts = seen.get["n"], seen.get["firsts"]
        moved += seen.get["moved"]
        moves = picks.filter("moves")
        rounds.append((edges, moves))
        edges, left = write_counted(_contracted(edges, moves), f"{root}/round-{seed + 1}")
        if not left:
            break
        place = F.when(F.col("moves"), F.col("w")).otherwise(F.col("v"))
        brought = F.sum(F.col("more") + F.when(F.col("moves"), 1).otherwise(0))
        gathered = picks.filter("moves or more > 0").groupBy(place.alias("v")).agg(brought.alias("more"))

    tree = None
    for i in range(len(rounds) - 1, -1, -1):
        write_table(_solved(*rounds[i], tree, i == 0), f"{root}/tree/round={i}")
        tree = spark.read.schema(f"{_INPUT}, x long, flow long").parquet(f"{root}/tree").drop("round")

    # The edges on which transactions moved, to their first addresses.
    side = F.when(F.col("a") != F.col("m"), _number()).otherwise(nothing)
    ends = stars.select("t", F.col("a").alias("first"), side.alias("x"), nothing.alias("flow")).unionByName(
        tree.select("t", "first", F.col("x").bitwiseXOR(_number()).alias("x"), "flow")
    )
    ends = ends.groupBy("t").agg(F.min("first").alias("m"), F.bit_xor("x").alias("x"), F.sum("flow").alias("flow"))
    cuts = tree.select(ends.columns).unionByName(ends).filter("x = 0")
    cuts = cuts.select("t", "m", F.abs("flow").alias("cut_off")).filter(F.col("cut_off") >= least_size)
    if least_size < 1 or vertices - moved != firsts:
        # Inputs that nothing links to the smallest address of their entity.
        cuts = cuts.join(_reached([moves for _, moves in rounds], ids, root), "m", "left_semi")
    cuts = write_table(cuts, f"{root}/cuts")
    for folder in visible_folders(spark, root):
        if not folder.endswith(("/addresses", "/both-ways", "/cuts")):
            delete(spark, folder)

    sizes = entities.groupBy("entity_id").agg(F.count(F.lit(1)).alias("size"))
    hashes = stars.filter("a = m").select("t", "tx_hash")
    found = cuts.join(ids, "m").join(hashes, "t").join(sizes, "entity_id").select(
        "tx_hash", "address", "entity_id", "cut_off", (F.col("size") - F.col("cut_off")).alias("rest")
    )
    return found.filter(F.col("rest") >= least_size)


def _stars(clustering_inputs: DataFrame, ids: DataFrame, large: DataFrame | None, root: str) -> DataFrame:
    """(tx_hash, t, a, m): the distinct inputs of known addresses, ``t`` the number of the
    transaction, ``a`` the first of its addresses. What a transaction has of one entity is a
    transaction of its own."""
    part = ["tx_hash", "part"]
    members = clustering_inputs.filter("tx_hash is not null").select("tx_hash", "address")
    members = members.join(ids, "address").select("tx_hash", F.xxhash64("entity_id").alias("part"), "m")
    if large is None:
        return _stars_by_join(members, part, root)
    large = write_table(large.select("tx_hash").distinct(), f"{root}/large")
    if large.isEmpty():
        return _stars_by_window(members, part)
    usual, rest = (members.join(large, "tx_hash", how) for how in ("left_anti", "left_semi"))
    return _stars_by_window(usual, part).unionByName(_stars_by_join(rest, part, root))


def _stars_by_window(members: DataFrame, part: list[str]) -> DataFrame:
    # The frames run along, so that no transaction is held in memory. Rows come out in order,
    # so a transaction has the number of its first one; even numbers, the joins use odd ones.
    in_tx = Window.partitionBy(*part).orderBy("m")
    ordered = members.select(
        "tx_hash", F.min("m").over(in_tx).alias("a"), "m", F.lag("m").over(in_tx).alias("before"),
        F.row_number().over(in_tx).alias("i"),
    )
    ordered = ordered.withColumn("t", 2 * (F.monotonically_increasing_id() - F.col("i") + 1))
    return ordered.filter("before is null or before < m").select("tx_hash", "t", "a", "m")


def _stars_by_join(members: DataFrame, part: list[str], root: str) -> DataFrame:
    members = write_table(members.distinct(), f"{root}/members")
    first = members.groupBy(*part).agg(F.min("m").alias("a"))
    first = write_table(first.withColumn("t", 2 * F.monotonically_increasing_id() + 1), f"{root}/first")
    return members.join(first, part).select("tx_hash", "t", "a", "m")


def _number() -> Column:
    """The random number of an edge."""
    return F.xxhash64("t", "m")


def _picks(edges: DataFrame, gathered: DataFrame | None, seed: int) -> DataFrame:
    """(v, w, k, m, first, more, moves): the neighbour that a vertex picks and the edge between
    them, ``k`` being its transaction, or -1 - that where v is on the transaction's side; the
    addresses that v stands for besides itself; and whether it moves to w.

    The pick is the neighbour that comes first in this round's order. Vertices move that
    nobody picked, and of two that only picked each other the later one, so none moves to
    a place that moves itself. Smallest addresses are first in any order.
    """
    ends = [("a", "b", -1 - F.col("t")), ("b", "a", F.col("t"))]
    # In the first round the ends are the edge's first and m.
    carried = ["w", "k"] if gathered is None else ["w", "k", "m", "first"]
    both_ways = edges.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.col(v).alias("v"), F.col(w).alias("w"), k.alias("k"), *carried[2:])
                    for v, w, k in ends
                ]
            )
        )
    ).withColumn("place", _order("w", seed))
    picks = both_ways.groupBy("v").agg(*[F.min_by(name, "place").alias(name) for name in carried])
    by = picks.groupBy(F.col("w").alias("v")).agg(F.count(F.lit(1)).alias("by"), F.min("v").alias("picker"))
    each_other = (F.col("by") == 1) & (F.col("picker") == F.col("w")) & (_order("w", seed) < _order("v", seed))
    moves = (F.col("v") >= 0) & (F.col("by").isNull() | each_other)
    picks = picks.join(by, "v", "left")
    if gathered is None:
        m, first = (F.when(F.col("k") < 0, F.col(x)).otherwise(F.col(y)) for x, y in ("wv", "vw"))
        picks = picks.withColumns({"m": m, "first": first, "more": F.lit(0).cast("long")})
    else:
        picks = picks.join(gathered, "v", "left")
    more = F.coalesce("more", F.lit(0).cast("long")).alias("more")
    return picks.select("v", "w", "k", "m", "first", more, moves.alias("moves"))


def _order(vertex: str, seed: int) -> Column:
    # The hash of one number differs from those of all others.
    hashed = F.xxhash64(F.lit(seed), vertex)
    return F.when(F.col(vertex) < 0, F.lit(-(2**63))).otherwise(hashed)


def _contracted(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """Edges between the new places. Of those between the same two one stays, with the numbers
    of the others in ``z``."""
    for end in ("a", "b"):
        to = moves.select(F.col("v").alias(end), F.col("w").alias("to"))
        edges = edges.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    merged = edges.filter("a <> b").groupBy("a", "b").agg(
        F.min("t").alias("t"), F.min_by("m", "t").alias("m"), F.min_by("first", "t").alias("first"),
        F.bit_xor(F.col("z").bitwiseXOR(_number())).alias("z"),
    )
    return merged.withColumn("z", F.col("z").bitwiseXOR(_number()))


def _solved(edges: DataFrame, moves: DataFrame, tree: DataFrame | None, first_round: bool) -> DataFrame:
    """(t, m, first, x, flow): the edges on which vertices moved, with their numbers and the
    addresses that are sent along them, from ``m`` to ``t`` or below 0 the other way. ``tree``
    has those of later rounds."""
    nothing = F.lit(0).cast("long")
    if tree is None or first_round:
        known = edges.select("a", "b", F.col("z").bitwiseXOR(_number()).alias("x"), nothing.alias("flow"))
        if tree is not None:
            # Here their ends are known, so that what they have instead of their numbers can be added.
            x = F.col("x").bitwiseXOR(_number()).alias("x")
            known = known.unionByName(tree.select(F.col("first").alias("a"), F.col("m").alias("b"), x, "flow"))
    else:
        x, flow = F.coalesce("x", _number()), F.coalesce("flow", nothing)
        known = edges.join(tree.drop("first"), ["t", "m"], "left")
        known = known.select("a", "b", F.col("z").bitwiseXOR(x).alias("x"), flow.alias("flow"))
    ends = known.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("v"), "x", "flow"),
                F.struct(F.col("b").alias("v"), "x", (-F.col("flow")).alias("flow")),
            )
        )
    )
    ends = ends.groupBy("v").agg(F.bit_xor("x").alias("x"), F.sum("flow").alias("flow"))
    on_tx_side = F.col("k") < 0
    t, sent = F.when(on_tx_side, -1 - F.col("k")).otherwise(F.col("k")), 1 + F.col("more") + F.col("flow")
    solved = moves.join(ends, "v").select(
        t.alias("t"), "m", "first", "x", F.when(on_tx_side, -sent).otherwise(sent).alias("flow")
    )
    # Its own number is among those of its end.
    return solved.withColumn("x", F.col("x").bitwiseXOR(_number()))


def _reached(moves: list[DataFrame], ids: DataFrame, root: str) -> DataFrame:
    """(m): the addresses that the smallest one of an entity stands for in the end."""
    reached = ids.filter("m < 0").select("m")
    for i in range(len(moves) - 1, -1, -1):
        there = reached.select(F.col("m").alias("w"))
        more = moves[i].join(there, "w", "left_semi").select(F.col("v").alias("m"))
        reached = write_table(reached.unionByName(more), f"{root}/reached-{i}")
    return reached
