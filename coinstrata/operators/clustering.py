"""From multi-input transactions to a co-spend graph and the address -> entity map."""

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.functions import percent, size_identity
from coinstrata.operators.components import connected_groups
from coinstrata.operators.spends import input_addresses, link_spends, within_input_bounds
from coinstrata.sources.tables import write_table


def enrich_clustering_inputs(
    tx_df: DataFrame, outputs_df: DataFrame, min_inputs: int = 2, max_inputs: int | None = None
) -> DataFrame:
    """(tx_hash, address) for every input with a known address of the transactions usable
    for clustering: not coinbase, and with at least ``min_inputs`` inputs. ``max_inputs``
    leaves out larger ones, which are mostly exchange payouts; nothing below depends on it.
    Filtered before anything is exploded.
    """
    usable = tx_df.filter(within_input_bounds(min_inputs, max_inputs))
    return input_addresses(link_spends(usable, outputs_df))


def tx_address_sets(clustering_inputs: DataFrame, workdir: str, min_size: int = 2) -> DataFrame:
    """(tx_hash, address): the distinct input addresses of each transaction that has
    ``min_size`` of them. Rows rather than arrays, as a transaction may have any number.

    Two tables are written below ``workdir``, so that adaptive execution can split the join
    where one transaction holds much of them.
    """
    root = f"{workdir}/address-sets-{uuid.uuid4().hex}"
    members = clustering_inputs.select("tx_hash", "address").distinct()
    members = write_table(members, f"{root}/members")
    sizes = members.groupBy("tx_hash").agg(F.count(F.lit(1)).alias("n"))
    large = write_table(sizes.filter(F.col("n") >= min_size).select("tx_hash"), f"{root}/large")
    return members.join(large, "tx_hash", "left_semi").select("tx_hash", "address")


def graph_vertices(edges: DataFrame) -> DataFrame:
    """Ends of the edges; an address never spent with another one is not a vertex."""
    return (
        edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    )


def star_edges(clustering_inputs: DataFrame, workdir: str) -> DataFrame:
    """Smallest address of each transaction -> every other one.

    n - 1 edges instead of n(n - 1)/2, with the same components as the pairs. The smallest
    is found by an aggregation that combines in the map tasks and written below ``workdir``;
    the join has one row per transaction on its right, so that a transaction of any size can
    be split.
    """
    first = clustering_inputs.groupBy("tx_hash").agg(F.min("address").alias("src"))
    first = write_table(first, f"{workdir}/first-address-{uuid.uuid4().hex}")
    return (
        clustering_inputs.join(first, "tx_hash")
        .select("src", F.col("address").alias("dst"))
        .filter(F.col("src") < F.col("dst"))
        .distinct()
    )


def cluster_addresses(
    clustering_inputs: DataFrame, workdir: str, large: DataFrame | None = None
) -> DataFrame:
    """(address, entity_id): addresses linked by common spending share an entity.

    ``clustering_inputs`` is read twice; hand over a stage table.

    ``entity_id`` is the smallest address of the entity. Addresses never spent with
    another one have no entity; ``with_singletons`` adds them. ``large`` (tx_hash) are the
    transactions with too many inputs for one task, if they are known.
    """
    members = clustering_inputs.select(F.col("tx_hash").alias("group"), F.col("address").alias("id"))
    if large is not None:
        large = large.select(F.col("tx_hash").alias("group"))
    components = connected_groups(members, workdir, large)
    return components.select(F.col("id").alias("address"), F.col("component").alias("entity_id"))


def with_singletons(entities: DataFrame, addresses: DataFrame) -> DataFrame:
    """``entities`` plus every other address in ``addresses`` as its own entity."""
    alone = (
        addresses.select("address")
        .filter(F.col("address").isNotNull())
        .distinct()
        .join(entities, "address", "left_anti")
    )
    return entities.unionByName(alone.select("address", F.col("address").alias("entity_id")))


def clustering_summary(entities: DataFrame) -> DataFrame:
    """One row: addresses, entities and the reduction in percent."""
    sizes = entities.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    counts = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("address_count"),
        F.count(F.lit(1)).alias("entity_count"),
    )
    return counts.withColumn(
        "reduction_pct",
        percent(F.col("address_count") - F.col("entity_count"), F.col("address_count")),
    )


def entity_sizes(entities: DataFrame) -> DataFrame:
    """Addresses per entity. Unordered; see ``top_entities_by_size`` for the ranking."""
    return entities.groupBy("entity_id").agg(F.count(F.lit(1)).alias("address_count"))


def top_entities_by_size(sizes: DataFrame, k: int = 20) -> DataFrame:
    """The k largest entities, ranked, with the kind of owner their size suggests."""
    largest = sizes.orderBy(F.desc("address_count"), "entity_id").limit(k)
    # At most k rows reach this unpartitioned window.
    rank = F.row_number().over(Window.orderBy(F.desc("address_count"), "entity_id"))
    return largest.select(
        rank.alias("rank"),
        "entity_id",
        "address_count",
        size_identity(F.col("address_count")).alias("likely_identity"),
    )
