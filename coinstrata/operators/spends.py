"""Inputs linked to the outputs they spend.

Clustering needs the addresses of a spent output, the history its value and age: the same
equi-join of inputs with outputs. A pipeline makes that join once and derives both.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.functions import begin_of_day, first_of, preferred_address, zip_fields
from coinstrata.operators.utxo import in_blocks, index_block, unspent_in_blocks

_REFERENCE = {"tx_hash": "source_tx_hash", "output_index": "source_output_index"}
_FACTS = {
    "value": "source_value",
    "addresses": "source_addresses",
    "block_timestamp": "created_timestamp",
}
SOURCE_KEY = list(_REFERENCE.values())
# What else there is to know of an output.
_CARRIED = {"block_number": "source_block_number", "output_type": "source_type"}
_PAID = {**_FACTS, **_CARRIED}
_UNSPENT = {
    name: {**_REFERENCE, **_PAID}[name]
    for name in [
        "tx_hash",
        "block_number",
        "block_timestamp",
        "output_index",
        "value",
        "addresses",
        "output_type",
    ]
}

#: The index that inputs without a reference refer to.
NO_OUTPUT = -1


def reference_rows(tx_df: DataFrame) -> DataFrame:
    """One row per input of a non-coinbase transaction, with the key of the output it spends.

    Inputs without a reference would all land in one partition with their null keys, so they
    get one of their own that no output has.
    """
    item = zip_fields("inputs", "spent_transaction_hash", "spent_output_index", "addresses")
    complete = (
        F.col("i.spent_transaction_hash").isNotNull() & F.col("i.spent_output_index").isNotNull()
    )
    return (
        tx_df.filter(F.col("is_coinbase") == F.lit(False))
        .select(
            F.col("hash").alias("tx_hash"),
            F.col("block_timestamp").alias("spent_timestamp"),
            "input_count",
            F.explode(item).alias("i"),
        )
        .select(
            "tx_hash",
            "spent_timestamp",
            "input_count",
            F.when(complete, F.col("i.spent_transaction_hash"))
            .otherwise(F.col("tx_hash"))
            .alias("source_tx_hash"),
            F.when(complete, F.col("i.spent_output_index"))
            .otherwise(NO_OUTPUT)
            .alias("source_output_index"),
            first_of(F.col("i.addresses")).alias("raw_address"),
        )
    )


def sources(outputs_df: DataFrame) -> DataFrame:
    """Outputs as sources of spends. Of ``outputs_df`` the key is needed; value, addresses
    and time are taken if present."""
    renamed = {**_REFERENCE, **_FACTS}
    return outputs_df.filter(F.col("output_index").isNotNull()).select(
        *[F.col(name).alias(renamed[name]) for name in renamed if name in outputs_df.columns],
        F.lit(True).alias("has_source"),
    )


def with_sources(references: DataFrame, found: DataFrame) -> DataFrame:
    """``references`` with the ``sources`` of their keys. ``has_source`` is false for an
    input without a matching output. Inputs are on the left, so that an output referred to
    again and again can be split."""
    return references.join(found, SOURCE_KEY, "left").withColumn(
        "has_source", F.coalesce("has_source", F.lit(False))
    )


def link_spends(tx_df: DataFrame, outputs_df: DataFrame) -> DataFrame:
    """One row per input of a non-coinbase transaction with the output it spends.

    Rows meet by transaction and block of indexes, see ``index_block``; within a block they
    are compared by the index itself."""
    known = [name for name in [*_REFERENCE, *_FACTS] if name in outputs_df.columns]
    return _linked(reference_rows(tx_df), in_blocks(outputs_df.select(known)))


def _linked(references: DataFrame, dealt: DataFrame) -> DataFrame:
    """``references`` with the outputs of ``in_blocks`` that they refer to."""
    # The outputs keep their names up to the join, which else would need a shuffle of its own.
    # A difference, since an equation of both indexes would be taken for a key.
    same_index = F.col("source_output_index") - F.col("output_index") == 0
    linked = (
        references.withColumnRenamed("tx_hash", "spender")
        .withColumn("source_block", index_block(F.col("source_output_index")))
        .join(
            dealt,
            (F.col("source_tx_hash") == F.col("tx_hash"))
            & (F.col("source_block") == F.col("block"))
            & same_index,
            "left",
        )
    )
    return linked.select(
        *SOURCE_KEY,
        F.col("spender").alias("tx_hash"),
        *[name for name in references.columns if name not in [*SOURCE_KEY, "tx_hash"]],
        *[F.col(name).alias(new) for name, new in _PAID.items() if name in dealt.columns],
        F.col("output_index").isNotNull().alias("has_source"),
    )


def link_outputs(tx_df: DataFrame, outputs_df: DataFrame, inputs_df: DataFrame) -> DataFrame:
    """``link_spends`` and ``compute_utxo_set`` as one table: one row per input with the output
    it spends, and one per unspent output, whose columns of the input are null and whose
    ``unspent`` is true. ``linked_spends`` and ``unspent_outputs`` tell them apart.

    Both joins need all outputs dealt out by (transaction, block of indexes). In one plan
    they read the same shuffle, as long as they ask for the same columns and rows of it, so
    the outputs move once. Outputs without a key can't be spent and are not shuffled.
    """
    outputs_df = outputs_df.select(list(_UNSPENT))
    dealt = in_blocks(outputs_df)
    linked = _linked(reference_rows(tx_df), dealt)
    no_key = F.col("tx_hash").isNull() | F.col("output_index").isNull()
    unspent = unspent_in_blocks(dealt, inputs_df).drop("block").unionByName(outputs_df.filter(no_key))
    unspent = unspent.select(*[F.col(name).alias(new) for name, new in _UNSPENT.items()])
    return linked.withColumn("unspent", F.lit(False)).unionByName(
        unspent.withColumn("unspent", F.lit(True)), allowMissingColumns=True
    )


def linked_spends(links: DataFrame) -> DataFrame:
    """The rows of ``link_outputs`` that ``link_spends`` gives."""
    return links.filter(~F.col("unspent")).drop("unspent", *_CARRIED.values())


def unspent_outputs(links: DataFrame) -> DataFrame:
    """The unspent outputs among the rows of ``link_outputs``."""
    return links.filter("unspent").select(*[F.col(new).alias(name) for name, new in _UNSPENT.items()])


def spent_by_transaction(spends: DataFrame, clustered: Column) -> DataFrame:
    """Rows for ``owned_history`` with what was spent, added up: one row for each transaction
    and day on which its sources were created, with the smallest of their addresses. Times
    are days, there is no single output's key.

    All inputs of a transaction that takes part in the clustering (``clustered``) have one
    owner, so any of its addresses tells whose they are. Other rows are added up by address.
    Positive values are kept apart from others, so inflows and outflows stay the same.
    """
    spends = spends.withColumn("address", first_of(F.col("source_addresses")))
    together = clustered & F.col("tx_hash").isNotNull()
    return (
        spends.filter(F.col("address").isNotNull())
        .groupBy(
            F.when(together, F.col("tx_hash")).alias("spender"),
            F.when(together, F.lit(None)).otherwise(F.col("address")).alias("alone"),
            begin_of_day(F.col("created_timestamp")).alias("block_timestamp"),
            begin_of_day(F.col("spent_timestamp")).alias("spent_timestamp"),
            (F.col("source_value") > 0).alias("positive"),
        )
        .agg(F.sum("source_value").alias("value"), F.min("address").alias("address"))
        .select(
            F.lit(None).cast("string").alias("tx_hash"),
            F.lit(None).cast("int").alias("output_index"),
            "value",
            F.array("address").alias("addresses"),
            "block_timestamp",
            "spent_timestamp",
        )
    )


def within_input_bounds(min_inputs: int, max_inputs: int | None) -> Column:
    enough = F.col("input_count") >= min_inputs
    return enough if max_inputs is None else enough & (F.col("input_count") <= max_inputs)


def input_addresses(spends: DataFrame) -> DataFrame:
    """(tx_hash, address): the address of the spent output, else of the input record."""
    address = preferred_address(F.col("source_addresses"), F.array("raw_address"))
    return spends.select("tx_hash", address.alias("address")).filter(
        F.col("address").isNotNull()
    )


def spent_outputs(spends: DataFrame) -> DataFrame:
    """The linked outputs, named as in the flat output table, with their spending time."""
    original = {**_REFERENCE, **_FACTS}
    return spends.filter("has_source").select(
        *[F.col(new).alias(name) for name, new in original.items()], "spent_timestamp"
    )
