"""Unspent outputs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.functions import percent

BLOCK_BITS = 4


def spend_references(inputs_df: DataFrame, *extra: Column) -> DataFrame:
    """References to spent outputs, from transactions known not to be coinbase.

    Rows without a reference match nothing. They would all hash to one partition, so
    they are dropped before the shuffle.
    """
    return inputs_df.filter(
        (F.col("is_coinbase") == F.lit(False))
        & F.col("spent_tx_hash").isNotNull()
        & F.col("spent_output_index").isNotNull()
    ).select(
        F.col("spent_tx_hash").alias("tx_hash"),
        F.col("spent_output_index").alias("output_index"),
        *extra,
    )


def index_block(index: Column) -> Column:
    """The number of the block of 2 ** ``BLOCK_BITS`` output indexes that ``index`` lies in.

    Outputs of a transaction and references to them that are dealt out by (transaction, block)
    stay beside each other and move in a fraction of the bytes; a transaction of any size is
    still dealt to many tasks.
    """
    return F.shiftright(index, BLOCK_BITS)


def compute_utxo_set(outputs_df: DataFrame, inputs_df: DataFrame) -> DataFrame:
    """Outputs that no input refers to. Right only if every transaction is loaded.

    References are combined in the map tasks to one row per transaction and block of
    indexes, with a bit for each index, so repeated ones collapse before the shuffle and the
    anti-join has unique keys on its right.
    """
    return outputs_df.join(
        spent_bits(inputs_df),
        (F.col("tx_hash") == F.col("spent_tx_hash"))
        & (index_block(F.col("output_index")) == F.col("spent_block"))
        & _is_spent(),
        "left_anti",
    ).select(outputs_df.columns)


def in_blocks(outputs_df: DataFrame) -> DataFrame:
    """The outputs that have a key, with the ``block`` that they are dealt out by."""
    has_key = F.col("tx_hash").isNotNull() & F.col("output_index").isNotNull()
    keyed = outputs_df.filter(has_key).withColumn("block", index_block(F.col("output_index")))
    # Never null, but the joins below would ask for it, each in its own words.
    return keyed.filter(F.col("block").isNotNull())


def unspent_in_blocks(dealt: DataFrame, inputs_df: DataFrame) -> DataFrame:
    """``compute_utxo_set`` of ``in_blocks``."""
    return dealt.join(
        spent_bits(inputs_df),
        (F.col("tx_hash") == F.col("spent_tx_hash"))
        & (F.col("block") == F.col("spent_block"))
        & _is_spent(),
        "left_anti",
    ).select(dealt.columns)


def _bit() -> Column:
    """The bit of an output in its block."""
    place = F.col("output_index").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    return F.call_function("shiftleft", F.lit(1), place.cast("int"))


def _is_spent() -> Column:
    return F.col("spent_bits").bitwiseAND(_bit()) != 0


def spent_bits(inputs_df: DataFrame) -> DataFrame:
    """(spent_tx_hash, spent_block, spent_bits): which outputs of a block are referred to."""
    return (
        spend_references(inputs_df)
        .groupBy(
            F.col("tx_hash").alias("spent_tx_hash"),
            index_block(F.col("output_index")).alias("spent_block"),
        )
        .agg(F.bit_or(_bit()).alias("spent_bits"))
    )


def spent_summary(outputs_df: DataFrame, utxo_df: DataFrame) -> DataFrame:
    """One row: output, spent and unspent counts with their shares."""
    unspent = utxo_df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = outputs_df.agg(F.count(F.lit(1)).alias("output_count")).withColumn(
        "utxo_count", unspent
    )
    spent = F.col("output_count") - F.col("utxo_count")
    return counts.select(
        "output_count",
        spent.alias("spent_count"),
        "utxo_count",
        percent(spent, F.col("output_count")).alias("spent_pct"),
        percent(F.col("utxo_count"), F.col("output_count")).alias("utxo_pct"),
    )
