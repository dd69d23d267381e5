"""Nested transactions to flat output and input rows. Narrow: no shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinstrata.functions import zip_fields

# Flat column -> field of the transaction, and flat column -> field of the nested item.
_OUTPUT_HEADER = {
    "tx_hash": "hash",
    "block_number": "block_number",
    "block_timestamp": "block_timestamp",
}
_OUTPUT_ITEM = {
    "output_index": "index",
    "value": "value",
    "addresses": "addresses",
    "output_type": "type",
}
_INPUT_HEADER = {**_OUTPUT_HEADER, "is_coinbase": "is_coinbase"}
_INPUT_ITEM = {
    "input_index": "index",
    "spent_tx_hash": "spent_transaction_hash",
    "spent_output_index": "spent_output_index",
    "addresses": "addresses",
    "value": "value",
}


def explode_outputs(
    tx_df: DataFrame, drop_empty: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """One row per output.

    A transaction without outputs gives one row of null output columns, unless
    ``drop_empty`` is set. ``columns`` picks some of the flat columns; the scan then
    reads only their fields.
    """
    return _flatten(tx_df, "outputs", _OUTPUT_HEADER, _OUTPUT_ITEM, drop_empty, columns)


def explode_inputs(
    tx_df: DataFrame, drop_empty: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """One row per input, with the reference to the output it spends. Options as above."""
    return _flatten(tx_df, "inputs", _INPUT_HEADER, _INPUT_ITEM, drop_empty, columns)


def _flatten(
    tx_df: DataFrame,
    nested: str,
    header: dict[str, str],
    item: dict[str, str],
    drop_empty: bool,
    columns: list[str] | None,
) -> DataFrame:
    wanted = columns or [*header, *item]
    # At least one field, to have something to count.
    fields = [item[name] for name in wanted if name in item] or ["index"]
    generate = F.explode if drop_empty else F.explode_outer
    return tx_df.select(
        *[F.col(header[name]).alias(name) for name in wanted if name in header],
        generate(zip_fields(nested, *fields)).alias("item"),
    ).select(
        *[F.col(f"item.{item[name]}").alias(name) if name in item else name for name in wanted]
    )
