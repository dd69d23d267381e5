"""Record layouts of a nested ledger export, one JSON object per line.

Field names and types are fixed values: they must equal what the exporter writes.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

INPUT_SCHEMA = StructType(
    [
        StructField("index", IntegerType()),
        StructField("spent_transaction_hash", StringType()),
        StructField("spent_output_index", IntegerType()),
        StructField("script_asm", StringType()),
        StructField("script_hex", StringType()),
        StructField("sequence", LongType()),
        StructField("required_signatures", IntegerType()),
        StructField("type", StringType()),
        StructField("addresses", ArrayType(StringType())),
        StructField("value", LongType()),
    ]
)

OUTPUT_SCHEMA = StructType(
    [
        StructField("index", IntegerType()),
        StructField("script_asm", StringType()),
        StructField("script_hex", StringType()),
        StructField("required_signatures", IntegerType()),
        StructField("type", StringType()),
        StructField("addresses", ArrayType(StringType())),
        StructField("value", LongType()),
    ]
)

TRANSACTION_SCHEMA = StructType(
    [
        StructField("hash", StringType(), nullable=False),
        StructField("size", IntegerType()),
        StructField("virtual_size", IntegerType()),
        StructField("version", IntegerType()),
        StructField("lock_time", LongType()),
        StructField("block_number", LongType()),
        StructField("block_hash", StringType()),
        StructField("block_timestamp", LongType()),
        StructField("is_coinbase", BooleanType()),
        StructField("index", IntegerType()),
        StructField("inputs", ArrayType(INPUT_SCHEMA)),
        StructField("outputs", ArrayType(OUTPUT_SCHEMA)),
        StructField("input_count", IntegerType()),
        StructField("output_count", IntegerType()),
        StructField("input_value", LongType()),
        StructField("output_value", LongType()),
        StructField("fee", LongType()),
        # Not the exporter's: which part of a transaction that was split; null is part 0.
        StructField("record_part", LongType()),
    ]
)

BLOCK_SCHEMA = StructType(
    [
        StructField("hash", StringType(), nullable=False),
        StructField("size", IntegerType()),
        StructField("stripped_size", IntegerType()),
        StructField("weight", IntegerType()),
        StructField("number", LongType()),
        StructField("version", IntegerType()),
        StructField("merkle_root", StringType()),
        StructField("timestamp", LongType()),
        StructField("nonce", StringType()),
        StructField("bits", StringType()),
        StructField("coinbase_param", StringType()),
        StructField("transaction_count", IntegerType()),
    ]
)


# What the operators use; scripts, signatures and sizes are most of an export's bytes.
_USED = {
    "hash",
    "block_number",
    "block_timestamp",
    "is_coinbase",
    "inputs",
    "outputs",
    "input_count",
    "output_count",
    "output_value",
    "fee",
    "record_part",
    "index",
    "spent_transaction_hash",
    "spent_output_index",
    "type",
    "addresses",
    "value",
}


def _slim(schema: StructType) -> StructType:
    """``schema`` without unused fields, also inside arrays of structs."""
    fields = []
    for field in schema:
        if field.name in _USED:
            kind = field.dataType
            if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
                kind = ArrayType(_slim(kind.elementType))
            fields.append(StructField(field.name, kind))
    return StructType(fields)


SLIM_TRANSACTION_SCHEMA = _slim(TRANSACTION_SCHEMA)
