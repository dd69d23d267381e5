"""Hand-made ledger records, and rows in a comparable order. A module of its own, as each
folder of tests has a ``conftest`` and only one of them can be imported by that name."""

from coinstrata.schemas import TRANSACTION_SCHEMA

BTC = 100_000_000


def output(index, value, addresses, kind=None):
    return {"index": index, "value": value, "addresses": addresses, "type": kind}


def spend(index, tx_hash, output_index, addresses=None, value=None):
    return {
        "index": index,
        "spent_transaction_hash": tx_hash,
        "spent_output_index": output_index,
        "addresses": addresses,
        "value": value,
    }


def transaction(tx_hash, outputs=None, inputs=None, at=0, coinbase=False, input_count=None, **more):
    return {
        "hash": tx_hash,
        "block_number": at // 86400,
        "block_timestamp": at,
        "is_coinbase": coinbase,
        "inputs": inputs,
        "outputs": outputs,
        "input_count": len(inputs or []) if input_count is None else input_count,
        "output_count": len(outputs or []),
        **more,
    }


def completed(items, field):
    if items is None:
        return None
    names = TRANSACTION_SCHEMA[field].dataType.elementType.names
    return [{**dict.fromkeys(names), **item} for item in items]


def rows(df, *columns):
    """Rows as sorted tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
