"""Ledger entity analytics on Spark: flatten, unspent outputs, owners, balances over time."""

from coinstrata.operators.balances import entity_balances, top_holders
from coinstrata.operators.clustering import (
    cluster_addresses,
    enrich_clustering_inputs,
    graph_vertices,
    star_edges,
    tx_address_sets,
)
from coinstrata.operators.components import connected_components
from coinstrata.operators.distribution import data_summary, get_data_summary
from coinstrata.operators.entity_index import EntityIndex
from coinstrata.operators.flatten import explode_inputs, explode_outputs
from coinstrata.operators.history import balance_events, balance_timeline, utxo_history
from coinstrata.operators.keyed import KeyedLedger
from coinstrata.operators.periods import TimelineIndex
from coinstrata.operators.utxo import compute_utxo_set
from coinstrata.operators.utxo_state import UtxoState
from coinstrata.plans.pipeline import LedgerPipeline
from coinstrata.session import create_spark_session
from coinstrata.sources.ingest import ingest, ingested
from coinstrata.sources.json_export import load_blocks, load_transactions, quarantined
from coinstrata.sources.lookup import lookup, write_lookup
from coinstrata.sources.snapshots import load_snapshot, save_snapshot
from coinstrata.sources.tables import load_results, save_results

__all__ = [
    "EntityIndex",
    "KeyedLedger",
    "LedgerPipeline",
    "TimelineIndex",
    "UtxoState",
    "balance_events",
    "balance_timeline",
    "cluster_addresses",
    "compute_utxo_set",
    "connected_components",
    "create_spark_session",
    "data_summary",
    "enrich_clustering_inputs",
    "entity_balances",
    "explode_inputs",
    "explode_outputs",
    "get_data_summary",
    "graph_vertices",
    "ingest",
    "ingested",
    "load_blocks",
    "load_results",
    "load_snapshot",
    "load_transactions",
    "lookup",
    "quarantined",
    "save_results",
    "save_snapshot",
    "star_edges",
    "top_holders",
    "tx_address_sets",
    "utxo_history",
    "write_lookup",
]
