"""The pipeline from transaction records to timelines, with shared stages written once.

A stage is a Parquet table below the session's checkpoint folder. It is computed on first
use, read by everything after it, and cuts the lineage: nothing upstream runs again when
an executor is lost. Steps without a shuffle (flattening, counting) are not staged, their
plans read the nested records with only the columns they need.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.functions import begin_of_day
from coinstrata.operators.balances import address_balances, entity_balances
from coinstrata.operators.clustering import (
    cluster_addresses,
    star_edges,
)
from coinstrata.operators.flatten import explode_inputs, explode_outputs
from coinstrata.operators.history import (
    balance_events,
    balance_timeline,
    daily_changes,
    owned_history,
)
from coinstrata.operators.skew import WINDOW_ROWS
from coinstrata.operators.spends import (
    input_addresses,
    link_outputs,
    linked_spends,
    spent_by_transaction,
    spent_outputs,
    unspent_outputs,
    within_input_bounds,
)
from coinstrata.session import own_folder
from coinstrata.sources.files import delete
from coinstrata.sources.json_export import first_part, load_blocks, load_transactions
from coinstrata.sources.orders_ledger import derive_blocks, derive_transactions
from coinstrata.sources.tables import save_results, write_table


#: The columns of the history that bookings are made of.
BOOKED = ["entity_id", "value", "created_timestamp", "spent_timestamp"]


def whole_records(records: DataFrame, nested: str) -> DataFrame:
    """Records whose ``nested`` array is to be flattened with outer semantics: a further
    part without elements must not add another row of nulls."""
    if "record_part" in records.columns:
        # Asking for one field rather than the whole array keeps the scan narrow.
        has_items = F.size(F.col(f"{nested}.index")) > 0
        return records.filter(first_part() | has_items)
    return records


class LedgerPipeline:
    """All tables of one ledger, in a new folder of its own below ``folder`` (default: the
    session's stage folder) that goes with ``drop``, or when the application ends.

    ``records`` are nested transactions. Where one transaction may span several records,
    they carry ``record_part`` and transaction-level figures use part 0.
    """

    def __init__(
        self,
        spark: SparkSession,
        records: Callable[["LedgerPipeline"], DataFrame],
        blocks: Callable[["LedgerPipeline"], DataFrame],
        folder: str | None = None,
        min_inputs: int = 2,
        max_inputs: int | None = None,
    ):
        self.spark = spark
        self.folder = own_folder(spark, "coinstrata", folder)
        self.min_inputs, self.max_inputs = min_inputs, max_inputs
        self._records, self._blocks = records, blocks
        self._stages: dict[str, DataFrame] = {}
        self._done: set[str] = set()

    @classmethod
    def from_orders(cls, spark: SparkSession, sf_dir: str, **options) -> "LedgerPipeline":
        """Ledger derived from the order tables in ``sf_dir``."""
        return cls(
            spark,
            records=lambda pipeline: derive_transactions(spark, sf_dir, pipeline.folder),
            blocks=lambda pipeline: derive_blocks(pipeline.transactions),
            **options,
        )

    @classmethod
    def from_export(cls, spark: SparkSession, base_path: str, **options) -> "LedgerPipeline":
        """Ledger read from a JSON export. Staging turns the text into Parquet once, with
        only the fields that some operator uses."""
        return cls(
            spark,
            records=lambda pipeline: load_transactions(spark, base_path, slim=True),
            blocks=lambda pipeline: load_blocks(spark, base_path),
            **options,
        )

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage table ``name``, built on first use."""
        if name not in self._stages:
            self._stages[name] = write_table(build(), f"{self.folder}/{name}")
        return self._stages[name]

    def once(self, name: str, write: Callable[[], None]) -> None:
        """Run ``write`` the first time ``name`` is asked for."""
        if name not in self._done:
            write()
            self._done.add(name)

    @property
    def records(self) -> DataFrame:
        return self.stage("records", lambda: self._records(self))

    @property
    def transactions(self) -> DataFrame:
        """One row per transaction."""
        records = self.records
        if "record_part" in records.columns:
            return records.filter(first_part())
        return records

    @property
    def blocks(self) -> DataFrame:
        return self.stage("blocks", lambda: self._blocks(self))

    def flat_outputs(self, *columns: str) -> DataFrame:
        """Flat outputs, all columns or the given ones."""
        return explode_outputs(whole_records(self.records, "outputs"), columns=list(columns))

    def flat_inputs(self, *columns: str) -> DataFrame:
        return explode_inputs(whole_records(self.records, "inputs"), columns=list(columns))

    @property
    def outputs(self) -> DataFrame:
        return self.flat_outputs()

    @property
    def inputs(self) -> DataFrame:
        return self.flat_inputs()

    @property
    def references(self) -> DataFrame:
        """Flat inputs with just what tells which outputs are spent."""
        return self.flat_inputs("is_coinbase", "spent_tx_hash", "spent_output_index")

    @property
    def links(self) -> DataFrame:
        """Inputs with the outputs they spend, and unspent outputs."""
        return self.stage(
            "links", lambda: link_outputs(self.records, self.outputs, self.references)
        )

    @property
    def utxos(self) -> DataFrame:
        return unspent_outputs(self.links)

    @property
    def spends(self) -> DataFrame:
        """Inputs with the outputs they spend, for clustering and for the history."""
        return linked_spends(self.links)

    @property
    def clustering_inputs(self) -> DataFrame:
        return input_addresses(
            self.spends.filter(within_input_bounds(self.min_inputs, self.max_inputs))
        )

    @property
    def edges(self) -> DataFrame:
        """The smallest address of each transaction with each other one."""
        return self.stage("edges", lambda: star_edges(self.clustering_inputs, self.folder))

    @property
    def entities(self) -> DataFrame:
        return self.stage(
            "entities",
            lambda: cluster_addresses(self.clustering_inputs, self.folder, self.large_spenders),
        )

    @property
    def large_spenders(self) -> DataFrame:
        """Transactions with more inputs than a window should sort."""
        return self.spends.filter(F.col("input_count") > WINDOW_ROWS).select("tx_hash")

    @property
    def address_balances(self) -> DataFrame:
        return address_balances(self.utxos)

    @property
    def entity_balances(self) -> DataFrame:
        return self.stage(
            "entity_balances", lambda: entity_balances(self.utxos, self.entities)
        )

    def _owned_history(self) -> DataFrame:
        return owned_history(spent_outputs(self.spends), self.utxos, self.entities)

    @property
    def history(self) -> DataFrame:
        return self.stage("history", self._owned_history)

    @property
    def unwritten_history(self) -> DataFrame:
        """The history, from its stage table only if that is there: for plans that need few of
        its columns."""
        return self._stages["history"] if "history" in self._stages else self._owned_history()

    @property
    def events(self) -> DataFrame:
        """Bookings of the history: from its stage table if that is there, else from one with
        just the columns that bookings are made of."""
        if "history" in self._stages:
            return balance_events(self.history)
        return balance_events(
            self.stage("bookings", lambda: self._owned_history().select(*BOOKED))
        )

    @property
    def daily(self) -> DataFrame:
        """Daily changes. The bookings are not written for them alone."""
        if {"history", "bookings"} & self._stages.keys():
            return self.stage("daily", lambda: daily_changes(self.events))
        return self.stage("daily", lambda: daily_changes(balance_events(self._owned_days())))

    def _owned_days(self) -> DataFrame:
        """The history's booked columns with days for times, which move in fewer bytes, and
        with one row for what a transaction spends."""
        within = within_input_bounds(self.min_inputs, self.max_inputs)
        spent = spent_by_transaction(self.spends.filter("has_source"), within)
        created = begin_of_day(F.col("block_timestamp"))
        unspent = self.utxos.withColumn("block_timestamp", created)
        return owned_history(spent, unspent, self.entities).select(*BOOKED)

    @property
    def timeline(self) -> DataFrame:
        return balance_timeline(self.daily)

    def save(self, base_path: str) -> dict[str, str]:
        """Write the result tables: outputs, inputs, utxos and entities."""
        return save_results(
            base_path,
            outputs=self.outputs,
            inputs=self.inputs,
            utxos=self.utxos,
            entities=self.entities,
        )

    def drop(self) -> None:
        """Delete the stage tables. DataFrames of this pipeline cannot be read afterwards."""
        self._stages.clear()
        self._done.clear()
        delete(self.spark, self.folder)
