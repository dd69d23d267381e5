"""Entities that grow with the ledger, batch by batch.

Clustering all transactions again for every new block would read the whole ledger each
time. An index keeps what clustering found so far:

* ``labels`` (address, entity): each address with the name its entity had when the address
  was first seen, one part for each batch, never rewritten;
* ``renames`` (entity, current): the name of today for each name that has changed since;
* ``merges`` (entity, merged_into, batch): the log of what each batch joined.

A batch of transactions is contracted before it is clustered: an address that is known
stands for its entity, so the graph has the batch's edges only, however large the entities
behind them are. The labels are read once, to look the batch's addresses up; new addresses
are added and changed names replaced, and nothing else is written.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.operators.components import connected_groups
from coinstrata.session import own_folder
from coinstrata.sources.files import delete
from coinstrata.sources.snapshots import commit, latest
from coinstrata.sources.tables import write_table

_LABELS = "address string, entity string"
_RENAMES = "entity string, current string"
_MERGES = "entity string, merged_into string, batch long"


class EntityIndex:
    """The index in ``folder``. Each batch is one commit: a reader sees it whole or not at
    all, and a batch that failed can be run again."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.version, state = latest(spark, self.folder)
        self._state = state or {"labels": [], "renames": None, "merges": [], "batches": 0}

    @property
    def batches(self) -> int:
        return self._state["batches"]

    def _table(self, paths: list[str], schema: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{p}" for p in paths])

    @property
    def labels(self) -> DataFrame:
        return self._table(self._state["labels"], _LABELS)

    @property
    def renames(self) -> DataFrame:
        path = self._state["renames"]
        return self._table([path] if path else [], _RENAMES)

    @property
    def merges(self) -> DataFrame:
        """(entity, merged_into, batch): entities that a batch joined to others, or that got
        a smaller address and so another name."""
        return self._table(self._state["merges"], _MERGES)

    def entities(self) -> DataFrame:
        """(address, entity_id), as clustering everything at once gives."""
        return self.labels.join(self.renames, "entity", "left").select(
            "address", F.coalesce("current", "entity").alias("entity_id")
        )

    def add(self, clustering_inputs: DataFrame) -> int:
        """Add a batch of (tx_hash, address) and return its number, from 1. All inputs of a
        transaction belong to the same batch; null addresses are left out. A batch that is
        added twice changes nothing the second time."""
        batch, part = self.batches + 1, f"part-{uuid.uuid4().hex}"
        work = own_folder(self.spark, "entity-batch")
        members = clustering_inputs.select("tx_hash", "address").filter(
            F.col("tx_hash").isNotNull() & F.col("address").isNotNull()
        )
        members = write_table(members.distinct(), f"{work}/members")
        seen = write_table(members.select("address").distinct(), f"{work}/seen")
        # The one read of the labels: the addresses of the batch on the left, as the smaller
        # side, and one row for each address on the right.
        known = write_table(seen.join(self.labels, "address"), f"{work}/known")
        known = known.join(self.renames, "entity", "left").select(
            "address", F.coalesce("current", "entity").alias("node")
        )
        known = write_table(known, f"{work}/nodes")
        contracted = members.join(known, "address", "left").select(
            F.col("tx_hash").alias("group"), F.coalesce("node", "address").alias("id"), "address"
        )
        contracted = write_table(contracted, f"{work}/contracted")
        joined = connected_groups(contracted.select("group", "id").distinct(), work)
        joined = write_table(joined, f"{work}/joined")

        # An entity is named by its smallest address, so the smallest node names the whole.
        new = contracted.select("address", "id").distinct().filter("id = address")
        new = new.join(known, "address", "left_anti").join(joined, "id")
        new = new.select("address", F.col("component").alias("entity"))
        old = known.select(F.col("node").alias("id")).distinct()
        merged = joined.filter("id <> component").join(old, "id", "left_semi")
        merged = merged.select(F.col("id").alias("entity"), F.col("component").alias("merged_into"))
        merged = write_table(merged, f"{work}/merged")
        moved = merged.select(F.col("entity").alias("current"), F.col("merged_into").alias("_next"))
        renames = self.renames.join(moved, "current", "left").select(
            "entity", F.coalesce("_next", "current").alias("current")
        )
        renames = renames.unionByName(merged.withColumnRenamed("merged_into", "current"))

        state = dict(self._state, batches=batch)
        write_table(new, f"{self.folder}/{part}/labels")
        state["labels"] = [*state["labels"], f"{part}/labels"]
        if not merged.isEmpty():
            write_table(renames, f"{self.folder}/{part}/renames")
            logged = merged.withColumn("batch", F.lit(batch).cast("long"))
            write_table(logged, f"{self.folder}/{part}/merges")
            state["renames"] = f"{part}/renames"
            state["merges"] = [*state["merges"], f"{part}/merges"]
        commit(self.spark, self.folder, self.version + 1, state)
        self.version, self._state = self.version + 1, state
        delete(self.spark, work)
        return batch

    def compact(self) -> None:
        """Write the labels anew under the names of today, as one part without renames. The
        log of merges stays."""
        part = f"part-{uuid.uuid4().hex}"
        today = self.entities().withColumnRenamed("entity_id", "entity")
        write_table(today, f"{self.folder}/{part}/labels")
        state = dict(self._state, labels=[f"{part}/labels"], renames=None)
        commit(self.spark, self.folder, self.version + 1, state)
        self.version, self._state = self.version + 1, state
