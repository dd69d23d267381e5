"""The unspent set as a state that follows the chain, and goes back with it.

The set is a base table and a list of block ranges on top of it. A range is what its blocks
made and what they spent; applying one adds two tables of the range's own size, undoing the
last one takes it off the list, so a reorganisation costs nothing but the blocks that take
its place. ``settle`` folds ranges that cannot be undone any more into the base.

The set is what an anti-join of all outputs with all references gives. A reference may come
before its output, or name none at all: the base keeps references that found no output yet.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.operators.utxo import spend_references
from coinstrata.sources.snapshots import commit, latest
from coinstrata.sources.tables import write_table

_KEY = ["tx_hash", "output_index"]


class UtxoState:
    """The state in ``folder``. Every change is one commit; readers keep the one they have."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.version, state = latest(spark, self.folder)
        self._state = state or {"base": None, "waiting": None, "ranges": [], "settled": None}

    @property
    def ranges(self) -> list[tuple[int, int]]:
        """First and last block of each range that can be undone, in order."""
        return [(r["first"], r["last"]) for r in self._state["ranges"]]

    @property
    def last_block(self) -> int | None:
        ranges = self.ranges
        return ranges[-1][1] if ranges else self._state["settled"]

    def _read(self, paths: list[str | None]) -> DataFrame | None:
        paths = [f"{self.folder}/{p}" for p in paths if p]
        return self.spark.read.parquet(*paths) if paths else None

    def apply(self, outputs: DataFrame, inputs: DataFrame, first: int, last: int) -> None:
        """Add the blocks ``first`` to ``last``: their flat outputs and inputs. Ranges follow
        each other; they need not touch."""
        before = self.last_block
        if last < first or (before is not None and first <= before):
            raise ValueError(f"blocks {first} to {last} don't follow block {before}")
        part = f"range-{uuid.uuid4().hex}"
        refs = spend_references(inputs).distinct()
        write_table(outputs, f"{self.folder}/{part}/created")
        write_table(refs, f"{self.folder}/{part}/spent")
        entry = {"first": first, "last": last, "created": f"{part}/created", "spent": f"{part}/spent"}
        self._commit(ranges=[*self._state["ranges"], entry])

    def undo(self, first: int) -> list[tuple[int, int]]:
        """Take off the ranges from block ``first`` on, and return them. ``first`` must be
        where a range begins, and must not be settled."""
        kept = [r for r in self._state["ranges"] if r["last"] < first]
        gone = self.ranges[len(kept) :]
        if not gone or gone[0][0] != first:
            raise ValueError(f"no range that can be undone begins at block {first}")
        self._commit(ranges=kept)
        return gone

    def settle(self, last: int) -> None:
        """Fold the ranges up to block ``last`` into the base."""
        ranges = self._state["ranges"]
        done = [r for r in ranges if r["last"] <= last]
        if not done:
            return
        part = f"base-{uuid.uuid4().hex}"
        created, spent = self._created(done), self._spent(done)
        write_table(self._unspent(created, spent), f"{self.folder}/{part}/unspent")
        # References that no output has answered so far.
        waiting = spent.join(created.select(_KEY), _KEY, "left_anti")
        write_table(waiting, f"{self.folder}/{part}/waiting")
        self._commit(
            base=f"{part}/unspent", waiting=f"{part}/waiting", settled=done[-1]["last"],
            ranges=ranges[len(done) :],
        )

    def _created(self, ranges: list[dict]) -> DataFrame | None:
        return self._read([self._state["base"], *[r["created"] for r in ranges]])

    def _spent(self, ranges: list[dict]) -> DataFrame | None:
        return self._read([self._state["waiting"], *[r["spent"] for r in ranges]])

    @staticmethod
    def _unspent(created: DataFrame, spent: DataFrame) -> DataFrame:
        return created.join(spent.distinct(), _KEY, "left_anti").select(created.columns)

    def unspent(self) -> DataFrame:
        """The unspent outputs after all ranges."""
        created, spent = (f(self._state["ranges"]) for f in (self._created, self._spent))
        if created is None:
            raise ValueError(f"no blocks in {self.folder}")
        return self._unspent(created, spent)

    def spent_since(self, first: int) -> DataFrame:
        """The outputs that the ranges from block ``first`` on spent, for who follows the
        set: what undoing them brings back, unless they made it themselves."""
        kept = [r for r in self._state["ranges"] if r["last"] < first]
        later = self._read([r["spent"] for r in self._state["ranges"][len(kept) :]])
        before = self._created(kept)
        if later is None or before is None:
            raise ValueError(f"no range from block {first} on, or none before it")
        return self._unspent(before, self._spent(kept) or later.limit(0)).join(
            later.distinct(), _KEY, "left_semi"
        )

    def _commit(self, **changed) -> None:
        state = {**self._state, **changed}
        commit(self.spark, self.folder, self.version + 1, state)
        self.version, self._state = self.version + 1, state
