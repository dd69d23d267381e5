"""Outputs and spends laid out by the key of an output, for joins without a shuffle.

The unspent set, the links of spends and the history all join on (tx_hash, output_index).
Written once in buckets of that key, both sides of these joins are where they are needed:
bucket by bucket, whatever the size of the tables. A bucketed side cannot be split while it
is joined, so spends of an output that is referred to more than ``hot`` times are kept
apart: the buckets have one stand-in for them, and they are joined by themselves, with the
few outputs that they name.
"""

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.operators.history import owned_history
from coinstrata.operators.spends import (
    NO_OUTPUT,
    SOURCE_KEY,
    reference_rows,
    sources,
    spent_outputs,
    with_sources,
)
from coinstrata.sources.tables import write_bucketed, write_counted, write_table

_KEY = ["tx_hash", "output_index"]
#: Rows of a bucket, and references to one output from which they are kept apart.
BUCKET_ROWS, HOT = 2_000_000, 10_000


class KeyedLedger:
    """Two tables in buckets: flat ``outputs`` by their key, and spends by the key of the
    output they refer to."""

    def __init__(self, outputs: DataFrame, inputs: DataFrame, hot: DataFrame | None):
        self.outputs, self._inputs, self._hot = outputs, inputs, hot

    @classmethod
    def write(
        cls, spark: SparkSession, records: DataFrame, outputs: DataFrame, folder: str,
        buckets: int | None = None, hot: int = HOT,
    ) -> "KeyedLedger":
        """Lay out the flat ``outputs`` and the spends of nested ``records`` below
        ``folder``. This is the one shuffle of either table."""
        folder = f"{folder.rstrip('/')}/keyed-{uuid.uuid4().hex}"
        references, rows = write_counted(reference_rows(records), f"{folder}/references")
        buckets = buckets or max(1, math.ceil(rows / BUCKET_ROWS))
        often = references.filter(F.col("source_output_index") != NO_OUTPUT).groupBy(*SOURCE_KEY)
        often = often.agg(F.count(F.lit(1)).alias("n"), F.min("tx_hash").alias("first"))
        often = write_table(often.filter(F.col("n") > hot).drop("n"), f"{folder}/often")
        inputs, apart = references.withColumn("stand_in", F.lit(False)), None
        if not often.isEmpty():
            apart = references.join(often.select(*SOURCE_KEY), SOURCE_KEY, "left_semi")
            apart = write_table(apart, f"{folder}/hot")
            rest = inputs.join(often.select(*SOURCE_KEY), SOURCE_KEY, "left_anti")
            stand_ins = often.select(*SOURCE_KEY, F.lit(True).alias("stand_in"))
            inputs = rest.unionByName(stand_ins, allowMissingColumns=True)
        return cls(
            write_bucketed(outputs, f"{folder}/outputs", _KEY, buckets),
            write_bucketed(inputs, f"{folder}/inputs", SOURCE_KEY, buckets),
            apart,
        )

    def unspent(self) -> DataFrame:
        """As ``compute_utxo_set``: outputs that no input refers to."""
        spent = self._inputs.select(*[F.col(s).alias(k) for k, s in zip(_KEY, SOURCE_KEY)])
        spent = spent.filter(F.col("output_index") != NO_OUTPUT).distinct()
        return self.outputs.join(spent.hint("merge"), _KEY, "left_anti").select(
            self.outputs.columns
        )

    def spends(self) -> DataFrame:
        """As ``link_spends``: one row per input with the output it spends."""
        found = sources(self.outputs)
        linked = with_sources(self._inputs, found.hint("merge")).filter(~F.col("stand_in"))
        linked = linked.drop("stand_in")
        if self._hot is None:
            return linked
        stand_ins = self._inputs.filter("stand_in").select(*SOURCE_KEY)
        few = stand_ins.join(found.hint("merge"), SOURCE_KEY)
        return linked.unionByName(with_sources(self._hot, few).select(linked.columns))

    def history(self, entities: DataFrame) -> DataFrame:
        """As ``utxo_history``: outputs of known entities with their time of spending."""
        return owned_history(spent_outputs(self.spends()), self.unspent(), entities)
