"""Hard negatives by a vertical scan (BOND) over blocks of vectors.

After de Vries, Mamoulis, Nes and Kersten, "Efficient k-NN search on vertically decomposed
data" (SIGMOD 2002). A task holds a block of vectors by columns, one array per dimension.
For an anchor the dimensions are read in descending magnitude of the anchor's components.
Each adds its products to the scores so far; the smallest and largest products that the
dimensions left can still add, from each column's minimum and maximum, bound every score.
Rows whose bounds show that they are not wanted leave the bitmap of candidates, and what
is left at the end has exact scores.

Two scans of the rows: the first finds each anchor's positives (the rows of its label with
the highest scores), the second the negatives (rows of other labels) in the score window of
each positive. Scores are integers throughout.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages

#: Anchors go to the tasks in groups of so many bytes of components at most.
GROUP_BYTES = 16_000_000
#: Rows that a task scans together, and rows of a task.
BLOCK_ROWS, TASK_ROWS = 8192, 65536
#: Dimensions that are read before rows are dropped again.
STEP = 16
#: With more candidates left, rows are held against all windows as one.
FEW = 1500
#: Components up to this, in vectors of up to 2**13 dimensions, have scores that doubles
#: hold exactly; others are Python's integers.
SMALL = 2**20


@dataclass
class Block:
    """Vectors by columns, with the range of each column."""

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray  # dimensions x rows
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)

    def __post_init__(self):
        if len(self.columns) and self.columns.shape[1]:
            self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        else:
            self.low = self.high = np.zeros(len(self.columns), self.columns.dtype)

    def suffixes(self, anchor: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that the dimensions from each place of ``order`` on can add."""
        ends = np.stack([anchor[order] * self.low[order], anchor[order] * self.high[order]])
        pad = np.zeros(1, ends.dtype)
        least = np.concatenate([pad, np.cumsum(ends.min(axis=0)[::-1])])[::-1]
        most = np.concatenate([pad, np.cumsum(ends.max(axis=0)[::-1])])[::-1]
        return least, most


def matrix(vectors: pa.Array, dimensions: int) -> np.ndarray:
    """Integer vectors, given as lists of floats, by columns. Shorter ones are filled with
    zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.zeros((len(vectors), dimensions))
    flat[np.arange(dimensions) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    if not flat.size or (np.abs(flat).max() <= SMALL and dimensions * SMALL**2 <= 2**53):
        return np.ascontiguousarray(flat.T)
    return np.array([[int(x) for x in column] for column in flat.T], dtype=object).reshape(
        dimensions, len(vectors)
    )


def scan(
    block: Block, anchor: np.ndarray, alive: np.ndarray, floors: list[int], ceilings: list[int], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of all rows of ``alive`` that can be among the first ``k`` of a
    window, in order of rows. Window i has the scores from ``floors[i]`` to ``ceilings[i]``;
    a floor rises to the k-th score that is sure to be in the window."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    least, most = block.suffixes(anchor, order)
    sums = np.zeros(len(alive), np.result_type(block.columns, anchor))
    floors = list(floors)
    for place in range(0, len(order), STEP):
        read = order[place : place + STEP]
        if 2 * len(alive) < block.columns.shape[1]:
            sums = sums + anchor[read] @ block.columns[read[:, None], alive]
        else:
            sums = sums + (anchor[read] @ block.columns[read])[alive]
        end = min(place + STEP, len(order))
        below, above = sums + least[end], sums + most[end]
        if len(floors) > 1 and len(alive) > FEW:
            wanted = (above >= min(floors)) & (below <= max(ceilings))
        else:
            wanted = np.zeros(len(alive), bool)
            for i, (floor, ceiling) in enumerate(zip(floors, ceilings)):
                inside = below[(below >= floor) & (above <= ceiling)]
                if len(inside) >= k:
                    kth = np.partition(inside, len(inside) - k)[len(inside) - k]
                    floors[i] = floor = max(floor, kth)
                wanted |= (above >= floor) & (below <= ceiling)
        if not wanted.all():
            alive, sums = alive[wanted], sums[wanted]
        if not len(alive):
            break
    return alive, sums


class Best:
    """The first ``k`` (score, id) of a window, by descending score, then ascending id."""

    __slots__ = ("k", "low", "high", "scores", "ids")

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def floor(self) -> int:
        return self.low if len(self.scores) < self.k else max(self.low, self.scores[-1])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.floor()) & (scores <= self.high)
        if inside.any():
            scores = np.concatenate([self.scores, scores[inside]])
            ids = np.concatenate([self.ids, ids[inside]])
            if scores.dtype == object:
                order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])))[: self.k]
            else:
                order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[Block]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            ids, labels, vectors = (part.column(i) for i in range(3))
            yield Block(
                ids.to_numpy(zero_copy_only=False),
                labels.to_numpy(zero_copy_only=False),
                matrix(vectors, dimensions),
            )


#: No score is below or above these.
_ALL = (-(2**200), 2**200)


def _best_rows(rows: DataFrame, anchors: list, same_label: bool, k: int, dimensions: int) -> DataFrame:
    """(anchor_id, window, id, score): of each task the first ``k`` rows of each window of
    each anchor. ``anchors`` has (id, label, vector, [(window, low, high)])."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [
            (i, label, matrix(pa.array([vector], pa.list_(pa.float64())), dimensions)[:, 0],
             [(w, Best(k, lo, hi)) for w, lo, hi in windows])
            for i, label, vector, windows in shared.value
        ]
        for block in _blocks(batches, dimensions):
            of_label = {}
            for label in np.unique(block.labels):
                mine = block.labels == label
                of_label[label] = np.flatnonzero(mine if same_label else ~mine)
            everyone = np.arange(len(block.ids))
            for anchor_id, label, vector, windows in asked:
                alive = of_label.get(label, everyone[:0] if same_label else everyone)
                if same_label:
                    alive = alive[block.ids[alive] != anchor_id]
                if len(alive):
                    floors = [b.floor() for _, b in windows]
                    ceilings = [b.high for _, b in windows]
                    alive, scores = scan(block, vector, alive, floors, ceilings, k)
                    for _, best in windows:
                        best.add(scores, block.ids[alive])
        for anchor_id, _, _, windows in asked:
            for window, best in windows:
                if len(best.ids):
                    n = len(best.ids)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "anchor_id": pa.array([anchor_id] * n, pa.int64()),
                            "window": pa.array([window] * n, pa.int64()),
                            "id": pa.array(best.ids, pa.int64()),
                            "score": pa.array([int(s) for s in best.scores], pa.int64()),
                        }
                    )

    return rows.mapInArrow(search, "anchor_id long, window long, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and window over all tasks, with ``rank``."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def vectors(rows: DataFrame, scale: int, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, with floor(scale * x) for each
    component x as a double, which holds these integers exactly."""
    usable = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull()
    bad = F.exists(
        embedding,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == F.lit(float("inf"))),
    )
    # Doubles from 2^52 on are whole already, and floor would not fit a long.
    whole = lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v)
    floored = F.transform(embedding, lambda x: whole(x.cast("double") * scale))
    return rows.filter(usable & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        floored.alias("vector"),
    )


def hard_negatives(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``, positives the first other rows
    of an anchor's label by score, negatives of an anchor and positive the first rows of
    other labels whose score is from ``least_percent`` to ``most_percent`` of the
    positive's. Scores are inner products of floor(scale * component); ties go by id.

    Rows with a null id, label or vector, or with a component that is null or not finite,
    take no part (nor those whose scaled component isn't finite). Rows that repeat an id are one row, the smallest by label and vector.
    Vectors of fewer components are filled with zeros. A positive without a negative, an
    anchor without a positive, and an empty table give no rows. A score beyond 64 bits ends
    the job. Columns that aren't named are not read.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "negatives")
    used = vectors(rows, scale, vec_id, embedding, label)
    if not used.groupBy("vec_id").count().filter("count > 1").isEmpty():
        used = used.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r"))
        used = used.select("vec_id", "r.label", "r.vector")
    counted = used.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dimensions"),
        F.count_if(F.col("vec_id") % every == 0).alias("anchors"),
    ).first()
    dimensions = max(counted["dimensions"], 1)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(counted["n"] / TASK_ROWS))
    # The work of a task is its rows times the anchors, so rows are dealt evenly.
    used = stages.write(used.repartition(tasks, "vec_id"), "rows")
    groups = max(1, math.ceil(counted["anchors"] * dimensions * 8 / group_bytes))
    anchors = used.filter(F.col("vec_id") % every == 0).withColumn(
        "group", F.pmod(F.xxhash64("vec_id"), F.lit(groups))
    )
    if groups > 1:
        anchors = stages.write(anchors.repartition(groups, "group").sortWithinPartitions("group"), "anchors")
    out = []
    for group in range(groups):
        asked = [tuple(r) for r in anchors.filter(F.col("group") == group).drop("group").collect()]
        wide = [(i, of, vector, [(0, *_ALL)]) for i, of, vector in asked]
        found = _first(_best_rows(used, wide, True, positives, dimensions), positives)
        found = found.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        found = stages.write(found, f"positives-{group}")
        windows: dict[int, list] = {}
        for r in found.collect():
            low, high = -(-least_percent * r.positive_score // 100), most_percent * r.positive_score // 100
            if low <= high:
                windows.setdefault(r.anchor_id, []).append((r.positive_id, low, high))
        narrow = [(i, of, vector, windows[i]) for i, of, vector in asked if i in windows]
        near = _first(_best_rows(used, narrow, False, negatives, dimensions), negatives)
        near = near.withColumnsRenamed({"window": "positive_id", "id": "negative_id", "score": "negative_score"})
        near = near.join(found, ["anchor_id", "positive_id"])
        out.append(
            stages.write(
                near.select(
                    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
                ),
                f"negatives-{group}",
            )
        )
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result
