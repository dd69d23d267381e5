"""Benchmark decontamination: windows of benchmark words, looked up in training texts.

The windows of all items are a hash set that is broadcast. It is built on numbers of the
benchmark's own words, so a text word is either one of them or cannot be in any window:
only runs of known words are looked at, and a hit is exact, not a hash match.
"""

from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages, carried

#: Words of a window.
WINDOW = 10
#: Bytes that a broadcast set takes in a worker (an item alone may take more), by an
#: estimate for each window and each letter; a larger benchmark is cut into blocks, which
#: are built, sent, scanned and dropped one after the other.
BLOCK_BYTES = 100_000_000
WINDOW_BYTES, LETTER_BYTES = 320, 4

SCAN = "struct<n_words: long, n_hit: long, items: array<long>, spans: array<struct<first: long, last: long>>>"

#: 0-9, a-z and all bytes above ASCII are kept, A-Z become a-z, all else a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case: runs of 0-9, a-z and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


@dataclass
class WindowSet:
    """``ids`` numbers the benchmark's words from 1. ``items`` has, for each length, the
    items of each window, which is the bytes of its word numbers."""

    ids: dict[bytes, int] = field(default_factory=dict)
    items: dict[int, dict[bytes, list[int]]] = field(default_factory=dict)

    @classmethod
    def of(cls, benchmark: list[tuple[int, str | None]], window: int = WINDOW) -> "WindowSet":
        made = cls()
        for item_id, text in benchmark:
            numbers = [made.ids.setdefault(w, len(made.ids) + 1) for w in words(text)]
            n = min(window, len(numbers))
            held, flat = made.items.setdefault(n, {}) if n else {}, array("I", numbers).tobytes()
            for i in range(len(numbers) - n + 1 if n else 0):
                found = held.setdefault(flat[4 * i : 4 * (i + n)], [])
                if not found or found[-1] != item_id:  # items come one after the other
                    found.append(item_id)
        return made

    def scan(self, text: str | None) -> tuple[int, int, list[int], list[tuple[int, int]]]:
        """Words, words hit, items found, and the hit stretches [first, last)."""
        of = self.ids.get
        numbers = np.array([of(w, 0) for w in words(text)], dtype=np.uint32)
        known, flat = np.flatnonzero(numbers), numbers.tobytes()
        spans, items = [], set()
        for run in np.split(known, np.flatnonzero(np.diff(known) != 1) + 1) if len(known) else []:
            first, last = int(run[0]), int(run[-1]) + 1
            for n, windows in self.items.items():
                for i in range(first, last - n + 1):
                    found = windows.get(flat[4 * i : 4 * (i + n)])
                    if found:
                        items.update(found)
                        spans.append((i, i + n))
        spans = merged(spans)
        return len(numbers), sum(b - a for a, b in spans), sorted(items), spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches as one, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list]:
    """The items in runs whose sets take about ``limit`` bytes. They come to the driver one
    partition at a time; items without an id are left out, as nothing could name them."""
    block, held = [], 0
    items = benchmark.filter(F.col(item_id).isNotNull()).select(item_id, text)
    for row in items.toLocalIterator():
        letters = len(row[1] or "")
        block.append((row[0], row[1]))
        held += LETTER_BYTES * letters + WINDOW_BYTES * (1 + len((row[1] or "").split()))
        if held >= limit:
            yield block
            block, held = [], 0
    if block:
        yield block


def _scanned(text: Column, shared) -> Column:
    @F.pandas_udf(SCAN)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        loaded = WindowSet(*shared.value)
        for batch in texts:
            found = [loaded.scan(t) for t in batch]
            yield pd.DataFrame(
                {
                    "n_words": [f[0] for f in found],
                    "n_hit": [f[1] for f in found],
                    "items": [f[2] for f in found],
                    "spans": [[{"first": a, "last": b} for a, b in f[3]] for f in found],
                }
            )

    return scan(text)


def _combined(scans: Column) -> Column:
    """One scan of the scans of several blocks of the same text."""

    @F.pandas_udf(SCAN)
    def combine(batch: pd.Series) -> pd.DataFrame:
        out = []
        for of_blocks in batch:
            spans = merged([(s["first"], s["last"]) for b in of_blocks for s in b["spans"]])
            items = sorted({int(i) for b in of_blocks for i in b["items"]})
            hit = sum(b - a for a, b in spans)
            shown = [{"first": a, "last": b} for a, b in spans]
            out.append((int(of_blocks[0]["n_words"]), hit, items, shown))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans"])

    return combine(scans)


def scan_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct ``scan``: n_words, n_hit, the ids of items with a window in
    the text, and the hit stretches of words.

    A null or empty text, or one without words, has no words and no hits; an item without
    words has no window; an empty benchmark hits nothing. Repeated rows are scanned each.
    An existing column ``scan`` is replaced.
    """
    spark, docs = docs.sparkSession, docs.drop("scan")

    def sent(windows: WindowSet):
        return spark.sparkContext.broadcast((windows.ids, windows.items))

    of_blocks = blocks(benchmark, item_id, item_text, block_bytes)
    first, second = next(of_blocks, []), next(of_blocks, None)
    if second is None:
        return docs.withColumn("scan", _scanned(docs[text], sent(WindowSet.of(first, window))))
    # A scan depends on the text alone, so hits of the blocks meet by the text's digest. One
    # block's windows are held at a time; only texts that are hit are shuffled twice.
    stages = Stages(spark, "benchmark")
    key = F.md5(docs[text]).alias("key")
    hits = None
    for number, block in enumerate(chain([first, second], of_blocks)):
        shared = sent(WindowSet.of(block, window))
        found = docs.select(key, _scanned(docs[text], shared).alias("scan")).filter("scan.n_hit > 0")
        found = stages.write(found.groupBy("key").agg(F.first("scan").alias("scan")), f"hits-{number}")
        shared.destroy()
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("key").agg(F.collect_list("scan").alias("scans"))
    hits = hits.select("key", _combined(F.col("scans")).alias("hit"))
    clean = _scanned(docs[text], sent(WindowSet()))
    return (
        docs.select(carried(docs, ["scan"]).alias("row"), key, clean.alias("clean"))
        .join(hits, "key", "left")
        .select("row.*", F.coalesce("hit", "clean").alias("scan"))
    )
