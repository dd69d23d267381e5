"""Reversible line deduplication: exact reference counts behind sharded cuckoo filters.

A line's key is the line stripped of blanks with A-Z in lower case. The index of a corpus
is three tables, all sharded by the digest of the key:

* ``references`` (shard, key, doc_id): which document holds which key, one row each;
* ``counts`` (shard, key, n_docs, keeper): exact reference counts; the keeper is the
  smallest doc_id that holds the key, which keeps its lines;
* ``filters`` (shard, slots, n_keys, n_spilt, buckets): per shard a cuckoo filter of the
  keys in ``counts``.

Inserting documents asks the filters first: a key that misses is new for certain and is
counted by itself, and only keys that hit are settled with the counts. A corpus is built in
turns, each a part of its documents that is inserted into the index of the parts before it.
Deleting documents takes their references out, counts the keys again that these held, and
deletes the fingerprints of keys that nobody holds any more. So any sequence of inserts and
deletes leaves the same counts as the remaining documents inserted at once.
"""

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.llm.common import BLANKS, Stages, carried

#: Shortest key, in code points, that counts as a repeat.
LEAST_CHARS = 10
#: Keys a shard should hold; the number of shards follows the number of keys.
KEYS_PER_SHARD = 100_000
#: Parts in which a corpus is inserted.
TURNS = 2
#: Fingerprints of a bucket, share of slots to fill, moves before a key is spilt.
BUCKET, LOAD, KICKS = 4, 0.84, 200
#: Keys for each bucket beyond which a filter is built again.
FULL = BUCKET * LOAD * 1.1


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key has two buckets, either of which
    follows from the other and the fingerprint. Keys are 64-bit hashes.

    Inserts of many keys at once first fill free slots by counting, and only what is left
    over moves others. Fingerprints that find no place go to ``spilt``, which is looked up
    as well, so a key that was put in is always found.
    """

    def __init__(self, n_keys: int, slots: np.ndarray | None = None, spilt=()):
        if slots is None:
            buckets = 1 << max(1, math.ceil(math.log2(max(1, n_keys) / LOAD / BUCKET)))
            slots = np.zeros((buckets, BUCKET), dtype=np.uint16)
        self.slots, self.spilt = slots, list(spilt)

    def __len__(self) -> int:
        return int(np.count_nonzero(self.slots)) + len(self.spilt)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and both buckets of each key."""
        mask = np.uint64(len(self.slots) - 1)
        keys = keys.astype(np.uint64)
        prints = (keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)
        first = keys & mask
        return prints.astype(np.uint16), first, first ^ self._step(prints)

    def _step(self, prints: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.slots) - 1)
        return ((prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & mask) | np.uint64(1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        found = (self.slots[first] == prints[:, None]).any(axis=1)
        found |= (self.slots[second] == prints[:, None]).any(axis=1)
        if self.spilt:
            here = {(int(p), min(int(a), int(b))) for p, a, b in self.spilt}
            lower = np.minimum(first, second)
            found |= np.array([(int(p), int(b)) in here for p, b in zip(prints, lower)], dtype=bool)
        return found

    def insert(self, keys: np.ndarray) -> None:
        """Put in keys that are not in yet, each given once."""
        prints, first, second = self._places(keys)
        left = np.arange(len(keys))
        for bucket in (first, second):
            left = left[~self._fill(prints[left], bucket[left])]
        for i in left:
            self._kick(prints[i], int(first[i]), int(second[i]))

    def _fill(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Which of the fingerprints found a free slot in their bucket."""
        order = np.argsort(buckets, kind="stable")
        at = buckets[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        free = np.argsort(self.slots[at] != 0, axis=1, kind="stable")  # free slots first
        fits = rank < BUCKET - (self.slots[at] != 0).sum(axis=1)
        slot = free[np.arange(len(at))[fits], rank[fits]]
        self.slots[at[fits], slot] = prints[order][fits]
        placed = np.zeros(len(at), dtype=bool)
        placed[order[fits]] = True
        return placed

    def _kick(self, fingerprint: np.uint16, bucket: int, other: int) -> None:
        for turn in range(KICKS):
            for at in (bucket, other):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = fingerprint
                    return
            slot = turn % BUCKET
            moved = self.slots[other, slot]
            self.slots[other, slot] = fingerprint
            fingerprint, bucket = moved, other
            other = int(np.uint64(bucket) ^ self._step(np.array([moved]))[0])
        self.spilt.append((int(fingerprint), bucket, other))

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are in, each given once."""
        for fingerprint, first, second in zip(*self._places(keys)):
            a, b = int(first), int(second)
            for at in (a, b):
                held = np.flatnonzero(self.slots[at] == fingerprint)
                if len(held):
                    self.slots[at, held[0]] = 0
                    break
            else:
                low = min(a, b)
                for entry in self.spilt:
                    if entry[0] == int(fingerprint) and min(entry[1:]) == low:
                        self.spilt.remove(entry)
                        break

    def row(self, shard: int) -> dict:
        spilt = np.array(self.spilt, dtype=np.int64).reshape(-1, 3)
        return {
            "shard": shard, "n_keys": len(self), "buckets": len(self.slots),
            "slots": self.slots.tobytes(), "spilt": spilt.tobytes(),
        }

    @classmethod
    def of_row(cls, buckets: int, slots: bytes, spilt: bytes) -> "CuckooFilter":
        held = np.frombuffer(slots, dtype=np.uint16).reshape(buckets, BUCKET).copy()
        entries = np.frombuffer(spilt, dtype=np.int64).reshape(-1, 3)
        return cls(0, held, [tuple(int(x) for x in e) for e in entries])


FILTERS = "shard int, n_keys long, buckets long, slots binary, spilt binary"


def keyed(line: Column) -> Column:
    """The key of a line: blanks stripped at both ends, A-Z in lower case."""
    stripped = F.btrim(line, F.lit(BLANKS))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(stripped, upper, upper.lower())


def split_lines(text: Column) -> Column:
    r"""The lines of a text, split at \n; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def counted_digest(line: Column, least_chars: int) -> Column:
    """A 128-bit digest of the line's key; null if the key is too short to count."""
    key = keyed(line)
    return F.when(F.char_length(key) >= least_chars, F.unhex(F.md5(key)))


@dataclass
class LineIndex:
    """Exact counts and filters of the lines of a corpus; every change writes new tables
    and returns a new index. Documents are named by id: rows that repeat an id are one
    document, and a null id is a document like any other, smaller than all."""

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    least_chars: int
    keys_per_shard: int

    @classmethod
    def build(
        cls, docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
        least_chars: int = LEAST_CHARS, keys_per_shard: int = KEYS_PER_SHARD, turns: int = TURNS,
    ) -> "LineIndex":
        """Index ``docs``, a part of the ids in each turn. The number of shards follows the
        number of keys, here and when it has doubled."""
        stages = Stages(docs.sparkSession, "lines")
        turn = F.pmod(F.xxhash64("doc_id"), F.lit(turns)).alias("turn")
        references = _references(docs, text, doc_id, least_chars).select("key", "doc_id", turn)
        references = stages.write(references, "references")
        part = lambda i: references.filter(F.col("turn") == i).drop("turn")
        counts = stages.write(_counted(part(0)), "counts")
        shards = max(1, math.ceil(counts.count() * turns / keys_per_shard))
        counts = counts.withColumn("shard", _shard(shards))
        filters = stages.write(_filters_of(counts, keys_per_shard), "filters")
        index = cls(part(0), counts, filters, shards, least_chars, keys_per_shard)
        for number in range(1, turns):
            index = index._with(part(number), Stages(docs.sparkSession, "lines"))
        return replace(index, references=references.drop("turn"))

    def insert(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> "LineIndex":
        """Add documents. Those whose id is in the index already are left as they are."""
        stages = Stages(docs.sparkSession, "lines")
        fresh = _references(docs, text, doc_id, self.least_chars)
        fresh = _without(fresh, self.references.select("doc_id"))
        fresh = stages.write(fresh, "fresh")
        index = self._with(fresh, stages)
        references = stages.write(self.references.unionByName(fresh), "references")
        return replace(index, references=references)

    def _with(self, fresh: DataFrame, stages: Stages) -> "LineIndex":
        """The index with the references ``fresh`` of new documents counted; the table of
        references is left to the caller."""
        batch = stages.write(_counted(fresh).withColumn("shard", _shard(self.shards)), "batch")
        asked = batch.select("shard", "key", _hash().alias("hash")).groupBy("shard")
        asked = asked.cogroup(self.filters.groupBy("shard")).applyInPandas(_ask, "hit binary")
        hits = stages.write(asked, "hits")
        # A miss is new for certain and skips the counts.
        missed = batch.join(hits, F.col("key") == F.col("hit"), "left_anti")
        hit = batch.join(hits, F.col("key") == F.col("hit"), "left_semi").select(
            "key", F.col("n_docs").alias("_more"), F.col("keeper").alias("_keeper"), "shard"
        )
        hit = stages.write(hit, "asked")
        held = self.counts.join(hit.select("key"), "key", "left_semi")
        held = stages.write(held.select("key", "n_docs", "keeper"), "held")
        settled = hit.join(held, "key", "left").select(
            "key",
            (F.coalesce("n_docs", F.lit(0)) + F.col("_more")).alias("n_docs"),
            F.when(F.col("n_docs").isNull(), F.col("_keeper"))
            .otherwise(_least("keeper", "_keeper"))
            .alias("keeper"),
            "shard",
        )
        missed = stages.write(missed.select("key", "n_docs", "keeper", "shard"), "missed")
        untouched = _without_keys(self.counts, held).select("key", "n_docs", "keeper", "shard")
        counts = untouched.unionByName(settled).unionByName(missed)
        counts = stages.write(counts, "counts")
        # A hit that no count answers was a false one, so its key is new as well.
        new = missed.select("key", "shard").unionByName(_without_keys(hit, held).select("key", "shard"))
        return self._changed(new, new.limit(0), counts, stages)

    def delete(self, doc_ids: DataFrame, doc_id: str = "doc_id") -> "LineIndex":
        """Take documents out; ids that the index does not hold change nothing."""
        stages = Stages(doc_ids.sparkSession, "lines")
        named = doc_ids.select(F.col(doc_id).alias("_id")).distinct()
        going = self.references.join(named, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        touched = stages.write(going.select("key").distinct(), "touched")
        named = named.withColumnRenamed("_id", "doc_id")
        references = stages.write(_without(self.references, named), "references")
        again = _counted(references.join(touched, "key", "left_semi"))
        again = stages.write(again.withColumn("shard", _shard(self.shards)), "again")
        untouched = _without_keys(self.counts, touched).select("key", "n_docs", "keeper", "shard")
        counts = stages.write(untouched.unionByName(again), "counts")
        gone = _without_keys(touched, again).withColumn("shard", _shard(self.shards))
        index = self._changed(gone.limit(0), gone, counts, stages)
        return replace(index, references=references)

    def _changed(
        self, added: DataFrame, removed: DataFrame, counts: DataFrame, stages: Stages
    ) -> "LineIndex":
        """The index with ``counts``, after keys came and went. A filter whose shard outgrew
        it is built again from the shard's keys; where the shards hold twice the keys they
        should, there are more of them, and all filters are."""
        n_keys = counts.count()
        if n_keys > 2 * self.shards * self.keys_per_shard:
            shards = math.ceil(n_keys / self.keys_per_shard)
            counts = counts.drop("shard").withColumn("shard", _shard(shards))
            filters = stages.write(_filters_of(counts, self.keys_per_shard), "filters")
            return replace(self, counts=counts, filters=filters, shards=shards)
        changes = added.select("shard", _hash().alias("hash"), F.lit(1).alias("sign")).unionByName(
            removed.select("shard", _hash().alias("hash"), F.lit(-1).alias("sign"))
        )
        kept = changes.groupBy("shard").cogroup(self.filters.groupBy("shard"))
        kept = stages.write(kept.applyInPandas(_change, FILTERS), "changed")
        full = F.col("n_keys") > F.lit(FULL) * F.col("buckets")
        filters = kept.filter(~full)
        if not kept.filter(full).isEmpty():
            again = counts.join(kept.filter(full).select("shard"), "shard", "left_semi")
            filters = stages.write(filters.unionByName(_filters_of(again, self.keys_per_shard)), "filters")
        return replace(self, counts=counts, filters=filters)

    def dropped(self) -> DataFrame:
        """(doc_id, keys): for each document that loses lines, the keys it loses."""
        repeated = self.counts.filter("n_docs >= 2").select("key", "keeper")
        lost = self.references.join(repeated, "key").filter(
            ~F.col("doc_id").eqNullSafe(F.col("keeper"))
        )
        return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))

    def kept_lines(
        self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id"
    ) -> DataFrame:
        """``docs`` with ``lines`` and ``kept``, the lines before and after: lines whose
        key is in two documents or more stay only in the smallest doc_id that holds it.
        Columns of these names are replaced."""
        rows = docs.select(
            carried(docs, ["lines", "kept"]).alias("row"), docs[text].alias("text"),
            docs[doc_id].alias("doc_id"),
        )
        lost = self.dropped().withColumnRenamed("doc_id", "lost_id")
        joined = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")), "left")
        lines = split_lines(F.col("text"))
        least = self.least_chars

        # The keys a document loses are as many as its own lines at most.
        @F.pandas_udf("array<string>")
        def without(texts: pd.Series, keys: pd.Series) -> pd.Series:
            return pd.Series(
                [_kept(t, k, least) for t, k in zip(texts, keys)], dtype=object
            )

        unchanged = F.col("keys").isNull()
        shorter = without(F.when(~unchanged, F.col("text")), F.col("keys"))
        kept = F.when(unchanged, lines).otherwise(shorter)
        return joined.select("row", lines.alias("lines"), kept.alias("kept")).select(
            "row.*", "lines", "kept"
        )


_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _kept(text: str | None, keys, least_chars: int) -> list[str]:
    """The lines of ``text`` whose keys are not among the digests ``keys``."""
    import hashlib

    lines = (text or "").split("\n")
    if keys is None:
        return lines
    lost, out = {bytes(k) for k in keys}, []
    for line in lines:
        key = line.strip(BLANKS)
        if len(key) >= least_chars:
            key = key.lower() if key.isascii() else key.translate(_UPPER)
            if hashlib.md5(key.encode()).digest() in lost:
                continue
        out.append(line)
    return out


def _references(docs: DataFrame, text: str, doc_id: str, least_chars: int) -> DataFrame:
    """(key, doc_id), each once. A document's own repeats go within its row; only where
    ids repeat, references are shuffled to be made distinct."""
    digests = F.array_distinct(
        F.transform(split_lines(F.col(text)), lambda line: counted_digest(line, least_chars))
    )
    references = docs.select(
        F.explode(F.filter(digests, lambda key: key.isNotNull())).alias("key"),
        F.col(doc_id).alias("doc_id"),
    )
    repeated = docs.groupBy(doc_id).count().filter("count > 1")
    return references if repeated.isEmpty() else references.distinct()


def _counted(references: DataFrame) -> DataFrame:
    """(key, n_docs, keeper). Nulls are the smallest ids. Combines in the map tasks."""
    some_null = F.max(F.col("doc_id").isNull())
    return references.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.when(~some_null, F.min("doc_id")).alias("keeper"),
    )


def _least(a: str, b: str) -> Column:
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.least(a, b))


def _hash() -> Column:
    return F.xxhash64("key")


def _shard(shards: int) -> Column:
    """From the digest itself, so that it is independent of the hash in the filter."""
    return F.pmod(F.conv(F.substring(F.hex("key"), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast(
        "int"
    )


def _without(references: DataFrame, ids: DataFrame) -> DataFrame:
    """References of documents that are not in ``ids``."""
    ids = ids.select(F.col("doc_id").alias("_id")).distinct()
    return references.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")


def _filters_of(counts: DataFrame, room: int) -> DataFrame:
    """New filters, each with room for ``room`` keys at least."""

    def filled(rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter(max(len(rows), room))
        made.insert(rows["hash"].to_numpy().view(np.uint64))
        return pd.DataFrame([made.row(int(rows["shard"].iloc[0]))])

    made = counts.select("shard", _hash().alias("hash"))
    return made.groupBy("shard").applyInPandas(filled, FILTERS)


def _without_keys(counts: DataFrame, other: DataFrame) -> DataFrame:
    return counts.join(other.select("key"), "key", "left_anti")


def _loaded(rows: pd.DataFrame) -> CuckooFilter:
    if not len(rows):
        return CuckooFilter(1)
    row = rows.iloc[0]
    return CuckooFilter.of_row(int(row["buckets"]), row["slots"], row["spilt"])


def _ask(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(batch) or not len(filters):
        return pd.DataFrame({"hit": []})
    known = _loaded(filters).contains(batch["hash"].to_numpy().view(np.uint64))
    return pd.DataFrame({"hit": batch["key"][known]})


def _change(changes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    held = _loaded(filters)
    hashes = changes["hash"].to_numpy().view(np.uint64)
    signs = changes["sign"].to_numpy()
    held.delete(hashes[signs < 0])
    shard = (changes if len(changes) else filters)["shard"].iloc[0]
    row = held.row(int(shard))
    if row["n_keys"] + (signs > 0).sum() > FULL * row["buckets"]:
        # Built again from the counts by the caller, so not filled beyond its room here.
        return pd.DataFrame([row | {"n_keys": row["n_keys"] + int((signs > 0).sum())}])
    held.insert(hashes[signs > 0])
    return pd.DataFrame([held.row(int(shard))])


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_chars: int = LEAST_CHARS
) -> DataFrame:
    """``docs`` with ``lines`` and ``kept``: all lines, and those that stay.

    A null or empty text is one empty line, which stays; so do short lines. Rows that repeat
    an id are one document, so none of them loses a line to another; a null id is a document
    like any other, smaller than all. Very long texts are split whole, an empty table gives
    none, and columns named lines and kept are replaced.
    """
    return LineIndex.build(docs, text, doc_id, least_chars).kept_lines(docs, text, doc_id)
