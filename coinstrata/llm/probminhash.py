"""Near-duplicate documents by ProbMinHash over weighted shingles.

After Ertl, "ProbMinHash - a class of locality-sensitive hash algorithms for the
(probability) Jaccard similarity" (TKDE 2022). Every shingle of weight w sends arrivals of
a Poisson process of rate w to random registers; a register keeps the shingle that reaches
it first. Two documents agree in a register with the probability that is their probability
Jaccard similarity

    sum over shared d of 1 / (sum over all e of max(a_e / a_d, b_e / b_d))

where a and b are the weights: 1 + ln(n) for a shingle that a document holds n times, so
that a phrase said a hundred times does not make two texts alike by itself. Shingles whose
next arrival is later than all registers are done, which ends the process early.

Registers are cut into bands; documents that agree in a band are candidates. Exact copies
are one class before that. In each bucket of a band the members are first compared with
one of them, which joins most of a group without making its pairs.

Members of buckets that hold different classes still may be near other members. Let u be
the share of a's weight that b has not, v the share of b's that a has not. Each term of the
sum above is at most what the unshared elements leave, and the terms are concave, so

    similarity <= 1 / (1 + u / (1 - u) + v / (1 - v))

With all shingles in one order, the first that two documents share comes after unshared
ones only. So the rarest come first, and a document offers a shingle only while x = u / (1 -
u), u the share of weight before it, is at most 1 / similar - 1; two documents meet at a
shingle if their x together are at most that. Frequent shingles, like a template's, come
late and are not offered by documents with something of their own. The members that meet
are again compared with one first. Those that are left in different classes are held
against each other by bitmaps of their shingles: a bit that one has and the other has not
is a shingle (of weight 1 or more) that is not shared, so the bits give a u and a v that are
not too large, and the same bound. None of this misses a pair. What passes is compared by
the similarity itself, from all shingles.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages, slices
from coinstrata.operators.components import connected_components

#: Words of a shingle, least similarity of near duplicates.
SHINGLE, SIMILAR = 5, 0.8
#: Bands and registers in each. A pair of similarity 0.8 shares no band with probability
#: (1 - 0.8^4)^24 = 3e-6.
BANDS, ROWS = 24, 4
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def words(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and non-ASCII characters, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[2]
    x = (x ^ (x >> np.uint64(27))) * _MIX[3]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def shingles(text: str | None, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, in order, and their weights. A text of fewer
    words, but not none, is one shingle."""
    found = words(text)
    ids = np.array([hashes[w] for w in found], dtype=np.uint64)
    n = min(SHINGLE, len(ids))
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0)
    with np.errstate(over="ignore"):
        sums = np.full(len(ids) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            sums = mixed(sums * _MIX[0] + ids[k : len(ids) - n + 1 + k])
    items, counts = np.unique(sums, return_counts=True)
    return items, 1 + np.log(counts)


def signatures(
    sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS
) -> np.ndarray:
    """ProbMinHash signatures (one row per set, uint64) of sets of (hashes, weights); all
    sets are advanced together. An element's n-th arrival is a function of its hash and n,
    so the same in every set but for the rate; where few are left, several are made at
    once."""
    best = np.full(len(sets) * registers, np.inf)
    owner = np.zeros(len(sets) * registers, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    if not len(row):
        return owner.reshape(-1, registers)
    item = np.concatenate([h for h, _ in sets])
    rate = np.concatenate([w for _, w in sets]).astype(np.float64)
    time, arrivals = np.zeros(len(item)), 0
    with np.errstate(over="ignore"):
        while len(row):
            at_once = min(64, max(1, 50_000 // len(row)))
            turns = np.arange(arrivals, arrivals + at_once, dtype=np.uint64)[:, None]
            state = mixed(mixed(item ^ _MIX[1])[None, :] + turns * _MIX[0])
            uniform = ((state >> np.uint64(11)) + np.uint64(1)) * 2.0**-53
            times = time + np.cumsum(-np.log(uniform) / rate, axis=0)
            cells = row * registers + (mixed(state ^ _MIX[3]) % np.uint64(registers)).astype(np.int64)
            t, c = times.reshape(-1), cells.reshape(-1)
            sooner = np.flatnonzero(t < best[c])
            sooner = sooner[np.argsort(-t[sooner], kind="stable")]  # the earliest is written last
            best[c[sooner]] = t[sooner]
            owner[c[sooner]] = np.broadcast_to(item, times.shape).reshape(-1)[sooner]
            arrivals += at_once
            time = times[-1]
            alive = time < best.reshape(-1, registers).max(axis=1)[row]
            row, item, rate, time = (a[alive] for a in (row, item, rate, time))
    return owner.reshape(-1, registers)


def similarity(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> float:
    """Probability Jaccard similarity of two weighted sets, each with sorted hashes.

    For a shared element the sum over all elements of max(a_e / a_d, b_e / b_d) splits
    where a_e / b_e reaches a_d / b_d, so with the ratios in order running sums give it.
    """
    items = np.union1d(a[0], b[0])
    if not len(items):
        return 1.0
    wa, wb = np.zeros(len(items)), np.zeros(len(items))
    wa[np.searchsorted(items, a[0])] = a[1]
    wb[np.searchsorted(items, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        order = np.argsort(wa / np.where(wb > 0, wb, 1) + np.where(wb > 0, 0, np.inf), kind="stable")
    wa, wb = wa[order], wb[order]
    above_a = wa.sum() - np.cumsum(wa) + wa  # of this and all larger ratios
    below_b = np.cumsum(wb) - wb
    shared = (wa > 0) & (wb > 0)
    return float((1 / (above_a[shared] / wa[shared] + below_b[shared] / wb[shared])).sum())


#: Characters of text that are signed together.
SLICE_CHARS = 2_000_000
#: Turns in which each open bucket of a band, then of a rare shingle, compares one member
#: with the others, before all members of different classes are compared.
STAR_TURNS, RARE_TURNS = 3, 2
#: Bytes of texts and shingles that a task remembers while it compares.
REMEMBERED_BYTES = 20_000_000
#: Words of 64 bits in a bitmap of shingles.
BITMAP = 32
#: For rounding of sums of weights.
TINY = 1e-6


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similar: float = SIMILAR
) -> DataFrame:
    """(doc_id, class_id, class_size): one row for each doc_id. Documents joined by a chain
    of pairs of at least ``similar`` are one class, named by its smallest doc_id.

    Null and empty texts, and texts without a word, have no shingle and are classes of
    their own. Rows that repeat an id are one document with the smallest of their texts; a
    null id is left out, as no class could be told by it. Ids may be of any type that can
    be ordered.
    """
    stages = Stages(docs.sparkSession, "near")
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    named = named.filter("doc_id is not null")
    repeated = named.groupBy("doc_id").count().filter("count > 1")
    if not repeated.isEmpty():
        named = named.groupBy("doc_id").agg(F.min("text").alias("text"))
    signed = stages.write(
        named.select("doc_id", _signed(named["text"]).alias("s")).select("doc_id", "s.*"), "signed"
    )
    # Copies: one class for each digest of the shingles with their counts.
    worded = signed.filter("digest is not null").select("digest", "doc_id")
    first = stages.write(worded.groupBy("digest").agg(F.min("doc_id").alias("rep")), "first")
    copies = stages.write(worded.join(first, "digest").select("doc_id", "rep"), "copies")
    originals = copies.filter("doc_id = rep").select("doc_id")

    banded = signed.join(originals, "doc_id", "left_semi").select(
        "doc_id", F.explode("bands").alias("band")
    )
    counts = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stages.write(counts.select("band"), "shared")
    buckets = stages.write(banded.join(shared, "band"), "buckets")
    candidates = buckets.select("doc_id").distinct()
    texts = stages.write(named.join(candidates, "doc_id", "left_semi"), "texts")
    labels = stages.write(texts.select("doc_id", F.col("doc_id").alias("class_id")), "labels")
    compared = labels.limit(0).select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    members = None
    for turn in range(STAR_TURNS + RARE_TURNS + 1):
        if turn == STAR_TURNS:
            buckets = _rare(members, texts, similar, stages)
        members = stages.write(buckets.join(labels, "doc_id"), f"members-{turn}")
        if turn < STAR_TURNS + RARE_TURNS:
            pairs = _star_pairs(members, turn, turn in (0, STAR_TURNS, STAR_TURNS + 1))
        else:
            pairs = _rest_pairs(members, texts, similar, stages)
        pairs = stages.write(pairs.join(compared, ["a", "b"], "left_anti"), f"pairs-{turn}")
        compared = stages.write(compared.unionByName(pairs), f"compared-{turn}")
        links = stages.write(_similar(pairs, texts, similar), f"links-{turn}")
        if not links.isEmpty():
            labels = stages.write(_relabelled(labels, links, stages), f"labels-{turn}")

    classes = copies.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "doc_id", F.coalesce("class_id", "rep").alias("class_id")
    )
    alone = signed.filter("digest is null").select("doc_id", F.col("doc_id").alias("class_id"))
    classes = stages.write(classes.unionByName(alone), "classes")
    # Written, so that the join below can be split where one class holds much.
    sizes = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    sizes = stages.write(sizes, "sizes")
    return classes.join(sizes, "class_id").select("doc_id", "class_id", "class_size")


def _signed(text: Column) -> Column:
    """Struct of a digest of the weighted shingles, null without any, and of the bands."""

    @F.pandas_udf("struct<digest: binary, bands: array<long>>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            digests, bands = [], []
            for run in slices(list(batch), SLICE_CHARS, lambda t: len(t) if t else 0):
                sets = [shingles(t, hashes) for t in run]
                owners = signatures(sets).reshape(len(sets), BANDS, ROWS)
                with np.errstate(over="ignore"):
                    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), owners.shape[:2])
                    for k in range(ROWS):
                        keys = mixed(keys * _MIX[0] + owners[:, :, k])
                for (items, weights), of_set in zip(sets, keys.view(np.int64)):
                    if len(items):
                        held = items.tobytes() + weights.tobytes()
                        digests.append(hashlib.blake2b(held, digest_size=16).digest())
                        bands.append(of_set)
                    else:
                        digests.append(None)
                        bands.append([])
            yield pd.DataFrame({"digest": digests, "bands": bands})

    return sign(text)


def _ordered(a: str, b: str) -> list[Column]:
    first = F.col(a) < F.col(b)
    return [
        F.when(first, F.col(a)).otherwise(F.col(b)).alias("a"),
        F.when(first, F.col(b)).otherwise(F.col(a)).alias("b"),
    ]


def _star_pairs(members: DataFrame, turn: int, once: bool) -> DataFrame:
    """Pairs (a, b) of one member of each open bucket with those of other classes. The
    first member is the smallest id, later ones are drawn by a hash; with ``once`` a
    document is only compared with the one it meets in most buckets."""
    order = F.struct(
        F.lit(0) if turn == 0 else F.xxhash64("doc_id", F.lit(turn)),
        F.col("doc_id"),
        F.col("class_id").alias("class_id"),
    )
    centres = members.groupBy("band").agg(
        F.min(order).alias("c"), F.min("class_id").alias("low"), F.max("class_id").alias("high")
    )
    centres = centres.filter("low < high").select(
        "band", F.col("c.doc_id").alias("centre"), F.col("c.class_id").alias("centre_class")
    )
    met = members.join(centres, "band").filter("class_id <> centre_class")
    met = met.groupBy("doc_id", "centre").agg(F.count(F.lit(1)).alias("n"))
    if once:
        best = F.min_by("centre", F.struct(-F.col("n"), "centre")).alias("centre")
        met = met.groupBy("doc_id").agg(best)
    return met.select(*_ordered("doc_id", "centre")).distinct()


def _largest_classes(members: DataFrame) -> DataFrame:
    """(band, largest): the largest class of each bucket that has more than one."""
    of_class = members.groupBy("band", "class_id").agg(F.count(F.lit(1)).alias("n"))
    largest = of_class.groupBy("band").agg(
        F.max_by("class_id", F.struct("n", "class_id")).alias("largest"),
        F.count(F.lit(1)).alias("classes"),
    )
    return largest.filter("classes > 1").select("band", "largest")


def _as_rows(texts: DataFrame) -> DataFrame:
    """(doc_id, total, item, weight): a row for each shingle of each text, with the weight of
    all shingles of the text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, at = batch.column(0), 0
            for run in slices(batch.column(1).to_pylist(), SLICE_CHARS, len):
                sets = [shingles(text, hashes) for text in run]
                row = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
                totals = np.array([w.sum() for _, w in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row + at)), pa.array(totals[row]),
                        pa.array(np.concatenate([h for h, _ in sets]).view(np.int64)),
                        pa.array(np.concatenate([w for _, w in sets]).astype(np.float64)),
                    ],
                    ["doc_id", "total", "item", "weight"],
                )
                at += len(run)

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text").mapInArrow(
        made, f"doc_id {id_type}, total double, item long, weight double"
    )


def _rare(members: DataFrame, texts: DataFrame, similar: float, stages: Stages) -> DataFrame:
    """(doc_id, band, x): the rare shingles that members of open buckets offer."""

    open_ = members.join(_largest_classes(members), "band").select("doc_id").distinct()
    held = stages.write(_as_rows(texts.join(open_, "doc_id", "left_semi")), "shingles")
    often = held.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = held.join(stages.write(often, "often"), "item")
    # Shingles of one document only come first in it, whichever they are.
    of_document = Window.partitionBy("doc_id")
    earlier = of_document.orderBy("n", "item").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("total") - F.sum("weight").over(of_document)
    u = (own + F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))) / F.col("total")
    placed = shared.select("doc_id", F.col("item").alias("band"), u.alias("u"))
    placed = placed.filter(F.col("u") <= 1 - similar + TINY)
    return stages.write(placed.select("doc_id", "band", (F.col("u") / (1 - F.col("u"))).alias("x")), "rare")


def _bitmaps(texts: DataFrame) -> DataFrame:
    """(doc_id, total, bits_0, ...): the weight of a text's shingles, and their bitmap."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            totals, maps = [], np.zeros((batch.num_rows, 64 * BITMAP), np.uint8)
            for i, text in enumerate(batch.column(1)):
                items, weights = shingles(text.as_py(), hashes)
                maps[i, (items % np.uint64(64 * BITMAP)).astype(np.int64)] = 1
                totals.append(float(weights.sum()))
            words = np.packbits(maps, axis=1, bitorder="little").view(np.int64)
            columns = [pa.array(c) for c in words.reshape(-1, BITMAP).T]
            names = ["doc_id", "total", *(f"bits_{k}" for k in range(BITMAP))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.float64()), *columns], names)

    id_type = texts.schema["doc_id"].dataType.simpleString()
    bits = ", ".join(f"bits_{k} long" for k in range(BITMAP))
    return texts.select("doc_id", "text").mapInArrow(made, f"doc_id {id_type}, total double, {bits}")


def _rest_pairs(members: DataFrame, texts: DataFrame, similar: float, stages: Stages) -> DataFrame:
    """Pairs (a, b) of different classes that meet at a rare shingle and that their bitmaps
    don't rule out. A group that has become one class has none."""
    here = stages.write(members.join(_largest_classes(members), "band"), "open")
    maps = _bitmaps(texts.join(here.select("doc_id").distinct(), "doc_id", "left_semi"))
    here = here.join(stages.write(maps, "bitmaps"), "doc_id")
    outside = here.filter("class_id <> largest").drop("largest")
    outside = outside.select(*[F.col(c).alias(f"other_{c}") for c in outside.columns])
    # Of two members outside the largest class each finds the other; one is enough.
    once = (F.col("class_id") == F.col("largest")) | (F.col("doc_id") < F.col("other_doc_id"))
    most = 1 / similar - 1 + 4 * TINY
    bits = [(F.col(f"bits_{k}"), F.col(f"other_bits_{k}")) for k in range(BITMAP)]
    only = reduce(Column.__add__, [F.bit_count(a.bitwiseAND(F.bitwise_not(b))) for a, b in bits])
    other_only = reduce(Column.__add__, [F.bit_count(b.bitwiseAND(F.bitwise_not(a))) for a, b in bits])
    shared, other_shared = F.col("total") - only, F.col("other_total") - other_only
    # u / (1 - u) + v / (1 - v) <= most, without a division.
    near = only * other_shared + other_only * shared <= most * shared * other_shared
    condition = (
        (F.col("band") == F.col("other_band")) & (F.col("class_id") != F.col("other_class_id"))
        & once & (F.col("x") + F.col("other_x") <= most) & near
    )
    met = here.join(outside, condition).select("doc_id", "other_doc_id")
    return met.select(*_ordered("doc_id", "other_doc_id")).distinct()


def _similar(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose similarity, from all shingles of both texts, suffices."""

    @F.pandas_udf("double")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashes, known, held = WordHashes(), {}, 0

        def of(text: str) -> tuple:
            nonlocal held
            found = known.get(text)
            if found is None:
                if held > REMEMBERED_BYTES:
                    known.clear()
                    held = 0
                found = known[text] = shingles(text, hashes)
                held += len(text) + sum(a.nbytes for a in found)
            return found

        for left, right in batches:
            yield pd.Series([similarity(of(x), of(y)) for x, y in zip(left, right)], dtype="float64")

    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(second, "b").join(first, "a")
    return both.select("a", "b", compare("text_a", "text_b").alias("s")).filter(
        F.col("s") >= similar - 1e-9
    ).select("a", "b")


def _relabelled(labels: DataFrame, links: DataFrame, stages: Stages) -> DataFrame:
    """Labels after joining the classes that ``links`` connect."""
    one = labels.select(F.col("doc_id").alias("a"), F.col("class_id").alias("src"))
    two = labels.select(F.col("doc_id").alias("b"), F.col("class_id").alias("dst"))
    edges = links.join(one, "a").join(two, "b").select("src", "dst").distinct()
    joined = connected_components(edges, stages.folder).select(
        F.col("id").alias("class_id"), F.col("component").alias("joined")
    )
    return labels.join(joined, "class_id", "left").select(
        "doc_id", F.coalesce("joined", "class_id").alias("class_id")
    )
