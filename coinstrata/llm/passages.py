"""Repeated passages by collinear chaining.

1. Seeds: k-mers of words, of which each window of consecutive k-mers gives the one with
   the smallest hash (minimizers), so that equal stretches have equal seeds.
2. Matches: every occurrence of a seed is linked to the seed's first occurrence (smallest
   doc_id), which is one link for each occurrence and never a pair for each two. Runs of
   consecutive seeds whose first holders differ are linked to the run's first holder too.
3. Chains: the matches of two documents are chained in order of both, by the best sum of
   matched words less a cost for the gaps on either side; a Fenwick tree of prefix maxima
   finds the best predecessor in logarithmic time.
4. Alignment: the words between the matches of a chain are aligned, the chain is cut where
   the texts differ for long, and the ends of each part are extended, which gives fuzzy
   passages with the number of equal words.
5. Passages: stretches of a document that overlap or touch are one passage; those of
   LEAST_WORDS words or more are reported.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages

#: Words of a seed, and k-mers of a window that gives one.
SEED, SEED_WINDOW = 8, 16
#: Cost of a word of gap, on either side, in matched words.
GAP_COST = 0.1
#: Matches that a chain needs, if none of them has LEAST_CHAIN words; words that a chain
#: needs, and share of equal words in its alignment.
LEAST_MATCHES, LEAST_CHAIN, EQUAL = 2, 20, 0.7
#: Seeds of the runs that are linked as one, where their first holders differ.
RUNS = (2, 3, 4)
#: Words from one seed of a run to the next, at most; beyond, a gap costs more than a seed.
RUN_STEP = int(SEED / GAP_COST / 2)
#: A gap of which a smaller share is equal is foreign to the passages on either side.
FOREIGN = 0.5
#: Bytes of texts and words that a task remembers while it aligns.
REMEMBERED_BYTES = 20_000_000
#: Words of a passage. Fuzzy ends may cost a passage of 50 words a few.
LEAST_WORDS = 45

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
CHAIN = "struct<other: long, p: array<int>, q: array<int>>"


def words(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and non-ASCII characters, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        return np.array([self[w] for w in words(text)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def seeds(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, places and lengths of the seeds of a text of word hashes. A text shorter
    than a window gives its one smallest k-mer; one shorter than a k-mer has no seed. In a
    stretch that says the same over and over, a seed that follows itself is one longer
    seed."""
    n = len(ids) - SEED + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    with np.errstate(over="ignore"):
        hashes = np.zeros(n, np.uint64)
        for k in range(SEED):
            hashes = mixed(hashes * _MIX[0] + ids[k : n + k])
    width = min(SEED_WINDOW, n)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, width)
    places = np.unique(np.arange(n - width + 1) + windows.argmin(axis=1))
    found = hashes[places]
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    last = np.r_[first[1:], len(places)] - 1
    lengths = places[last] - places[first] + SEED
    return found[first], places[first].astype(np.int32), lengths.astype(np.int32)


def chains(p: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Chains of matches (p, q): index arrays in order. Every match is in one chain.

    The score of a chain is SEED for each match, less GAP_COST for each word by which the
    next match is further on, on either side. With the costs of p and q added to the score
    of a match, its best predecessor is a prefix maximum over smaller q.
    """
    order = np.lexsort((q, p))
    rank = np.unique(q, return_inverse=True)[1] + 1
    size = int(rank.max())
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)
    score, parent = [0.0] * len(p), [-1] * len(p)
    waiting: list[int] = []
    before = None
    for i in order.tolist():
        if before is not None and p[i] != before:  # matches of one p don't follow each other
            for j in waiting:
                held, at = (score[j] + GAP_COST * float(p[j] + q[j]), j), int(rank[j])
                while at <= size:
                    if tree[at] < held:
                        tree[at] = held
                    at += at & -at
            waiting = []
        best, at = (-np.inf, -1), int(rank[i]) - 1
        while at:
            if tree[at] > best:
                best = tree[at]
            at -= at & -at
        gain = best[0] - GAP_COST * float(p[i] + q[i])
        score[i] = SEED + max(0.0, gain)
        parent[i] = best[1] if gain > 0 else -1
        waiting.append(i)
        before = p[i]
    used, out = [False] * len(p), []
    for i in sorted(range(len(p)), key=lambda i: (-score[i], int(p[i]), int(q[i]))):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = parent[i]
        if chain:
            out.append(np.array(chain[::-1]))
    return out


def _gap(a: list[int], b: list[int]) -> int:
    """Equal words in the best alignment of two stretches: their longest common subsequence.

    Where the stretches have few words in common it is the longest rising run of the places
    of equal words. Else the table of lengths is kept as bits, one row at a time: a bit of
    ``row`` is 0 where the length grows from one word of ``b`` to the next.
    """
    if not a or not b:
        return 0
    if len(a) == len(b):
        straight = sum(x == y for x, y in zip(a, b))
        if straight >= len(a) - 2:
            return straight
    places: dict[int, list[int]] = {}
    for j, y in enumerate(b):
        places.setdefault(y, []).append(j)
    pairs = sum(len(places[x]) for x in a if x in places)
    if 50 * pairs <= len(a) * len(b):
        ends: list[int] = []  # the smallest last place of a run of each length
        for x in a:
            for j in reversed(places.get(x, ())):
                at = bisect_left(ends, j)
                ends[at : at + 1] = [j]
        return len(ends)
    bits = {y: sum(1 << j for j in js) if len(js) < 64 else _bits(js) for y, js in places.items()}
    whole = (1 << len(b)) - 1
    row = whole
    for x in a:
        same = row & bits.get(x, 0)
        row = ((row + same) | (row - same)) & whole
    return len(b) - row.bit_count()


def _bits(places: list[int]) -> int:
    held = np.zeros(places[-1] + 1, np.uint8)
    held[places] = 1
    return int.from_bytes(np.packbits(held, bitorder="little").tobytes(), "little")


def _extended(a: list[int], i: int, b: list[int], j: int, step: int) -> tuple[int, int, int]:
    """How far the alignment goes on from words i and j: words on either side, and equal
    ones among them. A word may differ, be missing or be added; it ends where such errors
    outweigh the equal words by six."""
    ahead = lambda x, y: 0 <= x < len(a) and 0 <= y < len(b) and a[x] == b[y]
    score = top = equal = 0
    best = (0, 0, 0)
    x, y = i, j
    while 0 <= x < len(a) and 0 <= y < len(b) and score > top - 6:
        if a[x] == b[y]:
            x, y, score, equal = x + step, y + step, score + 1, equal + 1
            if score > top:
                top, best = score, (abs(x - i), abs(y - j), equal)
            continue
        score -= 2
        if ahead(x + step, y + step):
            x, y = x + step, y + step
        elif ahead(x + step, y) and ahead(x + 2 * step, y + step):
            x += step
        elif ahead(x, y + step) and ahead(x + step, y + 2 * step):
            y += step
        else:
            x, y = x + step, y + step
    return best


def _blocks(a: list[int], b: list[int], p: list[int], q: list[int]) -> np.ndarray:
    """Rows (first and end in ``a``, first and end in ``b``, equal words of the gap before,
    equal words of the block) of what each match of a chain adds to the alignment."""
    out, (i, j) = [], (p[0], q[0])
    for x, y in zip(p, q):
        gap = skip = 0
        if x < i or y < j:  # overlaps what is aligned: take what goes beyond
            skip = max(i - x, j - y)
            if skip >= SEED:
                continue
        else:
            gap = _gap(a[i:x], b[j:y])
        out.append((x + skip, x + SEED, y + skip, y + SEED, gap, SEED - skip))
        i, j = x + SEED, y + SEED
    return np.array(out)


def _whole(a: list[int], b: list[int], blocks: np.ndarray) -> tuple[int, int, int, int, int]:
    """First and end word in ``a`` and in ``b`` of the blocks with extended ends, and equal
    words."""
    x, y, i, j = (int(n) for n in (blocks[0, 0], blocks[0, 2], blocks[-1, 1], blocks[-1, 3]))
    equal = int(blocks[:, 5].sum() + blocks[1:, 4].sum())
    left = _extended(a, x - 1, b, y - 1, -1)
    right = _extended(a, i, b, j, 1)
    return x - left[0], i + right[0], y - left[1], j + right[1], equal + left[2] + right[2]


def aligned(a: list[int], b: list[int], p: list[int], q: list[int]) -> tuple[int, int, int, int, int]:
    """First and end word in ``a`` and in ``b`` of a chain's alignment, and equal words."""
    return _whole(a, b, _blocks(a, b, p, q))


def _longest(blocks: np.ndarray) -> tuple[int, int]:
    """The run of blocks with the most words of which a share of EQUAL is equal; a block
    alone always is."""
    reached = (blocks[:, 4] + blocks[:, 5]).cumsum()
    ends = reached - EQUAL * blocks[:, 1]
    begins = reached - blocks[:, 5] - EQUAL * blocks[:, 0]
    later = np.maximum.accumulate(ends[::-1])  # the best end from each block on, last first
    last = len(blocks) - 1 - np.searchsorted(later, begins - 1e-9)
    first = int((blocks[last, 1] - blocks[:, 0]).argmax())
    return first, int(last[first]) + 1


def _cut(
    a: list[int], b: list[int], blocks: np.ndarray, least_words: int
) -> list[tuple[int, int, int, int, int]]:
    """The alignment of ``blocks``, cut at foreign gaps where either side is a passage by
    itself."""
    whole = _whole(a, b, blocks)
    differ = blocks[1:, 0] - blocks[:-1, 1] - blocks[1:, 4]
    for k in (np.argsort(-differ, kind="stable") + 1).tolist():
        if differ[k - 1] <= LEAST_CHAIN:
            break
        sides = [_whole(a, b, blocks[:k]), _whole(a, b, blocks[k:])]
        between = sides[1][0] - sides[0][1]
        lost = whole[4] - sides[0][4] - sides[1][4]
        if between > LEAST_CHAIN and lost < FOREIGN * between and all(
            s[1] - s[0] >= least_words and s[4] >= EQUAL * (s[1] - s[0]) for s in sides
        ):
            return _cut(a, b, blocks[:k], least_words) + _cut(a, b, blocks[k:], least_words)
    return [whole]


def stretches(
    a: list[int], b: list[int], p: list[int], q: list[int], least_words: int = LEAST_WORDS
) -> list[tuple[int, int, int, int, int]]:
    """The alignments of the parts of a chain. Time and again the longest run of matches
    that is equal enough is taken out, and what is left on either side is looked at by
    itself, so that no gap and no loose match spoils what the chain holds elsewhere."""
    found, open_ = [], [_blocks(a, b, p, q)]
    while open_:
        blocks = open_.pop()
        first, end = _longest(blocks)
        if end - first == 1:  # then no two go together
            found += [_whole(a, b, blocks[k : k + 1]) for k in range(len(blocks))]
            continue
        found += _cut(a, b, blocks[first:end], least_words)
        open_ += [rest for rest in (blocks[:first], blocks[end:]) if len(rest)]
    return sorted(
        {s for s in found if s[1] - s[0] >= LEAST_CHAIN and s[4] >= EQUAL * (s[1] - s[0])}
    )


def repeated_passages(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_words: int = LEAST_WORDS
) -> DataFrame:
    """Passages of ``least_words`` words or more that a document shares with one of smaller
    doc_id: (doc_id, passage_first, passage_end, first_word, end_word, match_doc_id,
    match_first, match_end, n_equal), one row for each aligned stretch of a passage. Words
    are counted from 0, ends are exclusive.

    Null and empty texts, and texts of fewer words than a seed, have no passage. Rows that
    repeat an id are one document with the smallest of their texts; rows with a null id are
    left out, as nothing could name them. Repeats within one document don't count.
    """
    stages = Stages(docs.sparkSession, "passages")
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = named.filter("doc_id is not null")
    repeated = named.groupBy("doc_id").count().filter("count > 1")
    if not repeated.isEmpty():
        named = named.groupBy("doc_id").agg(F.min("text").alias("text"))

    seeded = stages.write(
        named.select("doc_id", _seeds(named["text"]).alias("s")).select("doc_id", "s.*"), "seeds"
    )
    each = seeded.select(
        "doc_id", F.explode(F.arrays_zip("hashes", "places", "lengths")).alias("s")
    )
    each = each.select(
        F.col("s.hashes").alias("seed"), "doc_id", F.col("s.places").alias("p"),
        F.col("s.lengths").alias("length"),
    )
    met = _met(each, stages).groupBy("doc_id").agg(
        F.collect_list(F.struct("seed", "other", "p", "q", "length")).alias("matches")
    )
    met = stages.write(met, "met")
    more = _run_links(met, stages).groupBy("doc_id").agg(
        F.collect_list(F.struct("other", "p", "q")).alias("more")
    )
    chained = met.join(more, "doc_id", "left")
    chained = chained.select(
        "doc_id", F.explode(_chained(F.col("doc_id"), F.col("matches"), F.col("more"))).alias("c")
    )
    chained = stages.write(chained.select("doc_id", "c.*"), "chains")

    involved = chained.select(F.explode(F.array("doc_id", "other")).alias("doc_id")).distinct()
    texts = stages.write(named.join(involved, "doc_id", "left_semi"), "texts")
    others = texts.select(F.col("doc_id").alias("other"), F.col("text").alias("other_text"))
    both = chained.join(texts, "doc_id").join(others, "other")
    parts = _aligned(both["text"], both["other_text"], both["p"], both["q"], least_words)
    found = both.select("doc_id", F.col("other").alias("match_doc_id"), F.inline(parts))
    found = stages.write(found, "aligned")

    # Stretches of one document, as many as its words at most.
    by_first = Window.partitionBy("doc_id").orderBy("first_word", "end_word")
    reached = F.max("end_word").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("first_word") > reached, F.lit(True)).cast("int")
    numbered = found.withColumn("begins", begins).withColumn(
        "no", F.sum("begins").over(by_first.rowsBetween(Window.unboundedPreceding, 0))
    )
    passage = Window.partitionBy("doc_id", "no")
    whole = numbered.select(
        "doc_id",
        F.min("first_word").over(passage).alias("passage_first"),
        F.max("end_word").over(passage).alias("passage_end"),
        "first_word", "end_word", "match_doc_id", "match_first", "match_end", "n_equal",
    )
    return whole.filter(F.col("passage_end") - F.col("passage_first") >= least_words)


def _seeds(text: Column) -> Column:
    @F.pandas_udf("struct<hashes: array<long>, places: array<int>, lengths: array<int>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            found = [seeds(hashes.of(t)) for t in batch]
            yield pd.DataFrame(
                {
                    "hashes": [h.view(np.int64) for h, _, _ in found],
                    "places": [p for _, p, _ in found],
                    "lengths": [n for _, _, n in found],
                }
            )

    return of(text)


def _met(each: DataFrame, stages: Stages) -> DataFrame:
    """(doc_id, seed, p, length, other, q): occurrences of seeds that several documents
    have, each with the seed's first one. The first is found by a sum that combines in the
    map tasks and written; the join back has one row per seed on its right, so hot seeds can
    be split."""
    first = each.groupBy("seed").agg(
        F.min("doc_id").alias("other"), F.max("doc_id").alias("last"),
        F.min(F.struct("doc_id", "p")).alias("at"),
    ).filter("other < last")
    first = stages.write(first.select("seed", "other", F.col("at.p").alias("q")), "first")
    return each.join(first, "seed").select("doc_id", "seed", "p", "length", "other", "q")


def scattered(seed: np.ndarray, other: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[tuple[int, list[int]]]:
    """Keys and places of the runs of a document's repeated seeds that their own first
    holders don't give: the holders differ, or have the seeds apart. A seed has the same
    first holder in all documents, so a run is in all of them scattered, or in none."""
    order = np.argsort(p, kind="stable")
    seed, other, p, q = (x[order] for x in (seed, other, p, q))
    step = np.diff(q)
    apart = (other[1:] != other[:-1]) | (step <= 0) | (step > RUN_STEP)
    out = []
    for n in RUNS:
        if len(p) < n:
            break
        over = lambda x: np.lib.stride_tricks.sliding_window_view(x, n - 1)
        first = np.flatnonzero(over(apart).any(axis=1) & (over(np.diff(p)) <= RUN_STEP).all(axis=1))
        with np.errstate(over="ignore"):
            key = np.full(len(first), n, np.uint64)
            for k in range(n):
                key = mixed(key * _MIX[0] + seed[first + k].view(np.uint64))
        places = p[first[:, None] + np.arange(n)]
        out += zip(key.view(np.int64).tolist(), places.tolist())
    return out


def _run_links(met: DataFrame, stages: Stages) -> DataFrame:
    """(doc_id, other, p, q): places of scattered runs, each with the run's first one, if
    that is in another document."""

    @F.arrow_udf("array<struct<run: long, p: array<int>>>")
    def runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = _columns(batch, 4)
            ends = batch.offsets.to_numpy()
            found = [
                scattered(*(columns[k][a:b] for k in (0, 1, 2, 3))) for a, b in zip(ends, ends[1:])
            ]
            flat = [r for f in found for r in f]
            places = pa.ListArray.from_arrays(
                _offsets([len(at) for _, at in flat]),
                pa.array([x for _, at in flat for x in at], pa.int32()),
            )
            keys = pa.array([key for key, _ in flat], pa.int64())
            rows = pa.StructArray.from_arrays([keys, places], ["run", "p"])
            yield pa.ListArray.from_arrays(_offsets([len(f) for f in found]), rows)

    each = stages.write(met.select("doc_id", F.inline(runs("matches"))), "runs")
    first = each.groupBy("run").agg(
        F.min("doc_id").alias("other"), F.max("doc_id").alias("last"),
        F.min(F.struct("doc_id", "p")).alias("at"),
    ).filter("other < last")
    first = stages.write(first.select("run", "other", F.col("at.p").alias("q")), "first-runs")
    return each.join(first, "run").filter("doc_id <> other").select("doc_id", "other", "p", "q")


def _columns(lists: pa.Array, n: int) -> list[np.ndarray]:
    """The first ``n`` fields of all structs in an array of lists of them."""
    return [lists.values.field(k).to_numpy(zero_copy_only=False) for k in range(n)]


def _chained(doc_id: Column, matches: Column, more: Column) -> Column:
    """Chains of a document's matches, per other document."""

    @F.arrow_udf(f"array<{CHAIN}>")
    def chain(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for ids, batch, runs in batches:
            _, other_, p_, q_, length_ = _columns(batch, 5)
            ends = batch.offsets.to_numpy()
            found, counts = [], []  # others and places of chains; how many per row
            for own, a, b, extra in zip(ids.to_pylist(), ends, ends[1:], runs):
                other, p, q, length = (x[a:b][other_[a:b] != own] for x in (other_, p_, q_, length_))
                if extra.is_valid:
                    links = extra.as_py()
                    other = np.r_[other, np.repeat([r["other"] for r in links], [len(r["p"]) for r in links])]
                    p = np.r_[p, [x for r in links for x in r["p"]]]
                    q = np.r_[q, [x for r in links for x in r["q"]]]
                    length = np.r_[length, np.full(len(p) - len(length), SEED)]
                    order = np.lexsort((-length, q, p, other))
                    other, p, q, length = (x[order] for x in (other, p, q, length))
                    new = np.ones(len(p), bool)
                    new[1:] = (other[1:] != other[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
                    other, p, q, length = (x[new] for x in (other, p, q, length))
                before = len(found)
                order = np.argsort(other, kind="stable")
                cuts = np.flatnonzero(np.diff(other[order])) + 1
                for group in np.split(order, cuts) if len(order) else []:
                    if len(group) >= LEAST_MATCHES or length[group].max() >= LEAST_CHAIN:
                        found += [
                            (int(other[group[0]]), p[group[c]], q[group[c]])
                            for c in chains(p[group], q[group])
                            if len(c) >= LEAST_MATCHES or length[group[c]].max() >= LEAST_CHAIN
                        ]
                counts.append(len(found) - before)
            inner = _offsets([len(c[1]) for c in found])
            flat = lambda k: np.concatenate([c[k] for c in found] or [[]]).astype(np.int32)
            columns = [
                pa.array([c[0] for c in found], pa.int64()),
                *(pa.ListArray.from_arrays(inner, pa.array(flat(k))) for k in (1, 2)),
            ]
            rows = pa.StructArray.from_arrays(columns, ["other", "p", "q"])
            yield pa.ListArray.from_arrays(_offsets(counts), rows)

    return chain(doc_id, matches, more)


def _offsets(lengths: list[int]) -> pa.Array:
    return pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))


def _aligned(text: Column, other: Column, p: Column, q: Column, least_words: int) -> Column:
    fields = ["first_word", "end_word", "match_first", "match_end", "n_equal"]

    @F.arrow_udf(f"array<struct<{', '.join(f'{f}: int' for f in fields)}>>")
    def align(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        hashes, known, held = WordHashes(), {}, 0

        def ids(text: str) -> list[int]:
            nonlocal held
            found = known.get(text)
            if found is None:
                if held > REMEMBERED_BYTES:
                    known.clear()
                    held = 0
                found = known[text] = hashes.of(text).tolist()
                held += len(text) + 40 * len(found)
            return found

        for columns in batches:
            out = [
                stretches(ids(a), ids(b), p, q, least_words)
                for a, b, p, q in zip(*(c.to_pylist() for c in columns))
            ]
            flat = np.array([s for found in out for s in found], np.int32).reshape(-1, len(fields))
            rows = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields)
            yield pa.ListArray.from_arrays(_offsets([len(found) for found in out]), rows)

    return align(text, other, p, q)
