"""Audit of how the sources of a language differ in their words, in exact integers.

Every source of a language, and the language as a whole, gives each kept term a smoothed
share of its words. Two reports: how far each two sources are apart (sum of the absolute
differences of all shares), and the terms that a source uses most beyond its language.

The second needs the first ``k`` terms of each group by p - q, p the group's share and q
the language's. p rises with the group's count of a term, q with the language's, whatever
the totals are. So a term cannot be among the first k if k others have at least its count in
the group, at most its count in the language, and come earlier in UTF-8: it is dominated by
them. Partitions keep only the terms dominated by fewer than k others (their k-skyband),
skybands of parts are merged into skybands of the whole, and only what is left is ranked.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages

#: Documents of a language that must have a term, terms reported of a group.
LEAST_DOCUMENTS, TOP = 30, 50
#: Added to each count, and the whole of a share.
ADDED, WHOLE = 5, 1_000_000_000
#: Sources that are compared with each other at once, and (source, term) rows of a task.
SOURCES, TASK_ROWS = 128, 400_000
#: Different (group, term) pairs that a task counts before it hands them on.
COUNTED = 500_000
#: One document, added to the number of times that a term was counted.
DOCUMENT = 1 << 40
#: Rows whose skybands are taken at once.
HELD = 200_000
#: Parts of a group's terms whose skybands are merged before those of the whole group.
PARTS = 16

#: a-z and all bytes above ASCII are kept, A-Z become a-z, all else ends a term.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) for parts of ``docs`` (lang, source, text): how often a
    group has a term, and in how many documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, int]] = {}
        size = 0
        for batch in batches:
            langs, sources, texts = (batch.column(i) for i in range(3))
            for lang, source, text in zip(langs, sources, texts):
                group = held.setdefault((lang.as_py(), source.as_py()), {})
                size -= len(group)
                known = group.get
                for term, n in Counter(terms(text.as_py())).items():
                    group[term] = known(term, 0) + n + DOCUMENT
                size += len(group)
                if size >= COUNTED:
                    yield from emitted(held)
                    held, size = {}, 0
        yield from emitted(held)

    def emitted(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in held.items():
            names, both = list(counts), list(counts.values())
            for start in range(0, len(names), 50_000):
                part = names[start : start + 50_000]
                found = both[start : start + 50_000]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(part), pa.string()),
                        "source": pa.array([source] * len(part), pa.string()),
                        "term": pa.array([t.decode("utf-8", "replace") for t in part], pa.string()),
                        "n": pa.array([x % DOCUMENT for x in found], pa.int64()),
                        "docs": pa.array([x // DOCUMENT for x in found], pa.int64()),
                    }
                )

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def skyband(ours: np.ndarray, all_: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """The places of the terms that fewer than ``k`` others dominate. ``ours`` are the
    counts in the group, ``all_`` those in the language, ``rank`` is the order in UTF-8.

    In the order of falling ``ours``, rising ``all_`` and names each term comes after those
    that dominate it. It is enough to count those that were kept: a term that k others
    dominate is dominated by k of the skyband too.
    """
    order = np.lexsort((rank, all_, -ours))
    # Of equal counts the first k by name dominate the others.
    o, a = ours[order], all_[order]
    new = np.ones(len(order), bool)
    new[1:] = (o[1:] != o[:-1]) | (a[1:] != a[:-1])
    starts = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    order = order[place < k]
    kept_all, kept_rank = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    kept: list[int] = []
    for i in order:
        n = len(kept)
        if n >= k:
            over = (kept_all[:n] <= all_[i]) & (kept_rank[:n] < rank[i])
            if np.count_nonzero(over) >= k:
                continue
        kept_all[n], kept_rank[n] = all_[i], rank[i]
        kept.append(i)
    return np.array(kept, dtype=np.int64)


_SKYBAND = "lang string, source string, term string, n long, n_lang long"


def skybands(held: DataFrame, k: int) -> DataFrame:
    """The k-skybands of the groups within runs of each partition of ``held`` (lang, source,
    term, n, n_lang)."""

    def reduce(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        rank = np.empty(len(rows), np.int64)
        rank[pc.sort_indices(rows["term"]).to_numpy()] = np.arange(len(rows))
        ours, all_ = rows["n"].to_numpy(), rows["n_lang"].to_numpy()
        codes = [c.combine_chunks().dictionary_encode().indices.to_numpy() for c in (rows["lang"], rows["source"])]
        group = codes[0].astype(np.int64) * len(rows) + codes[1]
        order = np.argsort(group, kind="stable")
        kept = [
            part[skyband(ours[part], all_[part], rank[part], k)]
            for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
        ]
        yield from rows.take(pa.array(np.concatenate(kept))).to_batches()

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, size = [], 0
        for batch in batches:
            if batch.num_rows:
                run.append(batch)
                size += batch.num_rows
            if size >= HELD:
                yield from reduce(run)
                run, size = [], 0
        if run:
            yield from reduce(run)

    return held.mapInArrow(reduced, _SKYBAND)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(WHOLE * (count + ADDED) / (total + ADDED * kept)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = (wide(count) + F.lit(ADDED)) * F.lit(WHOLE).cast("decimal(10,0)")
    below = wide(total) + wide(kept) * F.lit(ADDED).cast("decimal(2,0)")
    return F.lit(1) + F.call_function("div", above, below)


def _distances(held: DataFrame, groups: DataFrame, stages: Stages) -> DataFrame:
    """(lang, source, item, difference): for pairs of sources, source < item, the sum over
    the terms that one of their blocks has of |p - q| less what a term gives that neither
    has. Sources are dealt to blocks of about SOURCES, terms to slices, and each pair of
    blocks is compared slice by slice."""
    sizes = held.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    dealt = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(sizes, "lang")
    dealt = dealt.select(
        "lang",
        F.ceil(F.col("sources") / SOURCES).alias("blocks"),
        F.ceil(F.col("rows") * 2 / F.ceil(F.col("sources") / SOURCES) / TASK_ROWS).alias("slices"),
    )
    placed = groups.select("lang", "source", "n_source", "kept", "base").join(dealt, "lang")
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block")
    placed = stages.write(placed.select("*", block), "placed")
    keyed = held.join(placed, ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("n_source"), F.col("kept")).alias("p"),
        "base", "blocks", "slices", "block",
    )
    # A row goes to each pair of blocks that its own block is in.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    keyed = keyed.select("*", other).select(
        "lang",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"),
        "source", "term", "p", "base", "block",
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, one, two, _ = key
        sources = rows.drop_duplicates("source").set_index("source")[["base", "block"]].sort_index()
        names, base = sources.index.to_numpy(), sources["base"].to_numpy()
        column = pd.Series(np.arange(len(names)), index=names)[rows["source"]].to_numpy()
        line, found = pd.factorize(rows["term"])
        first = np.flatnonzero(sources["block"] == one)
        second = np.flatnonzero(sources["block"] == two)
        sums = np.zeros((len(first), len(second)), np.int64)
        none = np.abs(base[first][:, None] - base[second][None, :])
        order = np.argsort(line, kind="stable")
        at_once = max(1, 2_000_000 // max(1, len(names)))
        edges = np.searchsorted(line[order], np.arange(0, len(found) + at_once, at_once))
        for number, (start, end) in enumerate(zip(edges[:-1], edges[1:])):
            part = order[start:end]
            lines = min(at_once, len(found) - number * at_once)
            table = np.tile(base, (lines, 1))
            table[line[part] - number * at_once, column[part]] = rows["p"].to_numpy()[part]
            for i, source in enumerate(first):
                sums[i] += np.abs(table[:, second] - table[:, [source]]).sum(axis=0) - lines * none[i]
        i, j = np.nonzero(names[first][:, None] != names[second][None, :])
        a, b = names[first][i], names[second][j]
        made = pd.DataFrame({"a": a, "b": b, "difference": sums[i, j]})
        if one == two:
            made = made[made["a"] < made["b"]]
        made.insert(0, "lang", key[0])
        return made

    # Said outright: rows that are dealt by language already would stay where they are.
    keyed = keyed.repartition("lang", "one", "two", "slice")
    parts = keyed.groupBy("lang", "one", "two", "slice").applyInPandas(
        compare, "lang string, a string, b string, difference long"
    )
    pair = [F.least("a", "b").alias("source"), F.greatest("a", "b").alias("item")]
    return parts.groupBy("lang", *pair).agg(F.sum("difference").alias("difference"))


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair`` has, for each source of a
    language, all others by falling distance; part ``term`` the first ``top`` terms that
    the source uses more than its language, by falling difference of the shares. Equal
    values rank by item in UTF-8.

    Null texts, languages and sources are empty strings, and groups of their own. Terms are
    runs of letters a-z (A-Z are lowered) and non-ASCII characters; texts of any length are
    read whole. Repeated rows count each. A language with one source has no pairs, one
    without a kept term has distances of 0 and no terms. An empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "divergence")
    empty = F.lit("")
    docs = docs.select(
        F.coalesce(lang, empty).alias("lang"),
        F.coalesce(source, empty).alias("source"),
        F.coalesce(text, empty).alias("text"),
    )
    counts = term_counts(docs).groupBy("lang", "source", "term")
    counts = stages.write(counts.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    kept = stages.write(kept.filter(F.col("docs") >= least_documents).drop("docs"), "kept")
    held = stages.write(counts.drop("docs").join(kept, ["lang", "term"]), "held")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("of_lang"))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").select(
        "lang",
        "source",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_source", "kept", "of_lang")],
    )
    base = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("n_source"), F.col("kept")))
    groups = stages.write(groups.withColumn("base", F.coalesce(base, F.lit(0).cast("long"))), "groups")

    # Terms: skybands of the partitions, of parts of each group, of each group.
    local = skybands(held.select("lang", "source", "term", "n", "n_lang"), top)
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS))
    merged = skybands(local.repartition("lang", "source", part), top)
    merged = skybands(merged.repartition("lang", "source"), top)
    named = merged.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (
            _share(F.col("n"), F.col("n_source"), F.col("kept"))
            - _share(F.col("n_lang"), F.col("of_lang"), F.col("kept"))
        ).alias("value"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_terms = named.filter("value > 0").withColumn("rank", F.row_number().over(order))
    of_terms = of_terms.filter(F.col("rank") <= top)

    # Pairs: a term that neither source has gives |base - base|.
    others = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other_base"))
    pairs = groups.join(others, "lang").filter("source <> item")
    near = stages.write(_distances(held, groups, stages), "distances")
    both = near.unionByName(
        near.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "difference")
    )
    apart = F.coalesce("difference", F.lit(0)) + F.col("kept") * F.abs(F.col("base") - F.col("other_base"))
    pairs = pairs.join(both, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", "item", apart.alias("value"))
    of_pairs = pairs.withColumn("rank", F.row_number().over(order))
    return _part(of_pairs, "pair").unionByName(_part(of_terms, "term"))


def _part(ranked: DataFrame, name: str) -> DataFrame:
    return ranked.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
