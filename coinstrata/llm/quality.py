"""Quality rules: base counts of a text, and robust multivariate outliers.

Each text gets a vector of transformed statistics. Per language and source the minimum
covariance determinant (Rousseeuw; concentration steps from deterministic starts after
Hubert, Rousseeuw and Verdonck) gives a centre and a scatter that outliers do not reach,
and texts beyond a Mahalanobis distance are rejected.

Everything is built-in functions, and no group ever meets in one task: moments are sums
that combine in the map tasks, and the h-quantile that a concentration step needs is read
from a histogram of the distances, so a step takes all texts up to the bin in which the
quantile falls.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages, carried

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

#: The statistics, in order, with the smallest standard deviation that a group can have in
#: each: texts closer than that are alike for the purpose. All are far below what a
#: statistic can reach, so that each of them can reject alone; the share of duplicate lines
#: has 0.1, as one line of three is an ordinary repeat.
STATISTICS = {"log_words": 0.2, "log_word_chars": 0.1, "symbol_share": 0.01, "dup_line_share": 0.1}
#: Share of a group that the estimate must cover, concentration steps, texts that a group
#: needs for an estimate of its own, and the share of clean texts that may be rejected.
COVERED, STEPS, LEAST_TEXTS, TAIL = 0.75, 6, 100, 1e-6
#: Up to so many groups (of some twenty numbers each) their tables are broadcast to the
#: texts; more are joined by shuffles, where adaptive execution splits hot groups.
GROUPS_BROADCAST = 20_000
#: Histogram bins of a unit, of the statistics and of ln(1 + squared distance).
BINS = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more in the array of words.

    Windows are compared by a 64-bit hash within one text. A text whose windows all differ
    is settled at once; else the windows are sorted by hash, those equal to a neighbour are
    marked, and each adds the words up to the next marked one, eight at most.
    """

    def repeated(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(F.array_sort(placed), lambda s: let(marked(s), covered))

    def marked(s: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        places = F.transform(s, lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"]))
        return F.array_sort(F.filter(places, lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        new = lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
        return F.aggregate(F.transform(p, new), F.lit(0), lambda a, x: a + x)

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    count = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(repeated(h)),
    )
    return F.when(F.size(words) > WINDOW, count).otherwise(0).cast("long")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines
    (lines with a word) and base_failed, of the whole text; columns of these names are
    replaced. A null text has no words and fails."""
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    whole = F.coalesce(docs[text], F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD))
    split = docs.select(
        carried(docs, [*made, "base_failed"]).alias("row"),
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    counted = split.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    ).select("row.*", *made)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def statistics() -> dict[str, Column]:
    """The transformed statistics of base counts with a word at least."""
    return {
        "log_words": F.log("n_words"),
        "log_word_chars": F.log(F.col("word_chars") / F.col("n_words")),
        "symbol_share": F.least(F.col("n_symbols") / F.col("word_chars"), F.lit(1.0)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
    }


def chi_square_quantile(tail: float, d: int) -> float:
    """Where the chi-square distribution of ``d`` degrees leaves ``tail`` above."""

    def above(x: float) -> float:
        if d % 2:
            total, term = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi)
        else:
            total, term = 0.0, 1.0
        for k in range(d // 2):
            total += term * math.exp(-x / 2)
            term *= x / (2 * k + (3 if d % 2 else 2))
        return total

    low, high = 0.0, 10.0 * d + 100
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > tail else (low, middle)
    return low


def consistency(covered: float, d: int) -> float:
    """Factor that makes the covariance of the central share unbiased for a normal law."""
    edge = chi_square_quantile(1 - covered, d)
    low, high = 0.0, 1.0  # the share of the law with d + 2 degrees below the edge
    for _ in range(60):
        middle = (low + high) / 2
        inside = chi_square_quantile(1 - middle, d + 2) < edge
        low, high = (middle, high) if inside else (low, middle)
    return covered / low


def _sent(groups: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(groups) if few else groups


def _at_quantile(rows: DataFrame, group: list[str], value: Column, share: float) -> DataFrame:
    """(group, at): the upper edge of the bin in which the quantile of ``value`` falls."""
    bins = rows.select(*group, F.floor(value * BINS).alias("_bin"))
    counts = bins.groupBy(*group, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    so_far = Window.partitionBy(*group).orderBy("_bin")
    whole = Window.partitionBy(*group)
    summed = counts.select(
        *group, "_bin", F.sum("_n").over(so_far).alias("_below"), F.sum("_n").over(whole).alias("_all")
    )
    reached = summed.filter(F.col("_below") >= F.ceil(F.col("_all") * share))
    return reached.groupBy(*group).agg(((F.min("_bin") + 1) / F.lit(float(BINS))).alias("at"))


class _Shape:
    """Columns of a group's centre ``m_i`` and inverse Cholesky factor ``u_i_j``."""

    def __init__(self, names: list[str], floors: list[float]):
        self.names, self.floors, self.d = names, floors, len(names)
        self.pairs = [(i, j) for i in range(self.d) for j in range(i + 1)]
        self.columns = [f"m_{i}" for i in range(self.d)]
        self.columns += [f"u_{i}_{j}" for i, j in self.pairs] + ["log_det"]

    def distance(self) -> Column:
        """Squared Mahalanobis distance of a row that carries its group's columns."""
        away = [F.col(n) - F.col(f"m_{i}") for i, n in enumerate(self.names)]
        total = F.lit(0.0)
        for i in range(self.d):
            y = sum((F.col(f"u_{i}_{j}") * away[j] for j in range(i + 1)), F.lit(0.0))
            total = total + y * y
        return total

    def moments(self) -> list[Column]:
        cov = [
            F.covar_pop(self.names[i], self.names[j]).alias(f"c_{i}_{j}") for i, j in self.pairs
        ]
        return [F.avg(n).alias(f"m_{i}") for i, n in enumerate(self.names)] + cov

    def factored(self, groups: DataFrame, scale: float) -> DataFrame:
        """Covariances ``c_i_j`` to inverse Cholesky factors; the floors keep every group's
        scatter invertible."""
        keys = [c for c in groups.columns if not c.startswith(("m_", "c_"))]
        kept = [F.col(c) for c in (*keys, *(f"m_{i}" for i in range(self.d)))]
        lower: dict[tuple, str] = {}
        out = groups
        for i in range(self.d):
            for j in range(i + 1):
                entry = F.col(f"c_{i}_{j}") * scale + (self.floors[i] ** 2 if i == j else 0.0)
                for k in range(j):
                    entry = entry - F.col(lower[i, k]) * F.col(lower[j, k])
                lower[i, j] = f"l_{i}_{j}"
                entry = F.sqrt(entry) if i == j else entry / F.col(lower[j, j])
                out = out.withColumn(lower[i, j], entry)
        for i in range(self.d):
            for j in range(i, -1, -1):
                if i == j:
                    entry = 1 / F.col(lower[i, i])
                else:
                    inner = [F.col(lower[i, k]) * F.col(f"u_{k}_{j}") for k in range(j, i)]
                    entry = -sum(inner[1:], inner[0]) / F.col(lower[i, i])
                out = out.withColumn(f"u_{i}_{j}", entry)
        log_det = sum((F.log(lower[i, i]) for i in range(self.d)), F.lit(0.0))
        factors = [F.col(f"u_{i}_{j}") for i, j in self.pairs]
        return out.select(*kept, *factors, log_det.alias("log_det"))


def fit(
    vectors: DataFrame, stages: Stages, floors: dict[str, float] = STATISTICS,
    covered: float = COVERED, steps: int = STEPS, few: bool = False,
) -> DataFrame:
    """(group, shape columns) for ``vectors`` (group, statistics): the reweighted minimum
    covariance determinant of each group. ``few``: groups are at most GROUPS_BROADCAST."""
    names = list(floors)
    shape = _Shape(names, list(floors.values()))
    starts = stages.write(_starts(vectors, shape, few), "start")
    scale = consistency(covered, shape.d)
    current = starts
    for step in range(steps):
        spread = F.log(1 + shape.distance())
        rows = vectors.join(_sent(current, few), "group").select("group", "start", *names, spread.alias("_far"))
        edge = _at_quantile(rows, ["group", "start"], F.col("_far"), covered)
        near = rows.join(_sent(edge, few), ["group", "start"]).filter(F.col("_far") < F.col("at"))
        moments = near.groupBy("group", "start").agg(*shape.moments())
        current = stages.write(shape.factored(moments, scale), f"step-{step}")
    best = current.groupBy("group").agg(
        F.min(F.struct("log_det", "start", *[c for c in shape.columns if c != "log_det"])).alias("b")
    )
    best = best.select("group", *[F.col(f"b.{c}").alias(c) for c in shape.columns])
    rows = vectors.join(_sent(best, few), "group")
    inner = rows.filter(shape.distance() <= chi_square_quantile(0.025, shape.d))
    weighted = inner.groupBy("group").agg(*shape.moments())
    return stages.write(shape.factored(weighted, consistency(0.975, shape.d)), "shape")


def _starts(vectors: DataFrame, shape: _Shape, few: bool) -> DataFrame:
    """Two starts for each group, both about the medians: the absolute deviations alone,
    and the covariance of directions (spatial signs) in units of these deviations."""
    long = vectors.select(
        "group",
        F.inline(F.array(*[F.struct(F.lit(i).alias("s"), F.col(n).alias("x")) for i, n in enumerate(shape.names)])),
    )
    medians = _at_quantile(long, ["group", "s"], F.col("x"), 0.5).withColumnRenamed("at", "m")
    away = long.join(_sent(medians, few), ["group", "s"]).select(
        "group", "s", "m", F.abs(F.col("x") - F.col("m")).alias("x")
    )
    spread = _at_quantile(away, ["group", "s"], F.col("x"), 0.5).withColumnRenamed("at", "mad")
    both = medians.join(spread, ["group", "s"])
    of = lambda i, c: F.max(F.when(F.col("s") == i, F.col(c)))
    centres = both.groupBy("group").agg(
        *[of(i, "m").alias(f"m_{i}") for i in range(shape.d)],
        *[(1.4826 * of(i, "mad") + shape.floors[i]).alias(f"w_{i}") for i in range(shape.d)],
    )
    plain = centres.select(
        "group", F.lit(0).alias("start"), *[f"m_{i}" for i in range(shape.d)],
        *[(F.pow(f"w_{i}", F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in shape.pairs],
    )
    rows = vectors.join(_sent(centres, few), "group")
    unit = [(F.col(n) - F.col(f"m_{i}")) / F.col(f"w_{i}") for i, n in enumerate(shape.names)]
    norm = F.greatest(F.sqrt(sum((u * u for u in unit), F.lit(0.0))), F.lit(1e-9))
    signs = rows.select(
        "group", *[(u / norm).alias(f"y_{i}") for i, u in enumerate(unit)],
        *[c for c in centres.columns if c != "group"],
    )
    directed = signs.groupBy("group").agg(
        *[F.first(c).alias(c) for c in centres.columns if c != "group"],
        *[F.avg(F.col(f"y_{i}") * F.col(f"y_{j}")).alias(f"a_{i}_{j}") for i, j in shape.pairs],
    )
    signed = directed.select(
        "group", F.lit(1).alias("start"), *[f"m_{i}" for i in range(shape.d)],
        *[(shape.d * F.col(f"a_{i}_{j}") * F.col(f"w_{i}") * F.col(f"w_{j}")).alias(f"c_{i}_{j}") for i, j in shape.pairs],
    )
    return shape.factored(plain.unionByName(signed), 1.0)


def judge(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
    source: str = "source", least_texts: int = LEAST_TEXTS, tail: float = TAIL,
) -> DataFrame:
    """(doc_id, base counts, base_failed, distance, kept), one row for each row of ``docs``.

    A text that fails the base rules is not kept and takes no part in the estimates. A
    language and source with fewer than ``least_texts`` texts is judged by the estimate of
    its language, or else of all texts; where even these are fewer, nothing more is
    rejected and the distance is null. Null languages and sources are groups of their own.
    """
    stages = Stages(docs.sparkSession, "quality")
    named = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("_lang"),
        F.col(source).cast("string").alias("_source"), F.col(text).alias("_text"),
    )
    counts = base_counts(named, "_text").drop("_text")
    names = list(STATISTICS)
    passed = F.when(~F.col("base_failed"), F.struct(*[c.alias(n) for n, c in statistics().items()]))
    counts = stages.write(counts.withColumn("_vector", passed), "counts")
    keys = [
        F.to_json(F.array(F.lit("source"), F.col("_lang"), F.col("_source"))),
        F.to_json(F.array(F.lit("lang"), F.col("_lang"))),
        F.to_json(F.array(F.lit("all"))),
    ]
    levels = counts.filter("not base_failed").select(
        F.explode(F.array(*keys)).alias("group"), *[f"_vector.{n}" for n in names]
    )
    sizes = levels.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    large = stages.write(sizes.filter(F.col("_n") >= least_texts).select("group"), "groups")
    few = large.count() <= GROUPS_BROADCAST
    shapes = fit(levels.join(_sent(large, few), "group"), stages, few=few)
    shape = _Shape(names, list(STATISTICS.values()))
    packed = shapes.select("group", F.struct(*shape.columns).alias("_shape"))
    judged = counts
    for i, key in enumerate(keys[:2]):
        own = packed.select(F.col("group").alias(f"_g{i}"), F.col("_shape").alias(f"_s{i}"))
        judged = judged.join(_sent(own, few), key == F.col(f"_g{i}"), "left")
    # The estimate of all texts is one row, or none.
    overall = packed.filter(F.col("group") == keys[2]).select("_shape").scalar()
    used = F.coalesce("_s0", "_s1", overall)
    out = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
    ]
    rows = judged.select(*out, used.alias("_used"), "_vector")
    rows = rows.select(*out, "_vector.*", "_used.*").withColumn("distance", F.sqrt(shape.distance()))
    limit = math.sqrt(chi_square_quantile(tail, shape.d))
    beyond = F.coalesce(F.col("distance") > limit, F.lit(False))
    return rows.select(*out, "distance", (~F.col("base_failed") & ~beyond).alias("kept"))
