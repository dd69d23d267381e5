"""Toxicity by non-negative positive-unlabelled learning.

After Kiryo, Niu, du Plessis and Sugiyama, "Positive-unlabeled learning with non-negative
risk estimator" (NIPS 2017). The classifier sees confirmed toxic texts and a sample of
all texts with labels ignored, of which a share, the class prior, is toxic as well. With
logistic loss l and prior p the risk is

    p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)])

The second part estimates the risk of the clean class; it cannot truly be negative, so
where the estimate falls below zero the step goes against its gradient.

Features are words in lower case and word beginnings of four and five letters, as present
or absent. Only those that are told apart by the two samples are kept. Everything that is
fitted has a stated bound: documents per sample, and features.
"""

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.llm.common import Stages

#: Documents of the two samples, the smallest by a hash of the id. The bound of the fit.
POSITIVES, UNLABELLED = 3_000, 9_000
#: Characters of text in a sample document that takes part in the fit; longer ones are
#: passed over as sample members (every text is scored whole).
SAMPLE_CHARS = 50_000
#: Features: in so many sample documents at least, told apart by so many standard errors,
#: and the best so many of them.
LEAST_DOCS, LEAST_Z, FEATURES = 8, 4.0, 20_000
BEGINNINGS = (4, 5)
#: Words remembered by a scoring task.
REMEMBERED = 300_000

_WORD = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(word: str) -> list[str]:
    """The word, and its beginnings with a mark; beginnings of longer words only."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def _features(text: str) -> Column:
    @F.pandas_udf("array<string>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({f for w in words_of(t) for f in features_of(w)}) for t in texts])

    return features(text)


def risks(g: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """The risk of the toxic class, the corrected risk of the clean one, and the slope of
    what is made smaller, by each row's score: their sum while the clean risk is not
    negative, else minus the clean risk, which brings it back."""
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    up = 1 / (1 + np.exp(-np.clip(g, -50, 50)))  # the slope of l(-g); that of l(g) is up - 1
    loss_clean = np.logaddexp(0, g)
    toxic_risk = prior * np.logaddexp(0, -g)[positive].sum() / n_p
    clean_risk = loss_clean[~positive].sum() / n_u - prior * loss_clean[positive].sum() / n_p
    clean_slope = np.where(positive, -prior / n_p, 1 / n_u) * up
    if clean_risk >= 0:
        slope = np.where(positive, prior / n_p, 0) * (up - 1) + clean_slope
    else:
        slope = -clean_slope
    return float(toxic_risk), float(clean_risk), slope


def nn_pu(
    rows: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float,
    steps: int = 400, rate: float = 0.05, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear classifier of binary rows (lists of feature numbers),
    fitted by Adam with the non-negative risk; ``positive`` marks the confirmed rows, all
    others are unlabelled."""
    lengths = np.array([len(r) for r in rows])
    row_of = np.repeat(np.arange(len(rows)), lengths)
    column = np.concatenate(rows).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    w, b = np.zeros(n_features), np.log(prior / (1 - prior))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        g = np.bincount(row_of, weights=w[column], minlength=len(rows)) + b
        _, _, slope = risks(g, positive, prior)
        grad = np.bincount(column, weights=slope[row_of], minlength=n_features) + decay * w
        grad = np.append(grad, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


@dataclass
class ToxicityModel:
    """Weights of features, at most FEATURES of them, and the offset."""

    weights: dict[str, float]
    offset: float

    @classmethod
    def fit(
        cls, docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
        label: str = "toxic", prior: float | None = None,
    ) -> "ToxicityModel":
        """Fit on documents whose label is 1 and on a sample of all, whatever their label.

        Null ids and null labels count as unlabelled; an id with several labels is toxic if
        one of them is 1. The prior is the share of 1 among all labels, unless given; either
        way it is held between 0.001 and 0.5. Both samples are drawn from the documents of
        SAMPLE_CHARS characters or fewer. With no toxic document at all, or no other one, the model scores everything alike.
        """
        stages = Stages(docs.sparkSession, "toxicity")
        known = labels.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
        if prior is None:
            found = known.agg(F.avg((F.col("_label") == 1).cast("double"))).first()[0]
            prior = found or 0.0
        prior = min(max(prior, 1e-3), 0.5)
        sample = _sample(docs, known, text, doc_id)
        sample = stages.write(
            sample.select("_positive", _features("_text").alias("_features")), "sample"
        )
        counts = sample.select("_positive", F.explode("_features").alias("feature"))
        counts = counts.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("_positive").cast("int")).alias("n_p")
        )
        sizes = sample.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("_positive").cast("int")).alias("n_p")
        ).first()
        total_p, total_u = sizes["n_p"] or 0, sizes["n"] - (sizes["n_p"] or 0)
        if not total_p or not total_u:
            return cls({}, float(np.log(prior / (1 - prior))))
        vocabulary = _told_apart(counts, total_p, total_u).collect()
        numbers = {row["feature"]: i for i, row in enumerate(vocabulary)}
        rows, positive = [], []
        shared = docs.sparkSession.sparkContext.broadcast(numbers)

        @F.pandas_udf("array<int>")
        def numbered(features: pd.Series) -> pd.Series:
            of = shared.value
            return pd.Series([[of[f] for f in fs if f in of] for fs in features])

        for row in sample.select("_positive", numbered("_features").alias("f")).collect():
            rows.append(np.array(row["f"], dtype=np.int64))
            positive.append(bool(row["_positive"]))
        w, offset = nn_pu(rows, np.array(positive), len(numbers), prior)
        return cls({f: float(w[i]) for f, i in numbers.items() if abs(w[i]) > 1e-4}, offset)

    def score(self, text: Column, spark) -> Column:
        """Score of each whole text, 0 to 1. Null and empty texts have no features."""
        shared = spark.sparkContext.broadcast((self.weights, self.offset))

        @F.pandas_udf("double")
        def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scorer = _Scorer(*shared.value)
            for batch in texts:
                yield pd.Series([scorer.score(t) for t in batch], dtype="float64")

        return scored(text)


class _Scorer:
    """Remembers the weighted features of words, as most words have none."""

    def __init__(self, weights: dict[str, float], offset: float):
        self.weights, self.offset = weights, offset
        self.known: OrderedDict[str, tuple] = OrderedDict()

    def score(self, text: str | None) -> float:
        found: set[str] = set()
        known = self.known
        for word in words_of(text):
            features = known.get(word)
            if features is None:
                features = tuple(f for f in features_of(word) if f in self.weights)
                if len(known) >= REMEMBERED:
                    known.popitem(last=False)
                known[word] = features
            if features:
                found.update(features)
        g = self.offset + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(g, -50, 50))))


def _sample(docs: DataFrame, known: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(_positive, _text): both samples, chosen by a hash of the id. The unlabelled one is
    drawn from all documents, confirmed or not, since the prior is a share of them all."""
    short = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).filter(
        F.char_length("_text") <= SAMPLE_CHARS
    )
    ids = short.select("_id").filter("_id is not null").distinct()
    ids = ids.join(known, "_id", "left").select(
        "_id", F.coalesce(F.col("_label") == 1, F.lit(False)).alias("_positive")
    )
    order = [F.xxhash64(F.col("_id").cast("string")), F.col("_id")]
    chosen = ids.filter("_positive").orderBy(*order).limit(POSITIVES).unionByName(
        ids.withColumn("_positive", F.lit(False)).orderBy(*order).limit(UNLABELLED)
    )
    # At most POSITIVES + UNLABELLED ids of fixed size.
    members = short.join(F.broadcast(chosen), "_id")
    return members.groupBy("_id", "_positive").agg(F.min("_text").alias("_text"))


def _told_apart(counts: DataFrame, total_p: int, total_u: int) -> DataFrame:
    """The features whose shares differ most between the samples, in standard errors."""
    n_u = F.col("n") - F.col("n_p")
    share = F.col("n") / F.lit(float(total_p + total_u))
    error = F.sqrt(share * (1 - share) * F.lit(1 / total_p + 1 / total_u))
    z = F.abs(F.col("n_p") / F.lit(float(total_p)) - n_u / F.lit(float(total_u))) / error
    told = counts.filter(F.col("n") >= LEAST_DOCS).filter(share < 1).withColumn("z", z)
    return told.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(FEATURES)
