"""Quality from preference pairs: a Bradley-Terry model of document scores.

A document's score is linear in its features.  That one document is preferred to
another has the probability ``1 / (1 + exp(-(difference of their scores)))``, so
the model is fitted by logistic loss on feature differences of pairs of a good
and a bad document.  The documents kept are those above a score quantile: the
share of bad ones among the labelled documents.  That threshold is mapped to 0.7.

The fit is the only work on the driver.  It sees at most ``MOST_ROWS`` labelled
rows, those with the smallest hash of their id, as ``len(FEATURES)`` numbers
each.  Features and scores are computed for all documents in tasks.

Defined results: a null or empty text has all features zero and is scored like
others.  A null id is never held out and has no label.  Several labels of one id
count as rows of their own, null labels as none.  Without labels of both kinds
every score is 0.5.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import measures, shared

MOST_ROWS = 20_000
PAIRS = 200_000
ACCEPT = 0.7
_EDGE = 6.0


def features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    size = F.greatest(F.col("n_bytes"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "length": F.log1p("n_words"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "distinct": F.col("n_distinct_words") / words,
        "line_length": F.log1p(F.col("n_words") / lines),
        "upper": F.col("n_upper") / size,
        "digits": F.col("n_digits") / size,
        "stops": F.col("n_stops") / words,
        "bangs": F.col("n_bangs") / words,
        "pipes": F.col("n_pipes") / words,
        "ascii": F.col("n_ascii") / size,
    }


FEATURES = (
    "length", "word_length", "symbols", "dup_lines", "repeats", "distinct", "line_length", "upper", "digits",
    "stops", "bangs", "pipes", "ascii",
)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def featured(docs: DataFrame) -> DataFrame:
    counted = docs.select("doc_id", measures.measured("text").alias("m")).select(
        "doc_id", *(f"m.{n}" for n in measures.NAMES)
    )
    made = features()
    return counted.select("doc_id", *(made[f].cast("double").alias(f) for f in FEATURES))


class Model:
    """Means, spreads and weights of the features, and the score at the threshold."""

    def __init__(self, x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3) -> None:
        self.fitted = bool(good.any() and not good.all())
        if not self.fitted:
            return
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._scaled(x)
        draw = np.random.default_rng(11)
        better = draw.choice(np.flatnonzero(good), pairs)
        worse = draw.choice(np.flatnonzero(~good), pairs)
        self.weights = _logistic(z[better] - z[worse], ridge)
        scores = np.sort(z @ self.weights)
        bad = int((~good).sum())
        self.threshold = float(scores[bad - 1] + scores[bad]) / 2

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -_EDGE, _EDGE)

    def score(self) -> Column:
        if not self.fitted:
            return F.lit(0.5)
        total = F.lit(math.log(ACCEPT / (1 - ACCEPT)) - self.threshold)
        for name, m, s, w in zip(FEATURES, self.mean, self.spread, self.weights):
            z = (F.col(name) - float(m)) / float(s)
            total += F.greatest(F.least(z, F.lit(_EDGE)), F.lit(-_EDGE)) * float(w)
        return 1 / (1 + F.exp(-total))


def _logistic(difference: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps on the mean logistic loss of the differences, which all should be positive."""
    weights = np.zeros(difference.shape[1])
    for _ in range(25):
        miss = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        slope = difference.T @ miss / len(miss) - ridge * weights
        curve = (difference * (miss * (1 - miss))[:, None]).T @ difference / len(miss)
        step = np.linalg.solve(curve + ridge * np.eye(len(weights)), slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fitted(rows: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """A model from labelled rows that are not held out, ``most`` at most."""
    known = labels.where("quality IS NOT NULL").select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("good")
    )
    train = rows.where(~held_out()).join(known, F.col("doc_id") == F.col("_id"))
    train = shared.written(train.select("doc_id", *FEATURES, "good"), "quality-labelled")
    sample = shared.sample(train, most, "doc_id").toPandas()
    return Model(sample[list(FEATURES)].to_numpy(dtype=float), sample["good"].to_numpy(dtype=bool))


def scored(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document."""
    rows = shared.written(featured(docs), "quality-features")
    score = fitted(rows, labels, most).score()
    return rows.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
