"""Quality: a regularised quadratic discriminant over transformed statistics of a document.

Each class has a normal density over the statistics; its covariance is shrunk towards the pooled one and towards a
sphere. The Cholesky factors are kept, so that a score is the difference of two Mahalanobis log-densities.

Defined results: null and empty texts have the statistics of an empty text and get a score like any other; repeated
rows get equal scores; a null id is in no fold, so that it is not held out; with no training rows, or rows of one class
only, every score is the smoothed share of good rows; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import crc_mod_col, read, small_batches, training_rows

#: At most so many labelled rows are fitted on.
TRAIN_ROWS = 6000
TO_POOLED, TO_SPHERE = 0.2, 0.05
THRESHOLD = 0.7
FOLDS, HELD = 4, 2

_BYTES = np.arange(256)
_UPPER = ((_BYTES >= 65) & (_BYTES <= 90)).astype(float)
_LOWER = ((_BYTES >= 97) & (_BYTES <= 122)).astype(float)
_DIGIT = ((_BYTES >= 48) & (_BYTES <= 57)).astype(float)
_HIGH = (_BYTES >= 128).astype(float)
_MARK = np.array([chr(b) in "#$%&*@^~<>{}[]|\\_=+/" for b in _BYTES], float)
_SHOUT = np.array([chr(b) in "!?" for b in _BYTES], float)
_STOP = np.array([chr(b) in ".,;:" for b in _BYTES], float)
_SPACE = np.array([chr(b) in " \t\r\n\f\v" for b in _BYTES], float)
_TABLE = np.stack([_UPPER, _LOWER, _DIGIT, _HIGH, _MARK, _SHOUT, _STOP, _SPACE], 1)
_SENTENCE = re.compile(r"[.!?\n]+")


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a whole text."""
    text = text or ""
    data = np.frombuffer(text.encode(), np.uint8)
    upper, lower, digit, high, mark, shout, stop, space = np.bincount(data, minlength=256) @ _TABLE
    n = len(data) + 1.0
    letters = upper + lower + high + 1.0
    words = text.split()
    n_words = len(words) + 1.0
    sentences = sum(1 for x in _SENTENCE.split(text) if x.strip())
    # Shares are shrunk as if the text had a few more letters without the trait, so that short texts aren't extreme.
    share = lambda part, whole, floor=1e-3: np.log(part / (whole + 40.0) + floor)
    return np.array(
        [
            np.log(n),
            np.log(letters / n_words),
            share(upper, letters, 1e-2),
            share(digit, n, 5e-2),
            share(mark, n),
            share(shout, n),
            share(stop, n, 3e-3),
            share(space, n, 1e-2),
            np.log((len(set(words)) + 1) / n_words) / np.log(n_words + 2),
            np.log(n_words / (sentences + 1)),
        ]
    )


class QuadraticDiscriminant:
    """score(statistics): the probability of label 1 under the two class densities."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        pos, neg = int((y == 1).sum()), int((y == 0).sum())
        self.prior = float(np.log((pos + 1) / (neg + 1)))
        self.classes: list[tuple[np.ndarray, np.ndarray, float]] = []
        if not pos or not neg:
            return
        self.center, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.center) / self.scale
        means = [z[y == c].mean(0) for c in (0, 1)]
        scatter = [(z[y == c] - means[c]).T @ (z[y == c] - means[c]) for c in (0, 1)]
        pooled = (scatter[0] + scatter[1]) / len(y)
        for c, n in ((0, neg), (1, pos)):
            own = (scatter[c] + pooled) / (n + 1)
            cov = (1 - TO_POOLED) * own + TO_POOLED * pooled
            cov = (1 - TO_SPHERE) * cov + TO_SPHERE * np.trace(cov) / len(cov) * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            self.classes.append((means[c], np.linalg.inv(factor), float(2 * np.log(np.diag(factor)).sum())))

    def scores(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.prior)
        if self.classes and len(x):
            z = (x - self.center) / self.scale
            density = [-0.5 * (((z - mean) @ inverse.T) ** 2).sum(1) - 0.5 * log_det for mean, inverse, log_det in self.classes]
            logit = logit + density[1] - density[0]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, k: int = FOLDS, held: int = HELD, most: int = TRAIN_ROWS) -> QuadraticDiscriminant:
    """The discriminant learned from the labelled rows outside fold ``held`` of ``k``, ``most`` of them at most. The
    driver gets their statistics, never a text."""
    rows = training_rows(docs, labels, "quality", k, held, most, statistics)
    x = np.array([np.frombuffer(x) for x, _ in rows]).reshape(len(rows), len(statistics(None)))
    return QuadraticDiscriminant(x, np.array([y for _, y in rows], int))


def score_quality(df: DataFrame, model: QuadraticDiscriminant, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``df`` with the score of each whole text."""
    small_batches(df.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t.as_py()) for t in texts]).reshape(len(texts), len(statistics(None)))
        return pa.array(model.scores(x), pa.float64())

    return df.withColumn(out, score(F.col(text)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every whole text of documents."""
    docs = read(spark, sf_dir, "documents")
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text"), model, out="score")
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod_col(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
