"""Toxicity: a factorization machine over hashed terms, so that pairs of terms count beyond their sums.

Terms are the lower-case words of a text and the beginnings of longer words, hashed to slots. All slots that are in
enough training texts are fitted, whatever they tell alone, those that speak for clean texts included; the machine learns
a weight and a short vector for each, and the products of the vectors of the terms that meet in a text are its pairwise
interactions. What a term learns is shrunk towards nothing at each step, so that many terms can be fitted on few texts.

Defined results: null and empty texts get the score of a text without known terms; repeated rows get equal scores; a
null id is in no fold, so that it is not held out; with no training rows, or rows of one class only, every score is the
smoothed share of toxic rows; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import crc_mod_col, read, small_batches, training_rows

SLOTS = 1 << 20
BEGINNINGS = (4, 5)
#: At most so many labelled rows are fitted on.
TRAIN_ROWS = 6000
#: A fitted slot is in so many training texts at least, and in this share of them.
LEAST_TEXTS, LEAST_SHARE = 3, 0.0025
#: Log-odds from which, also in standard errors, the weight of a slot starts from them.
LEAST_Z, LEAST_ODDS = 2.3, 3.2
RANK, STEPS, RATE, L2 = 6, 300, 0.05, 1e-4
#: The spread of the vectors at the start, what damps the steps of terms with small gradients, and how a step shrinks a term.
SPREAD, DAMP, SHRINK = 0.05, 1e-3, 0.05
#: How much more a toxic training text counts than another.
TOXIC_WEIGHT = 3.0
THRESHOLD = 0.7
#: Words whose slots a worker remembers at once.
REMEMBERED = 150_000
FOLDS, HELD = 3, 1

WORD = re.compile(r"\w+")


def term_slots(word: str) -> tuple[int, ...]:
    """The slots of a word and of its beginnings."""
    terms = [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) > n + 1)]
    return tuple(zlib.crc32(t.encode()) % SLOTS for t in terms)


def text_slots(text: str | None, memo: dict[str, tuple[int, ...]] | None = None) -> np.ndarray:
    """The different slots of the terms of a whole text, sorted. memo: the slots of words seen before."""
    memo = {} if memo is None else memo
    own: set[int] = set()
    for word in set(WORD.findall((text or "").lower())):
        if word not in memo:
            memo[word] = term_slots(word)
        own.update(memo[word])
    return np.sort(np.fromiter(own, np.int32, len(own)))


class Terms(dict):
    """The kept slots (renumbered) of each word, remembered up to a bound."""

    def __init__(self, at: dict[int, int]):
        self.at = at

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = tuple(self.at[s] for s in term_slots(word) if s in self.at)
        return found

    def of(self, text: str | None) -> set[int]:
        return set().union(*map(self.__getitem__, set(WORD.findall((text or "").lower()))))


class Incidence:
    """Which terms each text has, for sums over the terms of a text and over the texts of a term. Values come as rows of
    numbers by term or by text; each row is summed by itself, as its numbers lie side by side."""

    def __init__(self, texts: list[np.ndarray], terms: int):
        text, term = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.concatenate(texts)
        order = np.argsort(term, kind="stable")
        self.of_text, self.of_term = self._runs(text, term, len(texts)), self._runs(term[order], text[order], terms)

    @staticmethod
    def _runs(key: np.ndarray, other: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        return other.astype(np.int32), first, key[first], n

    def by_text(self, values: np.ndarray) -> np.ndarray:
        return self._sums(values, *self.of_text)

    def by_term(self, values: np.ndarray) -> np.ndarray:
        return self._sums(values, *self.of_term)

    @staticmethod
    def _sums(values: np.ndarray, other: np.ndarray, first: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((len(values), n), values.dtype)
        if len(first):
            for row, sums in zip(values, out, strict=True):
                sums[key] = np.add.reduceat(row[other], first)
        return out


class FactorizationMachine:
    """score(terms): the probability of the label; fitted in full batches with Adam from a fixed start on rows of the
    slots of a text, as ``text_slots`` gives them, and its label."""

    def __init__(self, rows: list[tuple[np.ndarray, int]], seed: int = 5):
        y = np.array([r[1] for r in rows], np.float32)
        pos, neg = float(y.sum()), float(len(y) - y.sum())
        self.bias = np.float32(np.log((pos + 1) / (neg + 1)))
        self.w, self.v, self.slots = np.zeros(0, np.float32), np.zeros((0, RANK), np.float32), {}
        if pos and neg:
            self._fit(rows, seed)

    def _fit(self, rows: list[tuple[np.ndarray, int]], seed: int) -> None:
        seen = np.zeros((2, SLOTS), np.int32)
        texts, labels, met = [], [], set()
        mixers = np.random.default_rng(seed).integers(1, 1 << 32, (12, 1), np.uint64) | np.uint64(1)
        for slots, label in rows:
            ids = slots.astype(np.int64)
            if len(ids):
                # Near copies would lend their rare words the support of many texts: the first of each group is fitted on.
                least = ((ids.astype(np.uint64) * mixers) & np.uint64(0xFFFFFFFF)).min(1).reshape(4, 3)
                bands = {(i, *b) for i, b in enumerate(least.tolist())}
                if bands & met:
                    continue
                met |= bands
            seen[label, ids] += 1
            texts.append(ids)
            labels.append(label)
        y = np.array(labels, np.float32)
        pos, neg = float(y.sum()), float(len(y) - y.sum())
        n, p = seen[0] + 0.5, seen[1] + 0.5
        z = np.log(p / (pos + 1)) - np.log(n / (neg + 1))
        odds = z.astype(np.float32)
        z /= np.sqrt(1 / p + 1 / n)
        often = seen.sum(0) >= max(LEAST_TEXTS, LEAST_SHARE * len(texts))
        kept = np.flatnonzero(often)
        if not len(kept):
            return
        number = np.full(SLOTS, -1, np.int32)
        number[kept] = np.arange(len(kept))
        # Texts with the same terms and label count together.
        times: dict[tuple[bytes, int], int] = {}
        for ids, label in zip(texts, labels, strict=True):
            at = np.sort(number[ids])
            key = at[at >= 0].tobytes(), label
            times[key] = times.get(key, 0) + 1
        y = np.array([label for _, label in times], np.float32)
        weight = (np.array(list(times.values())) * np.where(y == 1, TOXIC_WEIGHT, 1.0)).astype(np.float32)
        weight /= weight.sum()
        x = Incidence([np.frombuffer(k, np.int32) for k, _ in times], len(kept))
        rng = np.random.default_rng(seed)
        # The weights of terms that clearly speak for toxic texts start from their log-odds, and all are held near their start.
        start = np.where((z >= LEAST_Z) & (odds >= LEAST_ODDS), odds, 0)[kept].astype(np.float32)
        params = [np.array([self.bias]), start.copy(), np.ascontiguousarray((rng.normal(size=(len(kept), RANK)) * SPREAD).astype(np.float32).T)]
        m, s = [np.zeros_like(q) for q in params], [np.zeros_like(q) for q in params]
        for step in range(1, STEPS + 1):
            b, w, v = params
            sums = x.by_text(np.vstack([v, w, (v**2).sum(0)]))
            xv = sums[:RANK]
            logit = b + sums[RANK] + 0.5 * ((xv**2).sum(0) - sums[RANK + 1])
            g = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight).astype(np.float32)
            back = x.by_term(np.vstack([xv * g, g]))
            xg = back[RANK]
            grads = [np.array([g.sum()]), xg + L2 * (w - start), back[:RANK] - v * xg + L2 * v]
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                s[i] = 0.999 * s[i] + 0.001 * d * d
                params[i] = params[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + DAMP)
            moved, long = params[1] - start, np.sqrt((params[2] ** 2).sum(0)) + 1e-12
            params[1] = start + np.sign(moved) * np.maximum(np.abs(moved) - RATE * SHRINK, 0)
            params[2] = params[2] * np.maximum(0, 1 - RATE * SHRINK / long)
        params[2] = np.ascontiguousarray(params[2].T)
        # Terms without a weight and a vector add nothing to any score.
        used = (params[1] != 0) | (params[2] != 0).any(1)
        self.slots, params[1:] = {int(s): i for i, s in enumerate(kept[used])}, [q[used] for q in params[1:]]
        self.bias, self.w, self.v = np.float32(params[0][0]), params[1].astype(np.float32), params[2].astype(np.float32)

    def logit(self, ids: list[int]) -> float:
        v = self.v[ids]
        return float(self.bias + self.w[ids].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()))

    def score(self, ids: set[int]) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.logit(sorted(ids)), -30, 30))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, k: int = FOLDS, held: int = HELD, most: int = TRAIN_ROWS) -> FactorizationMachine:
    """The machine learned from the labelled rows outside fold ``held`` of ``k``, ``most`` of them at most. The driver
    gets the slots of their terms, at most ``SLOTS`` numbers for a text of any length, never a text."""
    rows = training_rows(docs, labels, "toxic", k, held, most, text_slots)
    return FactorizationMachine([(np.frombuffer(x, np.int32), y) for x, y in rows])


def score_toxicity(df: DataFrame, machine: FactorizationMachine, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with the score of each whole text."""
    small_batches(df.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        terms = _terms(machine)
        return pa.array([machine.score(terms.of(t.as_py())) for t in texts], pa.float64())

    return df.withColumn(out, score(F.col(text)))


def _terms(machine: FactorizationMachine) -> Terms:
    if not hasattr(machine, "terms"):
        machine.terms = Terms(machine.slots)
    return machine.terms


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text of documents."""
    docs = read(spark, sf_dir, "documents")
    machine = fit_toxicity(docs, read(spark, sf_dir, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), machine, out="score")
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod_col(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
