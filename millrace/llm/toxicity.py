"""Toxicity: a factorization machine over hashed terms (Rendle, 2010).

Besides a weight, each term has a short vector; the product of two terms' vectors is the weight of their meeting in a
text, such as an insult with a group mention, which additive weights cannot tell from either alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import HASH_TABLE_SIZE
from millrace.llm.features import calibrate, held_out, training_sample

#: Bound of the labelled rows that the model is fitted on.
SAMPLE_ROWS = 8_000
#: Hashed terms; two terms that share a number share their weights.
BUCKETS = 1 << 18
FACTORS = 4
#: A hashed term needs so many training texts to get weights, and either a class frequency so many standard errors from
#: the other's or a place among the most frequent terms, which may matter by their meetings alone.
MIN_TEXTS = 6
MIN_Z = 3.5
FREQUENT = 1_000
#: A word also counts by its beginnings of these lengths, as insults are inflected and compounded.
STEMS = (4, 5)
WORD = re.compile(r"[^\W\d_]+")


class TermNumbers(dict):
    """Hashed terms of a word: the word itself and its beginnings. Emptied at a bound."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > HASH_TABLE_SIZE:
            self.clear()
        parts = [f"={word}", *(f"{word[:n]}~" for n in STEMS if len(word) >= n)]
        value = self[word] = tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts)
        return value


def terms(text: str | None, numbers: TermNumbers) -> np.ndarray:
    """Distinct hashed terms of a whole text, ascending."""
    words = set(WORD.findall((text or "").lower()))
    return np.unique(np.fromiter((n for w in words for n in numbers[w]), np.int64, -1))


@dataclass(frozen=True)
class FactorizationMachine:
    known: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, active: np.ndarray) -> float:
        if not len(active) or not len(self.known):
            return self.bias
        at = np.minimum(np.searchsorted(self.known, active), len(self.known) - 1)
        at = at[self.known[at] == active]
        v = self.factor[at]
        meeting = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return self.bias + float(self.weight[at].sum()) + meeting

    def scores(self, texts: pd.Series, numbers: TermNumbers) -> pd.Series:
        z = np.array([self.margin(terms(t, numbers)) for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30))))


def fit(sample: pd.DataFrame, epochs: int = 12, rate: float = 0.1, l2: float = 2e-4, batch: int = 64) -> FactorizationMachine:
    """The machine of a sample (text, y), by mini-batch AdaGrad on the logistic loss; the same on every run.

    With one class only, or without rows, every text scores that class's share.
    """
    y = sample["y"].to_numpy(float)
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return FactorizationMachine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), float(np.log(share / (1 - share))))
    numbers = TermNumbers()
    sets = [terms(t, numbers) for t in sample["text"]]
    found, texts = np.unique(np.concatenate(sets), return_counts=True)
    toxic = np.zeros(len(found))
    for s, label in zip(sets, y, strict=True):
        toxic[np.searchsorted(found, s)] += label
    with np.errstate(all="ignore"):
        odds = np.log((toxic + 0.5) / (y.sum() - toxic + 0.5)) - np.log((texts - toxic + 0.5) / (len(y) - y.sum() - texts + toxic + 0.5))
        error = np.sqrt(1 / (toxic + 0.5) + 1 / (texts - toxic + 0.5))
    frequent = np.zeros(len(found), bool)
    frequent[np.argsort(-texts, kind="stable")[:FREQUENT]] = True
    known = found[(texts >= MIN_TEXTS) & (frequent | (np.abs(odds) >= MIN_Z * error))]
    rows = [np.searchsorted(known, s[np.isin(s, known, assume_unique=True)]) for s in sets]
    random = np.random.default_rng(5)
    w, v, bias = np.zeros(len(known)), random.normal(0, 0.01, (len(known), FACTORS)), float(np.log(y.mean() / (1 - y.mean())))
    seen_w, seen_v, seen_b = np.full(len(known), 1e-6), np.full((len(known), FACTORS), 1e-2), 1e-2
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            lengths = np.array([len(rows[i]) for i in part])
            flat = np.concatenate([rows[i] for i in part])
            owner = np.repeat(np.arange(len(part)), lengths)
            sums = np.zeros((len(part), FACTORS))
            np.add.at(sums, owner, v[flat])
            squares = np.bincount(owner, (v[flat] ** 2).sum(axis=1), len(part))
            z = bias + np.bincount(owner, w[flat], len(part)) + 0.5 * ((sums**2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * share[part]
            used, where = np.unique(flat, return_inverse=True)
            grad_w = np.bincount(where, error[owner], len(used)) + l2 * len(part) * w[used]
            pull = error[owner, None] * (sums[owner] - v[flat])
            grad_v = np.stack([np.bincount(where, pull[:, k], len(used)) for k in range(FACTORS)], axis=1) + l2 * len(part) * v[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            seen_b += error.sum() ** 2
            w[used] -= rate * grad_w / np.sqrt(seen_w[used])
            v[used] -= 0.1 * rate * grad_v / np.sqrt(seen_v[used])
            bias -= rate * error.sum() / np.sqrt(seen_b)
    plain = FactorizationMachine(known, w, v, bias)
    slope, offset = calibrate(np.array([plain.margin(s) for s in sets]), y)
    return FactorizationMachine(known, w, v, bias, slope, offset)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, toxic).

    At most ``sample_rows`` labelled rows outside the held-out fold are learnt from. Null and empty texts are scored by
    the bias alone; without labels every score is 0.5. Repeated rows get a row each, an empty table an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, "toxic", sample_rows)))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        numbers = TermNumbers()
        for texts in batches:
            yield model.value.scores(texts, numbers)

    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
