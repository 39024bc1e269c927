"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

N-gram indicators are scaled by the log ratio of their class frequencies, then a linear hinge-loss model is fitted to
them by dual coordinate descent (Hsieh et al., 2008). Fitting sees a bounded sample; scoring sees every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import give_back, small_batches
from millrace.llm.features import calibrate, held_out, training_sample

#: Bound of the labelled rows that the model is fitted on.
SAMPLE_ROWS = 5_000
#: An n-gram needs so many training texts to get a weight.
MIN_TEXTS = 5
#: Bound of the n-grams that get a weight: those in most texts, ties by their own order.
MAX_NGRAMS = 200_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
UNKNOWN = 0
#: Numbers below stand for one token, numbers above for two.
PAIR = 1 << 31


def tokens(text: str | None) -> list[str]:
    """Words and runs of signs, in their own case."""
    return TOKEN.findall(text or "")


def runs(numbers: np.ndarray) -> list[str]:
    """N-grams that stand for any token in a row with itself, three and four times. No token looks like them."""
    same = numbers[1:] == numbers[:-1]
    three = same[1:] & same[:-1]
    four = three[1:] & three[:-1]
    return ["#RUN3"] * bool(three.any()) + ["#RUN4"] * bool(four.any())


def numbered(text: str | None) -> tuple[dict[str, int], np.ndarray]:
    """The distinct tokens of a text in order of appearance, and the text as their numbers."""
    local: dict[str, int] = {}
    found = tokens(text)
    return local, np.fromiter((local.setdefault(t, len(local)) for t in found), np.int64, len(found))


@dataclass(frozen=True)
class NbSvm:
    """Weights by n-gram: ``codes`` numbers the known tokens from 1, ``pairs`` are two codes in one number, sorted."""

    codes: dict[str, int]
    single: np.ndarray
    pairs: np.ndarray
    pair_weight: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, text: str | None) -> float:
        known, (local, at) = self.codes.get, numbered(text)
        code = np.array([known(t, UNKNOWN) for t in local], np.int64)
        total = self.single[code].sum() + sum(self.single[known(r, UNKNOWN)] for r in runs(at))
        found = code[at]
        both = np.unique(found[:-1] * len(self.single) + found[1:])
        if len(self.pairs) and len(both):
            place = np.minimum(np.searchsorted(self.pairs, both), len(self.pairs) - 1)
            total += self.pair_weight[place[self.pairs[place] == both]].sum()
        return float(total + self.bias)

    def scores(self, texts: pd.Series) -> pd.Series:
        z = np.array([self.margin(t) for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30))))


def _ngrams(text: str, numbers: dict[str, int]) -> np.ndarray:
    """Distinct n-grams of a text as numbers: a token's own, or two tokens' above ``PAIR``."""
    local, at = numbered(text)
    for word in [*local, *(found := runs(at))]:
        numbers.setdefault(word, len(numbers) + 1)
    code = np.array([numbers[t] for t in local], np.int64)
    single = np.array([numbers[t] for t in [*local, *found]], np.int64)
    return np.concatenate([np.sort(single), np.unique(code[at[:-1]] * PAIR + code[at[1:]])])


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int) -> np.ndarray:
    """Weights of the squared-hinge linear model; ``rows`` hold the active features, ``values`` their scale.

    One dual variable per text, updated in a fixed random order; the last feature is the bias.
    """
    w, alpha = np.zeros(len(values)), np.zeros(len(rows))
    diagonal = 0.5 / cost
    norm = np.array([np.sum(values[r] ** 2) for r in rows]) + diagonal
    order = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[rows[i]]
            gradient = y[i] * (w[r] @ v) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / norm[i])
            if new != alpha[i]:
                w[r] += (new - alpha[i]) * y[i] * v
                largest = max(largest, abs(new - alpha[i]))
                alpha[i] = new
        if largest < 1e-4:
            break
    return w * values


def fit(sample: pd.DataFrame, cost: float = 1.0, epochs: int = 40) -> NbSvm:
    """The model of a sample (text, y). With one class only, or without rows, every text scores that class's share."""
    y = sample["y"].to_numpy(int)
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return NbSvm({}, np.zeros(1), np.zeros(0, np.int64), np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    numbers: dict[str, int] = {}
    sets = [_ngrams(t, numbers) for t in sample["text"]]
    found, texts = np.unique(np.concatenate(sets), return_counts=True)
    often = np.flatnonzero(texts >= MIN_TEXTS)
    kept = np.sort(found[often[np.argsort(-texts[often], kind="stable")][:MAX_NGRAMS]])
    rows = [np.append(np.searchsorted(kept, s[np.isin(s, kept, assume_unique=True)]), len(kept)) for s in sets]
    count = np.ones((2, len(kept) + 1))
    for r, label in zip(rows, y, strict=True):
        count[label, r] += 1
    rate = count / (np.bincount(y, minlength=2)[:, None] + 2)
    ratio = np.log(rate[1] / rate[0])
    ratio[-1] = 1.0
    weight = np.where(y == 1, cost, cost * max(1.0, y.mean() / (1 - y.mean())) ** 0.5)
    w = dual_coordinate_descent(rows, ratio / np.sqrt(len(kept) + 1) * 4, np.where(y == 1, 1.0, -1.0), weight, epochs)
    bias, w = float(w[-1]), w[:-1]
    lone = kept < PAIR
    names = np.array([*numbers], object)
    used = np.unique(np.concatenate([kept[lone], kept[~lone] // PAIR, kept[~lone] % PAIR]))
    codes = {str(t): k + 1 for k, t in enumerate(names[used - 1])}
    single = np.zeros(len(used) + 1)
    single[np.searchsorted(used, kept[lone]) + 1] = w[lone]
    pairs = (np.searchsorted(used, kept[~lone] // PAIR) + 1) * len(single) + np.searchsorted(used, kept[~lone] % PAIR) + 1
    model = NbSvm(codes, single, pairs, w[~lone], bias, 1.0, 0.0)
    slope, offset = calibrate(np.array([model.margin(t) for t in sample["text"]]), y)
    return NbSvm(codes, single, pairs, w[~lone], bias, slope, offset)


def score_column(model: NbSvm):
    """A Pandas UDF text -> score; the model travels as one broadcast of bounded size."""
    shared = None

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield shared.value.scores(texts)
        give_back()

    def column(df: DataFrame):
        nonlocal shared
        shared = df.sparkSession.sparkContext.broadcast(model)
        return score("text")

    return column


def learnt(docs: DataFrame, labels: DataFrame, sample_rows: int) -> NbSvm:
    """The model of the training sample. The driver gives the sample's memory back at once, before the texts are scored."""
    model = fit(training_sample(docs, labels, "quality", sample_rows))
    give_back()
    return model


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, quality).

    At most ``sample_rows`` labelled rows outside the held-out fold are learnt from. Null and empty texts are scored by
    the bias alone; without labels every score is 0.5. Repeated rows get a row each, an empty table an empty result.
    """
    small_batches(docs.sparkSession)
    model = learnt(docs, labels, sample_rows)
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), score_column(model)(docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that the classifier rejects. All columns stay."""
    small_batches(docs.sparkSession)
    model = learnt(docs, labels, sample_rows)
    return docs.where(score_column(model)(docs) >= threshold)

