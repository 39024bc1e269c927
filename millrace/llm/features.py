"""What the two text classifiers share: the fold rule, a bounded training sample, the accuracy of a score."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bitmap, cut, with_hit

#: Labels of rows with this remainder are never learnt from.
FOLDS = 5


def held_out(doc_id: Column | str) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null doc_id is held out as well."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> pd.DataFrame:
    """At most ``rows`` labelled training texts (doc_id, text, y), the same on every run.

    The rows are those with the smallest hash of their doc_id, so the bound holds at any input size and the sample is
    even over the table. A doc_id with several labels counts as 1 if any label is 1; null labels are ignored. Text is
    bounded by the caller's machine only through the sample's row count.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marked = marked.groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = cut(marked.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(rows), "labelled")
    near = with_hit(docs.select("doc_id", "text"), bitmap(chosen, "doc_id"), F.col("doc_id")).where("_hit")
    texts = near.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `rows` narrow rows
    found = texts.groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).toPandas()
    return found.sort_values("doc_id").reset_index(drop=True)


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def auc(score: np.ndarray, y: np.ndarray) -> float:
    """Chance that a row of label 1 has a higher score than one of label 0."""
    rank = pd.Series(score).rank().to_numpy()
    ones = int(y.sum())
    return float((rank[y == 1].sum() - ones * (ones + 1) / 2) / max(1, ones * (len(y) - ones)))


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits the labels best (Newton steps on smoothed targets)."""
    ones, zeros = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, w = p - target, p * (1 - p) + 1e-9
        hessian = np.array([[np.sum(w * margin * margin) + 1e-6, np.sum(w * margin)], [np.sum(w * margin), np.sum(w) + 1e-6]])
        move = np.linalg.solve(hessian, [np.sum(g * margin), np.sum(g)])
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(a), float(b)
