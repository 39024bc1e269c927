"""MinHash near-dedup: many universal hash minima, banding, signature verification, exact confirmation, components.

One pass over the texts makes a signature for each document. Documents with equal shingle sets form a class and only
its smallest doc_id goes on, so a group of copies costs one row. Classes that share a band meet in that band's bucket.
A bucket never emits all its pairs: the member that shares most buckets becomes its centre, and every member is compared
with the centre alone. Members that then still lie in different components mostly share one common passage. They meet
once more by the rarest 15 % of their shingles, of which a linked pair has one in common, and are compared across
components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import (
    WordHashes, ascii_words, cut, each_batch, join_split, mix, small_batches, texts_of, window_hashes, without_ids,
)
from millrace.llm.components import connected_components

SHINGLE_WORDS = 5
#: A pair of similarity 0.85 shares no band of 32 with a chance of (1 - 0.85^6)^32 = 3e-7.
BANDS, BAND_ROWS = 32, 6
#: A pair is ruled out by its signatures only if they agree this far below the threshold: 5 standard deviations of
#: the estimate from 192 minima.
SIGNATURE_MARGIN = 0.13
#: Rows of a block of shingles that is hashed at once.
BLOCK = 2048
#: Rounds in which buckets that are still split get a new centre, before the rest is compared across components.
CENTRE_ROUNDS = 2

_seeds = np.random.default_rng(20_011).integers(0, 2**32, (2, BANDS * BAND_ROWS), np.uint64)
_A, _B = (_seeds[0] | np.uint64(1)).astype(np.uint32), _seeds[1].astype(np.uint32)
_BAND_SEEDS = np.random.default_rng(20_012).integers(0, 2**63, (BAND_ROWS, BANDS), np.uint64)


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    return np.unique(window_hashes(hashes.of(ascii_words(text)), SHINGLE_WORDS))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function ``a * x + b mod 2^32`` over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_A), 2**32 - 1, np.uint32)
    for at in range(0, len(x), BLOCK):
        np.minimum(least, (x[at : at + BLOCK, None] * _A + _B).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.astype(np.uint64).reshape(BANDS, BAND_ROWS).T
    return mix((rows * (_BAND_SEEDS | np.uint64(1))).sum(axis=0) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()

    def one(text: str | None) -> tuple:
        shingles = shingle_set(text, hashes)
        if not len(shingles):
            return 0, 0, 0, None, None
        least = minima(shingles)
        twins = np.array([shingles.sum(), mix(shingles).sum()], np.uint64).view(np.int64)
        return len(shingles), int(twins[0]), int(twins[1]), (least & np.uint32(255)).astype(np.uint8).tobytes(), band_keys(least)

    def batch(docs: pd.DataFrame) -> pd.DataFrame:
        rows = [one(text) for text in docs["text"]]
        out = pd.DataFrame(rows, columns=["n_shingles", "set_a", "set_b", "signature", "bands"])
        out.insert(0, "doc_id", docs["doc_id"].array)
        return out

    return each_batch(batches, batch)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    return each_batch(batches, lambda docs: pd.DataFrame({
        "doc_id": docs["doc_id"].array,
        "shingles": [shingle_set(text, hashes).view(np.int64) for text in docs["text"]],
    }))


def _agreement(floor: float):
    """Pairs whose signatures agree in ``floor`` of all minima or more."""

    def batch(pairs: pd.DataFrame) -> pd.DataFrame:
        a, b = (np.frombuffer(b"".join(pairs[c]), np.uint8).reshape(len(pairs), -1) for c in ("sig_a", "sig_b"))
        return pairs.loc[(a == b).mean(axis=1) >= floor, ["a", "b"]]

    return lambda batches: each_batch(batches, batch)


def _confirmed(docs: DataFrame, signed: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that reach ``percent`` on their full shingle sets, after signatures have ruled out most others."""
    sig = signed.select("doc_id", "signature", "n_shingles")
    side = lambda c: sig.select(F.col("doc_id").alias(c), F.col("signature").alias(f"sig_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    # a bucket's centre is in many pairs
    sized = join_split(join_split(pairs, side("a"), ["a"]), side("b"), ["b"]).where(
        f"100L * least(n_a, n_b) >= {percent}L * greatest(n_a, n_b)"
    )
    likely = cut(
        sized.select("a", "b", "sig_a", "sig_b").mapInPandas(_agreement(percent / 100 - SIGNATURE_MARGIN), "a long, b long"),
        "likely-pairs",
    )
    ids = likely.select(F.explode(F.array("a", "b")).alias("doc_id"))
    sets = cut(texts_of(docs, ids).mapInPandas(_sets, "doc_id long, shingles array<long>"), "shingle-sets")
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = join_split(join_split(likely, side("b"), ["b"]), side("a"), ["a"])
    shared, total = F.size(F.array_intersect("set_a", "set_b")), F.size("set_a") + F.size("set_b")
    linked = both.where(100 * shared.cast("long") >= percent * (total - shared).cast("long"))
    return cut(linked.select("a", "b").distinct(), "confirmed-pairs")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _centre_pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of each bucket's centre with its members, and the rows (key, id) without the centres."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"))
    weight = join_split(rows, sizes, ["key"]).groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = join_split(rows, weight, ["id"])
    centres = weighed.groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("centre"))
    met = cut(join_split(rows, centres, ["key"]).where("id <> centre"), "bucket-rows")
    return met.select(*_ordered(F.col("id"), F.col("centre"))).distinct(), met


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components (id, component) with ``links`` (a, b) added to those found before."""
    before = [] if found is None else [found.select(F.col("id").alias("a"), F.col("component").alias("b"))]
    return connected_components(reduce(DataFrame.unionByName, before, links))


def _split_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (key, id, component) of the buckets whose members lie in several components."""
    placed = join_split(rows, found, ["id"], "left").withColumn("component", F.coalesce("component", "id"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return cut(join_split(placed, split.select("key"), ["key"], "left_semi"), "split-buckets")


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components of a bucket: members outside its largest component against all.

    Only pairs whose sizes, and whose places of the common shingle, leave room for enough common shingles. Of a linked
    pair at least the first common shingle does.
    """
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("size", -F.col("component"))).alias("main"))
    placed = join_split(rows, main, ["key"])
    few = placed.where("component <> main").select("key", *(F.col(c).alias(f"x_{c}") for c in ("id", "component", "n", "rank")))
    met = few.join(placed, "key").where("x_component <> component and (component = main or x_id < id)").where(
        f"100L * least(x_n, n) >= {percent}L * greatest(x_n, n)"
        f" and {100 + percent}L * (1 + least(x_n - x_rank, n - rank)) >= {percent}L * (x_n + n)"
    )
    return met.select(*_ordered(F.col("x_id"), F.col("id"))).distinct()


def _rare_rows(docs: DataFrame, split: DataFrame, percent: int) -> DataFrame:
    """Rows (key, id, component, n, rank) for the rarest shingles of the documents of ``split``.

    A linked pair has ``percent`` of each set in common, so it shares one of the first ``n - ceil(percent * n) + 1``
    shingles of both in any common order. In order of frequency these are seldom those of a passage that many share.
    """
    ids = split.select(F.col("id").alias("doc_id"), "component").distinct()
    sets = texts_of(docs, ids).mapInPandas(_sets, "doc_id long, shingles array<long>").join(ids, "doc_id")
    items = cut(
        sets.select(F.col("doc_id").alias("id"), "component", F.size("shingles").alias("n"), F.explode("shingles").alias("key")),
        "shingles",
    )
    counts = items.groupBy("key").agg(F.count("*").alias("n_docs"))
    by_rarity = Window.partitionBy("id").orderBy("n_docs", "key")
    ranked = join_split(items, counts, ["key"]).withColumn("rank", F.row_number().over(by_rarity))
    rare = ranked.where(f"rank <= n - ({percent} * n + 99) div 100 + 1 and n_docs > 1")
    return cut(rare.select("key", "id", "component", "n", "rank"), "rare-shingles")


def link_near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    The set of a text holds its distinct runs of five words (A-Z lower-cased, split at ASCII white space), or its whole
    word sequence as one if it is shorter. Documents are linked where ``100 * intersection >= percent * union``; a
    component is named by its smallest doc_id, which is the one that is kept. A text without words is linked with
    nothing and kept, and so is a row without doc_id. Rows that repeat a doc_id share its component. An empty table
    gives an empty result; other columns are ignored. Candidates come from ``BANDS`` bands, so a link at the threshold
    is missed with a chance of 3e-7.
    """
    small_batches(docs.sparkSession)
    signed = cut(
        docs.select("doc_id", "text").mapInPandas(
            _signatures,
            "doc_id long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>",
        ),
        "signatures",
    )
    same = ["n_shingles", "set_a", "set_b"]
    real = signed.where("n_shingles > 0 and doc_id is not null")
    classes = cut(real.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = real.join(classes.select(F.col("rep").alias("doc_id"), *same), ["doc_id", *same], "left_semi").dropDuplicates(["doc_id", *same])

    exploded = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    rows = cut(join_split(exploded, shared, ["key"], "left_semi").distinct(), "shared-buckets")
    found = None
    for _ in range(CENTRE_ROUNDS):
        pairs, rest = _centre_pairs(rows)
        found = _joined(found, _confirmed(docs, reps, pairs, percent))
        split = _split_rows(rest.select("key", "id"), found)
        if split.isEmpty():
            break
        rows = split.select("key", "id")
    else:
        found = _joined(found, _confirmed(docs, reps, _across(_rare_rows(docs, split, percent), percent), percent))

    named = join_split(classes, found.withColumnRenamed("id", "rep"), ["rep"], "left")
    named = named.select(*same, F.coalesce("component", "rep").alias("component_id"))
    out = join_split(signed, named, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each component. All columns stay."""
    dropped = link_near_copies(docs, percent).where("not kept and doc_id is not null").select("doc_id")
    return without_ids(docs, cut(dropped, "near-copies"))
