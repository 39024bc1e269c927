"""A corpus pipeline over ``documents``: quality, exact and near copies, benchmark passages, token ids.

All stages take null and empty texts as empty, keep rows without doc_id, keep all columns (also ones that are not the
table's) but for the last stage, and give an empty table for an empty one. Rows that repeat a doc_id go or stay together,
except that of equal texts with one doc_id all stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.byte_bpe import decode, digest, encode, token_bytes
from millrace.llm.common import cut, read
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.exact_dedup import drop_exact_copies
from millrace.llm.minhash import drop_near_copies
from millrace.llm.quality import drop_low_quality


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return drop_low_quality(docs, read(spark, sf_dir, "labels"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts the one with the smallest doc_id."""
    return drop_near_copies(docs, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers of token ids, and digests of ids and decoded bytes, of each document that is left."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # written between, so that the workers that encode and those that decode don't stand side by side
    encoded = cut(encode(docs, ranks, public_tokenizers.PATTERN), "token-ids")
    return digest(decode(encoded, token_bytes(spark, ranks)))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_exact_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", token_digests),
]
#: Most stages can't be put in SQL. The tests hold the copies' stages, the overlaps and the ids against plain Python on
#: each stage's own input, the quality stage against held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each reads again what the one before has written to shared storage."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
