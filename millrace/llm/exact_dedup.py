"""Exact dedup by progressive refinement: length, then prefix hash, then full hash. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bitmap, cut, join_split, lower_ascii, with_hit, without_ids

PREFIX_CHARS = 64


def exact_dedup(docs: DataFrame, digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the largest doc_id
    stays. A first scan leaves length and prefix hash of each row. Lengths that occur once are settled, then pairs of
    length and prefix hash that occur once. The second scan hashes the full text of the surviving groups only: which
    rows these are is told by a bitmap of their keys, so neither scan moves a text. A false hit costs one hash; beyond 33
    million groups, where there is no bitmap, every text is hashed.

    ``text_sha256`` is null where a text was settled before its full hash; ``digest_all`` fills it for every row.
    Rows that repeat a doc_id share its verdict and count in group_size. A row without doc_id stays only if its group
    has no doc_id at all. An empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    prefix = F.xxhash64(lower_ascii(F.substring(text, 1, PREFIX_CHARS)))
    keys = [F.octet_length(text), prefix]
    narrow = cut(docs.select(keys[0].alias("n_bytes"), keys[1].alias("prefix")), "prefixes")
    shared = narrow.groupBy("n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("n_bytes")
    groups = join_split(narrow, shared, ["n_bytes"], "left_semi").groupBy("n_bytes", "prefix").agg(F.count("*").alias("n"))
    survivors = bitmap(cut(groups.where("n > 1").select("n_bytes", "prefix"), "groups"), "n_bytes", "prefix")

    marked = with_hit(docs.select("doc_id", text.alias("text")), survivors, *keys)
    digest = F.sha2(lower_ascii("text").cast("binary"), 256)
    hashed = cut(
        marked.select(
            "doc_id",
            "_hit",
            (digest if digest_all else F.when(F.col("_hit"), digest)).alias("text_sha256"),
        ),
        "digests",
    )
    copies = hashed.where("_hit").groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    found = join_split(hashed, copies.where("n > 1"), ["text_sha256"], "left")
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that an equal text with a larger doc_id replaces. All columns stay."""
    return without_ids(docs, cut(exact_dedup(docs).where("not kept and doc_id is not null").select("doc_id"), "copies"))
