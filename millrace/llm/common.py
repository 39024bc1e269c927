"""What several operators share: shared-storage cuts, bounded bitmaps, dropping rows by key."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A key bitmap has at least so many bits for each distinct key, so that at most one other key in eight is a false hit.
BITS_PER_KEY = 8
#: Least and most bits of a key bitmap: 1 MiB and 32 MiB. It is broadcast, so there is none for more than 33 million keys.
LEAST_BITS, MOST_BITS = 1 << 23, 1 << 28
#: Bits that one row of a bitmap table holds; fixed by Spark's bitmap functions.
ROW_BITS = 32768
#: Rows that go to a Python worker at a time; texts may be long.
BATCH_ROWS = 1_000
#: Bytes of a row group of a table written between steps.
ROW_GROUP = 32 << 20
#: A word hash table is emptied at this size, so that a worker's memory is bounded.
HASH_TABLE_SIZE = 100_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to shared storage and read again: lineage ends, executors may go."""
    path = scratch_dir(df.sparkSession, f"llm-{label}")
    # a writer holds a whole row group
    df.write.options(**{"parquet.block.size": str(ROW_GROUP), **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker and the buffers before and behind it hold of whole texts, for the rest of the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def lower_ascii(text: Column | str) -> Column:
    """A-Z lower-cased, every other character as it is."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.octet_length(text) == F.char_length(text)  # only ASCII: lower() is the fast form of the same
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def join_split(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys AQE can split: a right side that comes from an aggregate gets an exchange of its own."""
    spread = lambda df: df.withColumn("_spread", F.xxhash64(*keys))
    return spread(left).join(spread(right), [*keys, "_spread"], how).drop("_spread")


class KeyBits(NamedTuple):
    """Rows (_row, _bits) of 4 KiB that hold a bit for every key, ``n_bits`` in all."""

    rows: DataFrame
    n_bits: int


def n_bits_for(n_keys: int) -> int:
    """A power of two, from ``LEAST_BITS`` on, with ``BITS_PER_KEY`` bits for each key."""
    return max(LEAST_BITS, 1 << max(n_keys * BITS_PER_KEY - 1, 0).bit_length())


def _bit(n_bits: int, *keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_bits))


def bitmap(keys: DataFrame, *columns: str) -> KeyBits | None:
    """The bitmap of ``keys``, which are read twice: counted (about, without a shuffle of them), then set. None if there
    are more than ``MOST_BITS`` have room for."""
    hashed = keys.select(F.xxhash64(*columns).alias("key"))
    n_bits = n_bits_for(hashed.agg(F.approx_count_distinct("key", 0.02)).first()[0])
    if n_bits > MOST_BITS:
        return None
    bits = keys.select(_bit(n_bits, *(F.col(c) for c in columns)).alias("bit"))
    rows = bits.groupBy(F.bitmap_bucket_number("bit").alias("_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits")
    )
    return KeyBits(rows, n_bits)


def with_hit(df: DataFrame, bits: KeyBits | None, *keys: Column, name: str = "_hit") -> DataFrame:
    """Adds a boolean: false where the key is certainly not among the bitmap's; true throughout without a bitmap. Rows and
    other columns stay."""
    if bits is None:
        return df.withColumn(name, F.lit(True))
    df = df.withColumn("_bit", _bit(bits.n_bits, *keys)).withColumn("_row", F.bitmap_bucket_number("_bit"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_bit) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(bitmap_bit_position(_bit) % 8 as int))")) != 0, F.lit(False))
    return df.join(F.broadcast(bits.rows), "_row", "left").withColumn(name, hit).drop("_row", "_bit", "_bits")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the rows of ``docs`` whose doc_id is in ``ids``, a written table; with a bitmap, of a few others too.

    No text is shuffled for up to 33 million ids; beyond that the rows wanted are so many that they are joined.
    """
    texts, bits = docs.select("doc_id", "text"), bitmap(ids, "doc_id")
    if bits is None:
        return join_split(texts, ids.select("doc_id").distinct(), ["doc_id"], "left_semi")
    return with_hit(texts, bits, F.col("doc_id")).where("_hit").select("doc_id", "text")


def without_ids(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``dropped``, a written table; a null doc_id stays.

    Only rows that hit the bitmap of dropped ids go through a shuffle, the rest passes by. Beyond 33 million dropped ids
    all rows do.
    """
    packed = docs.select("doc_id", F.struct("*").alias("_doc"))  # no name in docs can clash
    marked = with_hit(packed, bitmap(dropped, "doc_id"), F.col("doc_id"))
    passed = marked.where(~F.col("_hit"))
    doubtful = marked.where("_hit").join(dropped.select("doc_id").distinct(), "doc_id", "left_anti")
    return passed.select("_doc.*").unionAll(doubtful.select("_doc.*"))


class WordHashes(dict):
    """64-bit hash of a word (bytes); each distinct word of a worker is hashed once."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > HASH_TABLE_SIZE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased. Bytes do both by ASCII alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: all bits of the result depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words; the whole sequence as one run if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x5851F42D4C957F2D) + words[k : k + n]
    return mix(out + np.uint64(size))


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and its process counts by what it has ever taken."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it, others need not
    if trim:
        trim(0)


def each_batch(batches: Iterator, fn) -> Iterator:
    for batch in batches:
        if len(batch):
            yield fn(batch)
    give_back()
