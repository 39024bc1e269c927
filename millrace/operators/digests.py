"""Comparison of two layers by digests of key buckets, so that only keys of buckets that differ are exchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.reconcile import compare_keys
from millrace.session import scratch_dir

BUCKETS = 256
#: Buckets that are sent to all tasks at most, some 30 bytes each; if more differ, all keys are compared instead.
MOST_BUCKETS = 200_000
_BUCKET = "_bucket"
_SEEDS = (11, 7919)  # a hash each: 128 bits in all


def _hashes(columns: Sequence[str]) -> list[Column]:
    # nulls are told from their neighbours by their own flags: a hash alone skips them
    parts = [c for name in columns for c in (F.col(name), F.isnull(name))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in _SEEDS]


def _halves(signed: Column) -> list[Column]:
    """Each hash in two halves, whose sums can't leave a bigint before two billion rows meet in a bucket."""
    return [signed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(signed, 32)]


def with_bucket(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))


def differing_buckets(
    raw: DataFrame,
    stored: DataFrame,
    key: str,
    by: Sequence[str] = (),
    columns: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Groups of ``by`` and key bucket in which the two sides differ, with their rows: by, _bucket, raw_rows, stored_rows.

    A bucket's digest is the number of its rows and the sums of two 64-bit hashes of key and ``columns``, taken apart
    into halves, so order and partitions don't matter and copies don't cancel each other. Both sides go through one
    aggregate: a map task sends one row per group and bucket, whatever the number of its keys.
    """

    def side(df: DataFrame, sign: int) -> DataFrame:
        first, second = _hashes([key, *columns])
        sums = [(sign * half).alias(f"_s{k}") for k, half in enumerate(_halves(first) + _halves(second))]
        rows = [F.lit(int(sign > 0)).alias("raw_rows"), F.lit(int(sign < 0)).alias("stored_rows")]
        return with_bucket(df, key, buckets).select(*by, _BUCKET, *sums, *rows)

    both = side(raw, 1).unionByName(side(stored, -1))
    names = [f"_s{k}" for k in range(2 * len(_SEEDS))]
    sums = both.groupBy(*by, _BUCKET).agg(*[F.sum(c).alias(c) for c in (*names, "raw_rows", "stored_rows")])
    same = F.col("raw_rows") == F.col("stored_rows")
    for name in names:
        same = same & (F.col(name) == 0)
    return sums.filter(~same).drop(*names)


def compare_keys_by_digest(
    raw: DataFrame,
    stored: DataFrame,
    key: str,
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
    most: int = MOST_BUCKETS,
) -> DataFrame:
    """Keys that are on one side only, per group: by, key, raw_rows, stored_rows. Null is a key.

    A first pass over both sides finds the buckets that differ. The second reads the keys again but exchanges those of
    these buckets only; the list of buckets is counted before it is sent to the tasks, and beyond ``most`` of them all
    keys are exchanged, as little would be left out. A bucket can differ in copies alone: its keys are then found equal.
    """
    names = [*by, _BUCKET]
    spark, path = raw.sparkSession, scratch_dir(raw.sparkSession, "differing-buckets")
    listed = differing_buckets(raw, stored, key, by, (), buckets).select(*names)
    listed.write.parquet(path)  # the second pass does not run the first one again
    found = spark.read.schema(listed.schema).parquet(path)
    few = found.count() <= most

    def side(df: DataFrame) -> DataFrame:
        rows = with_bucket(df.select(*by, key), key, buckets)
        if few:
            wanted = F.broadcast(found.select(*[F.col(c).alias(f"_w_{c}") for c in names]))
            same = F.lit(True)
            for name in names:
                same = same & F.col(name).eqNullSafe(F.col(f"_w_{name}"))
            rows = rows.join(wanted, same, "left_semi")
        return rows.select(*by, key)

    compared = compare_keys(side(raw), side(stored), [*by, key])
    return compared.filter((F.col("raw_rows") == 0) | (F.col("stored_rows") == 0))
