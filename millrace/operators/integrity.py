"""Joins of a large table with reduced keys, and referential integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "_key_hash"


def join_reduced(rows: DataFrame, reduced: DataFrame, key: str, how: str) -> DataFrame:
    """Join rows, where one key may be very frequent, with at most one row per key.

    ``reduced`` comes out of an aggregate by key, and Spark would reuse that partitioning; the
    join input would then be no plain exchange and AQE could not split a hot key. Joining on the
    key's hash as well makes Spark exchange the few narrow reduced rows again, after which hot
    keys of ``rows`` are split at run time. A small reduced side is broadcast by its size.
    """
    hashed = F.xxhash64(F.col(key))
    joined = rows.withColumn(_HASH, hashed).join(
        reduced.withColumn(_HASH, hashed), on=[key, _HASH], how=how
    )
    return joined.drop(_HASH)


def rows_with_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Full rows of the listed keys, which must be distinct; a null key has no rows."""
    return join_reduced(df, keys.select(key), key, "inner").select(df.columns)


def rows_without_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Full rows whose key ``other`` lacks, copies included; a null key has no rows.

    The other side is reduced to its distinct keys before the join, so none of them is hot.
    """
    known = other.select(key).filter(F.col(key).isNotNull()).distinct()
    keyed = df.filter(F.col(key).isNotNull())
    return join_reduced(keyed, known, key, "left_anti").select(df.columns)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent, copies included; a null reference has no parent.

    Null references skip the join.
    """
    unmatched = rows_without_keys(child, parent, key)
    return unmatched.unionByName(child.filter(F.col(key).isNull()))
