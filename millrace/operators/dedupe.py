"""Key dedupe and uniqueness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType, TimestampType

_RANK = "_rank"
#: Bits of the map of keys that may repeat: half a million words of it at most are broadcast, as many as repeated keys set.
REPEAT_BITS = 1 << 25


def dedupe(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str] = (),
    null_keys: str = "collapse",
    newest: str | None = None,
) -> DataFrame:
    """One row per key, the same row on every run.

    The row with the largest ``newest`` survives, then the first by ``order_by``, nulls last; all other columns follow as tie-breaks,
    so rows that still tie are equal. Spark keeps only the first row per key of each map task
    before the shuffle, so a key with very many copies never gathers in one task.

    ``null_keys="collapse"`` treats rows without a key as copies of each other; ``"keep"`` lets
    every one of them through, unshuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys must be 'collapse' or 'keep', not {null_keys!r}")
    if null_keys == "keep":
        has_key = F.lit(True)
        for name in keys:
            has_key = has_key & F.col(name).isNotNull()
        return dedupe(df.filter(has_key), keys, order_by, newest=newest).unionByName(df.filter(~has_key))
    unordered = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]
    rest = [c for c in df.columns if c not in {*keys, *order_by, *unordered, newest}]
    latest = [F.col(newest).desc_nulls_last()] if newest else []
    order = latest + [F.col(c).asc_nulls_last() for c in (*order_by, *rest)]
    order = order or [F.lit(1)]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe_in_place(df: DataFrame, key: str | Sequence[str], newest: str | None = None) -> DataFrame:
    """The rows of ``dedupe``, where most keys come once: only rows whose key may come again are shuffled.

    Each map task sends the hashes of its keys; those that come again set bits of a map, and rows that miss it are alone
    for certain and stay where they are. The more keys repeat, the more rows go through the dedupe, in the end all of them.
    ``df`` is read three times, so it should be a table. Equal keys need equal hashes: text or whole numbers.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed, bit = F.xxhash64(*keys), F.pmod("_hash", F.lit(REPEAT_BITS))
    again = df.select(hashed.alias("_hash")).groupBy("_hash").count().filter("count > 1").select(bit.alias("_bit"))
    one = F.expr("shiftleft(1L, cast(_bit % 64 as int))")
    words = again.groupBy(F.shiftright("_bit", 6).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    placed = df.withColumn("_hash", hashed).withColumn("_bit", bit).withColumn("_word", F.shiftright("_bit", 6))
    repeats = F.coalesce(F.expr("bit_get(_bits, cast(_bit % 64 as int)) = 1"), F.lit(False))
    marked = placed.join(F.broadcast(words), "_word", "left").select(*df.columns, repeats.alias("_repeats"))
    alone = marked.filter(~F.col("_repeats")).drop("_repeats")
    return alone.unionByName(dedupe(marked.filter("_repeats").drop("_repeats"), keys, newest=newest))


def survivor(df: DataFrame, keys: Sequence[str], newest: str | None = None, last: Sequence[str] = ()) -> Column:
    """The row that ``dedupe`` would keep, as an aggregate: the least struct of all columns in the same order.

    For streams, where no window function runs. ``last`` names columns that decide after all others. Unpacked again by
    ``unpacked``.
    """
    parts = []
    if newest:
        kind = df.schema[newest].dataType
        if not isinstance(kind, (TimestampType, NumericType)):
            raise TypeError(f"the newest row is told by a timestamp or a number, not by {kind.simpleString()}")
        number = F.unix_micros(newest) if isinstance(kind, TimestampType) else F.col(newest)
        parts += [F.isnull(newest).alias("_no_newest"), (-number).alias("_newest")]
    rest = [c for c in df.columns if c not in {*keys, newest, *last}]
    for name in (*rest, *last):
        parts += [F.isnull(name).alias(f"_no_{name}"), F.col(name)]
    return F.min(F.struct(*parts))


def unpacked(df: DataFrame, packed: str, like: DataFrame, keys: Sequence[str], newest: str | None = None) -> list[Column]:
    """The columns of ``like`` from the keys and the struct ``packed`` that ``survivor`` made."""

    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name != newest:
            return F.col(f"{packed}.{name}").alias(name)
        number = -F.col(f"{packed}._newest")
        kind = like.schema[name].dataType
        return (F.timestamp_micros(number) if isinstance(kind, TimestampType) else number.cast(kind)).alias(name)

    return [column(name) for name in like.columns]


def distinct_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Only the keys, once each; reads no other column."""
    return df.select(key if isinstance(key, str) else list(key)).distinct()


def repeated_keys(df: DataFrame, key: str | Sequence[str], limit: int = 1) -> DataFrame:
    """Keys with more than ``limit`` rows, with their row count; null is a key like any other."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(
        F.col("n_rows") > limit
    )
