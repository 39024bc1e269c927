"""Comparison of two layers by keys, counts and totals.

Both sides go through one aggregate together instead of a join, so each comparison shuffles
once, after both sides were reduced in the map tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType


def _tallied(raw: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    def side(df: DataFrame, raw_row: int, stored_row: int) -> DataFrame:
        return df.select(
            *keys, F.lit(raw_row).alias("in_raw"), F.lit(stored_row).alias("in_stored")
        )

    both = side(raw, 1, 0).unionByName(side(stored, 0, 1))
    return both.groupBy(*keys).agg(
        F.sum("in_raw").alias("raw_rows"), F.sum("in_stored").alias("stored_rows")
    )


def compare_keys(raw: DataFrame, stored: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every key of either side with its row count on both; nulls form one key."""
    return _tallied(raw, stored, [key] if isinstance(key, str) else list(key))


def lost_keys(raw: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Distinct raw keys that are not stored (EXCEPT DISTINCT)."""
    compared = compare_keys(raw, stored, key)
    return compared.filter((F.col("raw_rows") > 0) & (F.col("stored_rows") == 0)).select(key)


def extra_keys(raw: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Distinct stored keys that are not in raw."""
    return lost_keys(stored, raw, key)


def compare_counts(raw: DataFrame, stored: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Groups, such as days, whose row counts differ, also those found on one side only."""
    keys = [by] if isinstance(by, str) else list(by)
    compared = _tallied(raw, stored, keys)
    return compared.withColumn("difference", F.col("raw_rows") - F.col("stored_rows")).filter(
        F.col("difference") != 0
    )


def _common_decimal(kinds: Sequence[DataType]) -> DecimalType:
    """A decimal that holds the values of all ``kinds`` with all their digits, as far as 38 digits go."""
    digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
    sizes = [
        (k.precision - k.scale, k.scale) if isinstance(k, DecimalType) else (digits[k.simpleString()], 0) for k in kinds
    ]
    whole, scale = max(w for w, _ in sizes), max(s for _, s in sizes)
    return DecimalType(min(38, whole + scale), min(scale, 38 - min(whole, 38)))


def metric_diff(
    raw: DataFrame, stored: DataFrame, metric: str, tolerance: float = 0.0, digits: int = 9
) -> DataFrame:
    """The metric's total on both sides, and raw minus stored; one row.

    Integers are summed as bigint, decimals in a type that holds both sides. All else is taken as double, and each value
    rounded to ``digits`` decimal places and summed as a decimal, so that the totals don't depend on the order of
    summing; a NaN or infinite value makes the total one, a total beyond 38 digits raises. A difference of at most
    ``tolerance`` counts as none.
    """
    kinds = [df.schema[metric].dataType for df in (raw, stored)]
    inexact = False
    if all(isinstance(kind, IntegralType) for kind in kinds):
        kind = "bigint"
    elif all(isinstance(kind, (IntegralType, DecimalType)) for kind in kinds):
        kind = _common_decimal(kinds).simpleString()
    else:
        kind, inexact = f"decimal(38,{digits})", True

    def side(df: DataFrame, here: str, there: str) -> DataFrame:
        value, odd = F.col(metric), F.lit(None).cast("double")
        if inexact:
            number = value.cast("double")
            finite = F.abs(number) < float("inf")
            value, odd = F.when(finite, number), F.when(~finite, number)
        return df.select(
            value.cast(kind).alias(here), F.lit(None).cast(kind).alias(there),
            odd.alias(f"odd_{here}"), F.lit(None).cast("double").alias(f"odd_{there}"),
        )

    both = side(raw, "raw", "stored").unionByName(side(stored, "stored", "raw"))
    sums = both.agg(*[
        total.alias(name)
        for side_name in ("raw", "stored")
        for name, total in (
            (f"{side_name}_total", F.coalesce(F.sum(side_name), F.lit(0))), (f"odd_{side_name}", F.sum(f"odd_{side_name}"))
        )
    ])
    difference = F.col("raw_total") - F.col("stored_total")
    if inexact:
        totals = {c: F.coalesce(F.col(f"odd_{c}"), F.col(f"{c}_total").cast("double")) for c in ("raw", "stored")}
        odd = F.coalesce("odd_raw", "odd_stored").isNotNull()
        difference = F.when(odd, totals["raw"] - totals["stored"]).otherwise(difference.cast("double"))
    else:
        totals = {c: F.col(f"{c}_total") for c in ("raw", "stored")}
    if tolerance:
        difference = F.when(F.abs(difference) <= tolerance, F.lit(0.0)).otherwise(difference)
    return sums.select(totals["raw"].alias("raw_total"), totals["stored"].alias("stored_total"), difference.alias("difference"))
