"""Rule split, counts and violation profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.predicates import Rule, failed_rules, holds, passes

PASSES = "_passes"


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the one boolean that decides between valid and quarantined."""
    return df.withColumn(PASSES, passes(rules))


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(PASSES)).drop(PASSES)


def invalid_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(~F.col(PASSES)).drop(PASSES)


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and all others; together exactly ``df``."""
    judged = judge(df, rules)
    return valid_rows(judged), invalid_rows(judged)


def verdict_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluated, valid and invalid rows, in one pass."""
    ok = passes(rules)
    return df.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("invalid"),
    )


def violation_profile(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """How many rows break each rule, zeros included.

    All rules are counted in one aggregate, so a task ships one number per rule.
    """
    names = [rule.name for rule in rules]
    totals = df.agg(*[F.count_if(~holds(rule)).alias(rule.name) for rule in rules])
    return totals.unpivot([], names, "rule", "violations")


def audit(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break a rule, with the names of the rules they break.

    Filtered by the plain verdict first, so that names are made for failing rows only.
    """
    return df.filter(~passes(rules)).withColumn("failed_rules", failed_rules(rules))
