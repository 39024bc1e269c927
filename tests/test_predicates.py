from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import tuples
from millrace.functions.predicates import (
    Rule,
    at_least,
    failed_rules,
    one_of,
    all_hold,
    at_least,
    failed_rules,
    holds,
    one_of,
    passes,
    required,
    within,
)
from millrace.operators.quality import (
    audit,
    split_by_rules,
    verdict_counts,
    violation_profile,
)

RULES = (required("k"), one_of("kind", ("a", "b")), at_least("x", 0), within("stars", 1, 5))
SCHEMA = "k string, kind string, x double, stars int"


def verdict(row) -> bool | None:
    """The same conjunction by hand: False beats None, None beats True."""
    k, kind, x, stars = row
    parts = [
        k is not None,
        None if kind is None else kind in ("a", "b"),
        None if x is None else (x != x or x >= 0),
        None if stars is None else 1 <= stars <= 5,
    ]
    if False in parts:
        return False
    return None if None in parts else True


def test_null_input_gives_null_not_false(spark):
    df = spark.createDataFrame([(None, None, None, None)], SCHEMA)
    row = df.select(
        *[r.condition().alias(r.name) for r in RULES], passes(RULES).alias("passes")
    ).first()
    assert row.asDict() == {
        "k_present": False,
        "kind_known": None,
        "x_not_below_0": None,
        "stars_in_1_5": None,
        "passes": False,
    }


def test_false_beats_null(spark):
    df = spark.createDataFrame([("k", None, 1.0, 1), ("k", None, -1.0, 1)], SCHEMA)
    assert [r[0] for r in df.select(all_hold(RULES)).collect()] == [None, False]


def test_nan_passes_a_lower_bound(spark):
    df = spark.createDataFrame([(float("nan"),), (-0.0,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(holds(at_least("x", 0))).collect()] == [True, True, False]


def test_no_rules_pass_everything(spark):
    valid, invalid = split_by_rules(spark.range(3), ())
    assert (valid.count(), invalid.count()) == (3, 0)


ROWS = st.tuples(
    st.sampled_from([None, "k"]),
    st.sampled_from([None, "a", "b", "z"]),
    st.sampled_from([None, -1.0, 0.0, 2.5, float("nan")]),
    st.sampled_from([None, 0, 1, 5, 6]),
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=st.lists(ROWS, min_size=1, max_size=40))
def test_split_is_disjoint_and_complete(spark, rows):
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, "id int, " + SCHEMA)
    valid, invalid = split_by_rules(df, RULES)
    assert valid.columns == invalid.columns == df.columns
    valid_ids = {r.id for r in valid.collect()}
    invalid_ids = {r.id for r in invalid.collect()}
    assert valid_ids == {i for i, *row in numbered if verdict(row) is True}
    assert invalid_ids == {i for i, *row in numbered if verdict(row) is not True}


def test_counts_profile_and_audit_agree(spark):
    rows = [("k", "a", 1.0, 1), (None, "z", -1.0, 9), ("k", None, 1.0, 3), ("k", "b", 0.0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert tuples(verdict_counts(df, RULES)) == [(4, 1, 3)]
    assert tuples(violation_profile(df, RULES)) == [
        ("k_present", 1),
        ("kind_known", 2),
        ("stars_in_1_5", 2),
        ("x_not_below_0", 1),
    ]
    assert tuples(audit(df, RULES), F.array_join("failed_rules", ",")) == [
        ("k_present,kind_known,x_not_below_0,stars_in_1_5",),
        ("kind_known",),
        ("stars_in_1_5",),
    ]
    assert df.filter(F.size(failed_rules(RULES)) == 0).count() == 1


def test_a_rule_without_violations_is_listed_with_zero(spark):
    df = spark.createDataFrame([("k", "a", 1.0, 1)], SCHEMA)
    assert {r.violations for r in violation_profile(df, RULES).collect()} == {0}


def test_names_tell_rules_apart():
    assert at_least("x", 1_000_001).name != at_least("x", 1_000_002).name
    with pytest.raises(ValueError, match="share a name"):
        failed_rules([one_of("x", ["a"]), one_of("x", ["b"])])
    with pytest.raises(ValueError, match="comma"):
        Rule("a,b", lambda: None)
