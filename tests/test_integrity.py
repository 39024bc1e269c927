from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import plan, tuples
from millrace.operators.integrity import join_reduced, orphans, rows_with_keys, rows_without_keys
from millrace.operators.reconcile import (
    compare_counts,
    compare_keys,
    extra_keys,
    lost_keys,
    metric_diff,
)
from millrace.plans.reconciliation import reconcile_rows

RAW = [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("d", 6)]
STORED = [("a", 1), ("c", 7), ("c", 8), ("d", 6)]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, "k string, v int")


@pytest.fixture
def stored(spark):
    return spark.createDataFrame(STORED, "k string, v int")


def test_key_difference_is_except_distinct(raw, stored):
    keys = (raw.select("k"), stored.select("k"))
    assert tuples(lost_keys(raw, stored, "k")) == tuples(keys[0].subtract(keys[1]))
    assert tuples(extra_keys(raw, stored, "k")) == tuples(keys[1].subtract(keys[0])) == [("c",)]
    assert tuples(compare_keys(raw, stored, "k")) == [
        ("a", 2, 1),
        ("b", 1, 0),
        ("c", 0, 2),
        ("d", 1, 1),
        (None, 2, 0),
    ]


def test_key_difference_shuffles_once_after_a_partial_count(raw, stored):
    text = plan(lost_keys(raw, stored, "k"))
    assert text.count("Exchange") == 1
    assert "partial_sum" in text and "Join" not in text


def test_null_key_is_reported_but_has_no_rows(raw, stored):
    found = reconcile_rows(raw, stored, "k")
    assert tuples(found.lost_keys) == [("b",), (None,)]
    assert tuples(found.lost_rows) == [("b", 3)]
    assert tuples(found.extra_rows) == [("c", 7), ("c", 8)]
    assert tuples(found.counts()) == [(2, 1)]


def test_rows_without_keys_keeps_copies_and_joins_once(raw, stored, spark):
    assert tuples(rows_without_keys(stored, raw, "k")) == [("c", 7), ("c", 8)]
    assert tuples(rows_without_keys(raw, stored, "k")) == [("b", 3)]
    assert tuples(rows_without_keys(raw, stored.limit(0), "k")) == [("a", 1), ("a", 2), ("b", 3), ("d", 6)]
    assert plan(rows_without_keys(stored, raw, "k")).count("Join") == 1


def test_rows_with_keys_keeps_copies(raw, spark):
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    assert tuples(rows_with_keys(raw, keys, "k")) == [("a", 1), ("a", 2)]


def test_orphans_keep_copies_and_null_references(raw, stored):
    assert tuples(orphans(raw, stored, "k")) == [("b", 3), (None, 4), (None, 5)]
    assert tuples(orphans(stored, raw, "k")) == [("c", 7), ("c", 8)]


def test_counts_see_days_of_either_side(spark):
    raw = spark.createDataFrame([("d1",), ("d1",), ("d2",)], "day string")
    stored = spark.createDataFrame([("d1",), ("d1",), ("d3",)], "day string")
    assert tuples(compare_counts(raw, stored, "day")) == [("d2", 1, 0, 1), ("d3", 0, 1, -1)]


def test_metric_difference(raw, stored, spark):
    assert tuples(metric_diff(raw, stored, "v")) == [(21, 22, -1)]
    empty = spark.createDataFrame([], "v int")
    assert tuples(metric_diff(empty, empty, "v")) == [(0, 0, 0)]


@pytest.fixture
def skewed(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    cold = F.concat(F.lit("k"), F.col("id").cast("string"))
    child = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(cold).alias("k"), F.col("id").alias("v")
    )
    parent = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(cold).alias("k")
    )
    yield child, parent
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_key_is_split_in_the_joins(skewed):
    """The hot key has most rows of both sides; its partition must be split, nothing lost."""
    child, parent = skewed
    reduced = parent.distinct()
    for how in ("left_anti", "inner"):
        joined = join_reduced(child, reduced, "k", how)
        n_rows = len(joined.collect())
        assert "skew=true" in plan(joined)
        plain = child.join(reduced, "k", how)
        assert n_rows == plain.count()
    unmatched = orphans(child, parent, "k")
    assert unmatched.count() == 300_000 - 200_000 - 30_000


def test_metric_of_doubles_is_not_cut(spark):
    from millrace.operators.reconcile import metric_diff

    raw = spark.createDataFrame([(0.9,), (0.9,)], "km double")
    row = metric_diff(raw, spark.createDataFrame([(0.1,)], "km double"), "km").first()
    assert (round(row.raw_total, 9), round(row.stored_total, 9), round(row.difference, 9)) == (1.8, 0.1, 1.7)
    assert metric_diff(raw, raw, "km", 1e-9).first().difference == 0
