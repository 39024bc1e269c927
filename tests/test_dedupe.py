from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, tuples
from millrace.operators import dedupe as module
from millrace.operators.dedupe import dedupe, dedupe_in_place, distinct_keys, repeated_keys


def sample(spark, n=600, seed=5):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([None, "hot", "hot", f"k{rng.randrange(50)}"]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, "x", "y"]),
        )
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "k string, a int, b string")


def first_by_hand(rows):
    def order(row):
        return [(value is None, value if value is not None else 0) for value in row[1:2]] + [
            (value is None, value or "") for value in row[2:]
        ]

    best = {}
    for row in rows:
        if row[0] not in best or order(row) < order(best[row[0]]):
            best[row[0]] = row
    return sorted(best.values(), key=repr)


def test_survivor_is_the_first_by_total_order(spark):
    rows, df = sample(spark)
    assert tuples(dedupe(df, "k")) == first_by_hand(rows)


def test_survivor_does_not_depend_on_partitioning(spark):
    _, df = sample(spark)
    once = tuples(dedupe(df, "k", ("b",)))
    for n in (1, 3, 7):
        assert tuples(dedupe(df.repartition(n), "k", ("b",))) == once
    assert tuples(dedupe(df.orderBy(F.desc("a")), "k", ("b",))) == once


def test_null_keys(spark):
    rows, df = sample(spark)
    n_null = sum(row[0] is None for row in rows)
    n_keys = len({row[0] for row in rows} - {None})
    assert dedupe(df, "k").count() == n_keys + 1
    assert dedupe(df, "k", null_keys="keep").count() == n_keys + n_null
    with pytest.raises(ValueError):
        dedupe(df, "k", null_keys="drop")


def test_hot_key_shrinks_before_the_shuffle(spark):
    """Only one row per key and map task may be shuffled, however many copies a key has."""
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    once = dedupe(df, "k")
    before_exchange = plan(once).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit [k" in before_exchange
    assert "Partial" in before_exchange
    assert once.count() == 20_001
    assert once.filter("k = 'hot'").first().v == 0


def test_composite_keys_and_repeats(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", "y"), (None, "x"), (None, "x")], "k string, kind string"
    )
    assert dedupe(df, ["k", "kind"]).count() == 3
    assert tuples(repeated_keys(df, ["k", "kind"])) == [("a", "x", 2), (None, "x", 2)]
    assert tuples(repeated_keys(df, "k", limit=2)) == [("a", 3)]
    assert distinct_keys(df, "k").count() == 2


@pytest.mark.parametrize("bits", [64, 1 << 25])
def test_dedupe_in_place_keeps_the_rows_of_dedupe(spark, monkeypatch, bits):
    """Null keys, copies that tie, copies that are equal; also with a map so small that nearly every key seems to repeat."""
    monkeypatch.setattr(module, "REPEAT_BITS", bits)
    rows = spark.sql(
        """SELECT CASE WHEN id % 50 > 0 THEN string(id % 300) END AS k, string(id % 3) AS day,
        CASE WHEN id % 5 > 0 THEN timestamp_seconds(id * 7919 % 13) END AS t, id % 7 AS v FROM range(500)"""
    )
    for key, newest in ((["day", "k"], "t"), ("k", "t"), ("k", None)):
        want, found = tuples(dedupe(rows, key, newest=newest)), tuples(dedupe_in_place(rows, key, newest=newest))
        assert found == want and found


def test_dedupe_in_place_shuffles_no_row_whose_key_comes_once(spark, tmp_path):
    spark.range(20_000).selectExpr("string(id % 19990) AS k", "sha2(string(id), 512) AS wide").write.parquet(str(tmp_path / "t"))
    found = dedupe_in_place(spark.read.parquet(str(tmp_path / "t")), "k")
    found.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 19_990
    before, after = plan(dedupe(spark.read.parquet(str(tmp_path / "t")), "k")), plan(found)
    assert "hashpartitioning(_hash#" not in before and "hashpartitioning(_hash#" in after and "BroadcastHashJoin" in after
