from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan, tuples
from millrace.operators.digests import BUCKETS, compare_keys_by_digest, differing_buckets
from millrace.operators.reconcile import compare_keys, metric_diff
from millrace.plans import ingest, recon_filter, reconcile_digests, reconcile_rows
from millrace.sources import read_table
from millrace.entities import TRIPS
from test_medallion import DAY, fill, trip
from conftest import write_lines


@pytest.fixture
def sides(spark):
    raw = spark.range(20_000).selectExpr("concat('d', id % 7) AS day", "CASE WHEN id % 5000 <> 3 THEN concat('k', id) END AS k", "id AS v")
    changed = raw.filter("v % 4001 <> 5").withColumn("k", F.expr("CASE WHEN v = 77 THEN 'new' ELSE k END"))
    return raw, changed.unionByName(changed.filter("v % 1000 = 0"))  # some copies


def test_keys_by_digest_are_the_keys_of_the_whole_comparison(sides):
    raw, stored = sides
    want = compare_keys(raw, stored, ["day", "k"]).filter("raw_rows = 0 OR stored_rows = 0")
    for most in (200_000, 2):  # with two buckets at most, all keys are exchanged
        assert tuples(compare_keys_by_digest(raw, stored, "k", ["day"], most=most)) == tuples(want)
    assert len(tuples(want)) > 4
    assert compare_keys_by_digest(raw, raw.repartition(9), "k", ["day"]).count() == 0
    assert compare_keys_by_digest(raw.limit(0), raw.limit(0), "k").count() == 0
    none = compare_keys_by_digest(raw, raw.limit(0), "k")
    assert none.count() == raw.select("k").distinct().count()


def test_only_keys_of_differing_buckets_are_exchanged(spark, sides):
    raw, stored = sides
    found = differing_buckets(raw, stored, "k", ["day"])
    assert 0 < found.count() < 40 < 7 * BUCKETS
    compared = compare_keys_by_digest(raw, stored, "k", ["day"])
    text = plan(compared)
    assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text
    rows = compared.groupBy().agg(F.sum("raw_rows")).first()[0]
    buckets = {(r.day, r._bucket) for r in found.collect()}
    bucket = F.pmod(F.xxhash64("k"), F.lit(BUCKETS))
    exchanged = sum((r.day, r.b) in buckets for r in raw.select("day", bucket.alias("b")).collect())
    assert rows <= exchanged < raw.count() / 20


def test_digests_see_order_free_changes_copies_and_other_columns(spark):
    rows = [("a", 1), ("b", 2), (None, 3), ("", 4)]
    left = spark.createDataFrame(rows, "k string, v int")
    assert differing_buckets(left, left.orderBy("v").repartition(5), "k", columns=["v"], buckets=4).count() == 0
    swapped = spark.createDataFrame([("a", 2), ("b", 1), (None, 3), ("", 4)], "k string, v int")
    assert differing_buckets(left, swapped, "k", buckets=4).count() == 0
    assert differing_buckets(left, swapped, "k", columns=["v"], buckets=4).count() > 0
    twice = left.unionByName(left)
    other = spark.createDataFrame([(k, 0) for k in ("c", "c", "d", "d", "e", "e", "f", "f")], "k string, v int")
    assert differing_buckets(twice, other, "k", buckets=1).count() == 1  # pairs don't cancel
    nulls = spark.createDataFrame([(None, 1)], "k string, v int")
    empty = spark.createDataFrame([("", 1)], "k string, v int")
    assert differing_buckets(nulls, empty, "k", buckets=1).count() == 1


def test_raw_and_bronze_by_digest(spark, lake):
    fill(lake)
    write_lines(lake, "trips", "2026-03-22", [trip(30), trip(31)])
    for day in (DAY, "2026-03-22"):
        ingest(spark, lake, TRIPS, day)
    assert reconcile_digests(spark, lake, TRIPS).count() == 0
    write_lines(lake, "trips", "2026-03-22", [trip(30), trip(32)])
    assert tuples(reconcile_digests(spark, lake, TRIPS), "ingest_date", "trip_id", "raw_rows", "stored_rows") == [
        ("2026-03-22", "TRP00000031", 0, 1),
        ("2026-03-22", "TRP00000032", 1, 0),
    ]


def test_samples_filter_the_rows_of_the_first_keys_only(spark, lake):
    fill(lake)
    ingest(spark, lake, TRIPS, DAY)
    bronze = read_table(spark, lake.bronze("trips"), TRIPS.bronze_schema)
    judged = []

    def watched(df):
        judged.append(df)
        return df.transform(recon_filter(TRIPS))

    found = reconcile_rows(bronze, bronze.limit(0), "trip_id", watched, recon_filter(TRIPS), sample=2)
    whole = bronze.transform(recon_filter(TRIPS)).orderBy("trip_id").limit(2)
    assert tuples(found.lost_rows, "trip_id") == tuples(whole, "trip_id")
    assert judged[-1].select("trip_id").distinct().count() == 2


# --- totals --------------------------------------------------------------------------------------


def test_totals_of_two_decimals_keep_all_digits(spark):
    raw = spark.sql("SELECT CAST(0.10 AS DECIMAL(10,2)) AS m UNION ALL SELECT 12345678.90")
    stored = spark.sql("SELECT CAST(0.104 AS DECIMAL(20,6)) AS m UNION ALL SELECT 98765432101234.5")
    row = metric_diff(raw, stored, "m").first()
    assert row.stored_total == Decimal("98765432101234.604000") and row.difference == Decimal("12345679.00") - row.stored_total
    wide = spark.sql("SELECT CAST(1 AS DECIMAL(38,0)) AS m")
    assert metric_diff(wide, raw, "m").first().raw_total == 1
    whole = spark.sql("SELECT 9223372036854775807L AS m")
    assert metric_diff(whole, raw, "m").first().raw_total == Decimal(9223372036854775807)


def test_totals_of_doubles_have_the_same_digits_for_any_partitions(spark):
    rows = spark.range(5000).selectExpr("id * 0.1D / 3 + 1e6 / (id + 1) AS m", "id")
    totals = {tuple(metric_diff(rows.repartition(n).sortWithinPartitions(F.rand(n)), rows, "m").first()) for n in (1, 7, 64)}
    assert len(totals) == 1 and totals.pop()[2] == 0.0
    odd = rows.unionByName(spark.sql("SELECT CAST('NaN' AS DOUBLE) AS m, 1L AS id"))
    row = metric_diff(odd, rows, "m").first()
    assert row.raw_total != row.raw_total and row.difference != row.difference and row.stored_total > 0
    assert metric_diff(rows.limit(0), rows.limit(0), "m").first().difference == 0.0
