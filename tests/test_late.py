from __future__ import annotations

from pyspark.sql import functions as F

from conftest import tuples, write_lines
from millrace.entities import TRIPS
from millrace.operators.rides import demand
from millrace.streaming import demand_with_late, late, late_rows, start_demand_late
from test_medallion import DAY, layer, trip
from test_streaming import ingest


def at(number, clock, **changes):
    return trip(number, request_time=f"{DAY}T{clock}" if clock else None, **changes)


def count(spark, lake, delay="10 minutes", **options):
    start_demand_late(spark, lake, delay, **options).awaitTermination()


def deliver(spark, lake, lines, name):
    write_lines(lake, "trips", DAY, lines, name)
    ingest(spark, lake)
    count(spark, lake)


def test_rows_behind_the_line_are_counted_apart_and_kept(spark, lake):
    deliver(spark, lake, [at(1, "08:00:00"), at(2, "08:14:59"), at(3, "08:15:00"), at(9, None)], "a.jsonl")
    deliver(spark, lake, [at(4, "08:25:00"), at(5, "08:01:00")], "b.jsonl")  # the line is at 08:05, no window has closed
    deliver(spark, lake, [at(6, "08:02:00"), at(7, "08:29:59"), at(8, "08:03:00", city=None)], "c.jsonl")  # 08:15
    assert tuples(demand_with_late(spark, lake, "10 minutes")) == sorted([
        ("20260321_0800", "HCMC", "completed", 3, 1, True),
        ("20260321_0800", None, "completed", 0, 1, True),
        ("20260321_0815", "HCMC", "completed", 3, 0, False),
    ], key=repr)
    assert tuples(late_rows(spark, lake), "trip_id", "_micro_batch") == [("TRP00000006", 2), ("TRP00000008", 2)]


def test_on_time_and_late_rows_are_the_batch_count(spark, lake):
    import random

    rng = random.Random(5)
    for part in range(8):
        lines = [at(rng.randrange(10_000), f"{rng.randrange(part, 24):02}:{rng.randrange(60):02}:00", city=rng.choice(["A", "B", None])) for _ in range(30)]
        write_lines(lake, "trips", DAY, lines, f"{part}.jsonl")
        ingest(spark, lake)
        if part % 3 == 2:
            count(spark, lake, files_per_batch=2)
    count(spark, lake)
    found = demand_with_late(spark, lake, "10 minutes")
    whole = demand(layer(spark, lake, TRIPS, "bronze"), "request_time")
    both = found.withColumn("n", F.col("n_on_time") + F.col("n_late"))
    assert tuples(both, "batch_id", "city", "status", "n") == tuples(whole, "batch_id", "city", "status", "n")
    assert late_rows(spark, lake).count() == found.agg(F.sum("n_late")).first()[0] > 0


def test_a_replayed_micro_batch_leaves_one_result(spark, lake, tmp_path):
    deliver(spark, lake, [at(1, "08:00:00"), at(2, "12:00:00")], "a.jsonl")
    deliver(spark, lake, [at(3, "08:01:00"), at(4, "13:00:00")], "b.jsonl")
    before = tuples(demand_with_late(spark, lake, "10 minutes")), tuples(late_rows(spark, lake))
    commits = tmp_path / "lake" / "_checkpoints" / "demand-late" / "commits"
    for commit in [*commits.glob("1"), *commits.glob(".1.crc")]:
        commit.unlink()
    count(spark, lake)
    assert (tuples(demand_with_late(spark, lake, "10 minutes")), tuples(late_rows(spark, lake))) == before


def test_a_delivery_without_times_leaves_the_line_where_it_was(spark, lake):
    deliver(spark, lake, [at(1, None)], "a.jsonl")
    assert late.newest_before(spark, lake) is None and demand_with_late(spark, lake).count() == 0
    deliver(spark, lake, [at(2, "12:00:00")], "b.jsonl")
    deliver(spark, lake, [at(3, None)], "c.jsonl")
    deliver(spark, lake, [at(4, "08:00:00")], "d.jsonl")
    assert tuples(demand_with_late(spark, lake, "10 minutes"), "batch_id", "n_on_time", "n_late") == [
        ("20260321_0800", 0, 1), ("20260321_1200", 1, 0)
    ]
