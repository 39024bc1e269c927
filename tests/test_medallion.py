from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import tuples, write_lines
from millrace.__main__ import execute, parser
from millrace.entities import ENTITIES, PAYMENTS, RATINGS, RUNS_SCHEMA, TRIPS
from millrace.lake import Lake, day_path
from millrace.plans import (
    CleanseCounts,
    IngestCounts,
    cleanse,
    ingest,
    line_counts,
    recon_filter,
    reconcile_counts,
    reconcile_layers,
    reconcile_raw,
    reconcile_raw_rows,
    reconcile_rows,
    run_day,
    run_range,
)
from millrace.sources import read_days, read_jsonl, read_table

DAY = "2026-03-21"


def trip(number, **changes):
    row = {
        "_meta": {"batch_id": "20260321_1200"},
        "trip_id": f"TRP{number:08}",
        "driver_id": "DRV00001",
        "rider_id": "RDR000001",
        "request_time": f"{DAY}T12:00:00",
        "status": "completed",
        "city": "HCMC",
        "distance_km": 2.5,
        "fare_vnd": 20_000,
    }
    return json.dumps({**row, **changes})


def payment(number, **changes):
    row = {
        "payment_id": f"PAY{number:08}",
        "trip_id": f"TRP{number:08}",
        "payment_method": "cash",
        "payment_status": "success",
        "fare_vnd": 20_000,
        "final_amount_vnd": 20_000,
    }
    return json.dumps({**row, **changes})


def rating(number, **changes):
    row = {
        "rating_id": f"RTG{number:08}",
        "trip_id": f"TRP{number:08}",
        "rater_type": "rider",
        "stars": 5,
    }
    return json.dumps({**row, **changes})


BAD_TRIPS = [
    trip(11, rider_id=None),
    trip(12, status="odd"),
    trip(13, city="DANANG"),
    trip(14, fare_vnd=-1),
    trip(15, distance_km=None),
    trip(16, distance_km=-0.5),
    "{broken",
    "{broken too",
]


def fill(lake: Lake, day: str = DAY) -> None:
    write_lines(lake, "trips", day, [trip(1), trip(1), trip(2, distance_km=0.0), *BAD_TRIPS])
    write_lines(
        lake,
        "payments",
        day,
        [payment(1), payment(2, final_amount_vnd=0), payment(3, payment_method="unknown_method")],
    )
    write_lines(lake, "ratings", day, [rating(1), rating(2, stars=0), rating(3, stars=6)])


def layer(spark, lake, entity, name):
    path, schema = {
        "bronze": (lake.bronze(entity.name), entity.bronze_schema),
        "silver": (lake.silver(entity.name), entity.silver_schema),
        "quarantine": (lake.quarantine(entity.name), entity.quarantine_schema),
    }[name]
    return read_table(spark, path, schema, missing_ok=True)


def keys(spark, lake, entity, name):
    return tuples(layer(spark, lake, entity, name), "ingest_date", entity.key)


def test_bronze_keeps_every_row(spark, lake):
    fill(lake)
    assert ingest(spark, lake, TRIPS, DAY) == IngestCounts(read=11, written=11)
    bronze = layer(spark, lake, TRIPS, "bronze")
    assert bronze.count() == 11
    assert set(bronze.columns) == set(TRIPS.bronze_schema.names)
    stamps = bronze.select("_ingested_at", "_batch_id", "_source", "ingest_date").distinct()
    assert stamps.count() == 1
    assert IngestCounts(read=5, written=3).dropped == 2


def test_repeated_runs_change_nothing_and_appends_double(spark, lake):
    fill(lake)
    for _ in range(2):
        ingest(spark, lake, TRIPS, DAY)
        cleanse(spark, lake, TRIPS, DAY)
    assert layer(spark, lake, TRIPS, "bronze").count() == 11
    assert layer(spark, lake, TRIPS, "silver").count() == 2
    ingest(spark, lake, TRIPS, DAY, mode="append")
    assert layer(spark, lake, TRIPS, "bronze").count() == 22
    assert cleanse(spark, lake, TRIPS, DAY, mode="append") == CleanseCounts(9, 2)
    assert layer(spark, lake, TRIPS, "silver").count() == 4
    with pytest.raises(ValueError):
        ingest(spark, lake, TRIPS, DAY, mode="merge")
    with pytest.raises(ValueError):
        cleanse(spark, lake, TRIPS, DAY, mode="merge")


def test_silver_and_quarantine(spark, lake):
    fill(lake)
    ingest(spark, lake, TRIPS, DAY)
    counts = cleanse(spark, lake, TRIPS, DAY)
    # The copy of trip 1 goes, and the two broken lines are one null key.
    assert (counts.evaluated, counts.valid, counts.quarantined) == (9, 2, 7)
    silver = layer(spark, lake, TRIPS, "silver")
    quarantine = layer(spark, lake, TRIPS, "quarantine")
    assert tuples(silver, "trip_id") == [("TRP00000001",), ("TRP00000002",)]
    assert quarantine.count() == 7
    assert tuples(quarantine.select("quarantine_reason").distinct()) == [
        ("Failed Data Quality Checks at Silver Layer",)
    ]
    stamps = silver.select("_silver_at").union(quarantine.select("_silver_at")).distinct()
    assert stamps.count() == 1
    assert reconcile_layers(spark, lake, TRIPS).count() == 0


def test_stale_quarantine_rows_go(spark, lake):
    fill(lake)
    ingest(spark, lake, RATINGS, DAY)
    assert cleanse(spark, lake, RATINGS, DAY) == CleanseCounts(3, 1)
    write_lines(lake, "ratings", DAY, [rating(1), rating(2, stars=1)])
    ingest(spark, lake, RATINGS, DAY)
    assert cleanse(spark, lake, RATINGS, DAY) == CleanseCounts(2, 2)
    assert layer(spark, lake, RATINGS, "quarantine").count() == 0


def test_missing_input(spark, lake):
    with pytest.raises(AnalysisException) as error:
        ingest(spark, lake, TRIPS, DAY)
    assert error.value.getCondition() == "PATH_NOT_FOUND"
    assert cleanse(spark, lake, TRIPS, DAY) == CleanseCounts(0, 0)
    assert cleanse(spark, lake, TRIPS, DAY, mode="append") == CleanseCounts(0, 0)


def test_empty_day(spark, lake):
    write_lines(lake, "trips", DAY, [""])
    assert ingest(spark, lake, TRIPS, DAY, mode="append") == IngestCounts(0, 0)
    assert layer(spark, lake, TRIPS, "bronze").count() == 0
    assert ingest(spark, lake, TRIPS, DAY) == IngestCounts(0, 0)
    assert cleanse(spark, lake, TRIPS, DAY) == CleanseCounts(0, 0)


def test_daily_run_logs_success(spark, lake):
    fill(lake)
    done = run_day(spark, lake, DAY)
    assert {name: (landed.written, split.valid) for name, (landed, split) in done.items()} == {
        "trips": (11, 2),
        "payments": (3, 2),
        "ratings": (3, 1),
    }
    runs = read_table(spark, lake.runs, RUNS_SCHEMA)
    assert tuples(runs, "target_date", "dag_id", "status") == [(DAY, "medallion_daily", "success")]


def test_daily_run_logs_failure_and_finishes_the_others(spark, lake):
    write_lines(lake, "trips", DAY, [trip(1)])
    with pytest.raises(AnalysisException):
        run_day(spark, lake, DAY)
    assert layer(spark, lake, TRIPS, "silver").count() == 1
    runs = read_table(spark, lake.runs, RUNS_SCHEMA)
    assert tuples(runs, "target_date", "status") == [(DAY, "failed")]


def test_range_is_the_same_as_its_days(spark, lake, tmp_path):
    days = ["2026-03-20", "2026-03-21", "2026-03-23"]
    for day in days:
        fill(lake, day)
    write_lines(lake, "trips", "2026-03-23", [trip(1), trip(7, fare_vnd=5), trip(7, fare_vnd=-5)])
    one_by_one = Lake(root=str(tmp_path / "daily"), raw=lake.raw)
    for day in days:
        run_day(spark, one_by_one, day)
    for _ in range(2):
        totals = run_range(spark, lake, "2026-03-20", 4)
    for entity in ENTITIES.values():
        for name in ("bronze", "silver", "quarantine"):
            assert keys(spark, lake, entity, name) == keys(spark, one_by_one, entity, name)
    trips = totals.filter("entity = 'trips'")
    assert tuples(
        trips, "ingest_date", "bronze_rows", "valid_rows", "quarantine_rows"
    ) == [
        ("2026-03-20", 11, 2, 7),
        ("2026-03-21", 11, 2, 7),
        ("2026-03-22", 0, 0, 0),
        ("2026-03-23", 3, 1, 1),
    ]
    runs = read_table(spark, lake.runs, RUNS_SCHEMA)
    # a day of the range has no raw file
    assert tuples(runs, "target_date", "status") == [("2026-03-20/2026-03-23", "incomplete")] * 2


def test_a_range_that_broke_off_goes_on_where_it_was(spark, lake):
    days = [f"2026-03-{n}" for n in range(20, 25)]
    for day in days:
        fill(lake, day)
    passes = []

    def failing(df):
        passes.append(df)
        if len(passes) == 3:
            raise RuntimeError("raw storage is away")
        return df

    with pytest.raises(RuntimeError):
        run_range(spark, lake, days[0], 5, [TRIPS], days_per_pass=2, validate=failing)
    assert layer(spark, lake, TRIPS, "silver").select("ingest_date").distinct().count() == 4

    def stamps():
        return dict(tuples(layer(spark, lake, TRIPS, "bronze").groupBy("ingest_date").agg(F.max("_ingested_at"))))

    before, seen = stamps(), []

    def watched(df):
        seen.extend(row["date"] for row in df.select("date").distinct().collect())
        return df

    run_range(spark, lake, days[0], 5, [TRIPS], days_per_pass=2, validate=watched)
    after = stamps()
    assert seen == [days[4]] and len(after) == 5 and all(after[day] == before[day] for day in days[:4])
    runs = read_table(spark, lake.runs, RUNS_SCHEMA)
    assert [r.status for r in runs.orderBy("run_at").collect()] == ["failed", "success"]
    # a range that came to its end is done anew, and so is one that is told to
    run_range(spark, lake, days[0], 5, [TRIPS], days_per_pass=2)
    assert all(at > after[day] for day, at in stamps().items())
    run_range(spark, lake, days[0], 5, [TRIPS], days_per_pass=2, resume=False)
    assert not list(Path(lake.root).glob("_staging/trips/range-*"))


def test_bad_lines_are_told_from_null_rows_counted_and_kept(spark, lake):
    lines = [trip(1), trip(2, fare_vnd="free"), "{broken", "{}", "[1, 2]", trip(3), '{"trip_id":null}', '{"other":1}', "", "null"]
    write_lines(lake, "trips", DAY, lines)
    write_lines(lake, "trips", "2026-03-22", [trip(4)])
    counts = ingest(spark, lake, TRIPS, DAY)
    assert (counts.read, counts.written, counts.broken, counts.damaged) == (9, 9, 3, 1)
    assert layer(spark, lake, TRIPS, "bronze").columns == TRIPS.bronze_schema.names
    kept = spark.read.parquet(lake.bad_lines("trips"))
    assert tuples(kept, "fault", "line") == sorted([("broken", "{broken"), ("broken", "[1, 2]"), ("broken", "null"), ("damaged", lines[1])], key=repr)
    assert tuples(line_counts(spark, lake, TRIPS)) == [(DAY, 9, 3, 1), ("2026-03-22", 1, 0, 0)]
    write_lines(lake, "trips", DAY, [trip(1)])
    assert ingest(spark, lake, TRIPS, DAY).broken == 0
    assert not (Path(lake.bad_lines("trips")) / f"ingest_date={DAY}").exists()


def test_range_failure_is_logged(spark, lake):
    with pytest.raises(AnalysisException):
        run_range(spark, lake, DAY, 1)
    runs = read_table(spark, lake.runs, RUNS_SCHEMA)
    assert tuples(runs, "status") == [("failed",)]
    with pytest.raises(ValueError):
        run_range(spark, lake, DAY, 0)


def test_raw_against_bronze(spark, lake):
    fill(lake)
    fill(lake, "2026-03-22")
    run_range(spark, lake, DAY, 2)
    raw = read_days(spark, lake.raw_entity("trips"), TRIPS.schema, DAY, "2026-03-22")
    raw = raw.withColumnRenamed("date", "ingest_date")
    bronze = layer(spark, lake, TRIPS, "bronze")
    assert reconcile_counts(raw, bronze).count() == 0
    # Filtered raw against unfiltered Bronze: every day with bad rows differs.
    filtered = reconcile_counts(raw, bronze, raw_filter=recon_filter(TRIPS, "ingest_date"))
    assert tuples(filtered) == [(DAY, 5, 11, -6), ("2026-03-22", 5, 11, -6)]
    both = recon_filter(TRIPS, "ingest_date")
    assert reconcile_counts(raw, bronze, both, both).count() == 0
    assert reconcile_raw(spark, lake, TRIPS).count() == 0
    assert tuples(reconcile_raw(spark, lake, TRIPS, both)) == tuples(filtered)


def test_raw_rows_behind_a_difference(spark, lake):
    fill(lake)
    ingest(spark, lake, TRIPS, DAY)
    write_lines(lake, "trips", DAY, [trip(2), trip(3)], "late.jsonl")
    found = reconcile_raw_rows(spark, lake, TRIPS, DAY)
    assert tuples(found.counts()) == [(1, 0)]
    assert tuples(found.lost_rows, "trip_id") == [("TRP00000003",)]
    found = reconcile_raw_rows(spark, lake, TRIPS, DAY, raw_filter=recon_filter(TRIPS))
    # Bronze keeps the rows that break the comparison rules, the null key among them.
    assert tuples(found.extra_keys) == [
        ("TRP00000011",),
        ("TRP00000012",),
        ("TRP00000013",),
        (None,),
    ]
    assert tuples(found.extra_rows, "trip_id") == [
        ("TRP00000011",),
        ("TRP00000012",),
        ("TRP00000013",),
    ]


def test_inferred_raw_can_be_compared_too(spark, lake):
    """Inference keeps the nested field and reads times as text; the rules do not mind."""
    fill(lake)
    ingest(spark, lake, TRIPS, DAY)
    raw = read_jsonl(spark, day_path(lake.raw, "trips", DAY))
    assert {"_meta", "_corrupt_record"} <= set(raw.columns)
    by_rule = recon_filter(TRIPS)
    found = reconcile_rows(raw, layer(spark, lake, TRIPS, "bronze"), "trip_id", by_rule, by_rule)
    assert tuples(found.counts()) == [(0, 0)]


def test_schemas():
    assert len(TRIPS.schema) == 17 and len(PAYMENTS.schema) == 12 and len(RATINGS.schema) == 9
    for entity in ENTITIES.values():
        assert all(field.nullable for field in entity.quarantine_schema)
        assert entity.quarantine_schema.names[-2:] == ["_silver_at", "quarantine_reason"]


def test_command_line(spark, lake, capsys):
    fill(lake)
    base = ["--lake", lake.root, "--raw", lake.raw]
    for words in (
        ["run", "--day", DAY],
        ["backfill", "--start", DAY, "--days", "1"],
        ["reconcile"],
        ["reconcile", "--day", DAY],
        ["runs"],
    ):
        execute(spark, parser().parse_args([*base, *words]))
    shown = capsys.readouterr().out
    assert "trips IngestCounts(read=11, written=11) CleanseCounts(evaluated=9, valid=2)" in shown
    assert "medallion_backfill" in shown
    with pytest.raises(SystemExit):
        parser().parse_args([*base, "--entity", "other", "runs"])


def test_verdict_columns_stay_out_of_the_tables(spark, lake):
    fill(lake)
    ingest(spark, lake, PAYMENTS, DAY)
    cleanse(spark, lake, PAYMENTS, DAY)
    files = spark.read.parquet(lake.silver("payments"))
    assert set(files.columns) == set(PAYMENTS.silver_schema.names)
    assert files.filter(F.col("_silver_at").isNull()).count() == 0


def test_days_without_input_keep_their_tables(spark, lake):
    write_lines(lake, "trips", "2026-03-20", [trip(1)])
    write_lines(lake, "trips", "2026-03-21", [trip(2), trip(3, city=None)])
    run_range(spark, lake, "2026-03-20", 2, [TRIPS])
    (Path(lake.raw) / "trips" / "date=2026-03-21" / "data.jsonl").unlink()
    before = {name: keys(spark, lake, TRIPS, name) for name in ("bronze", "silver", "quarantine")}
    run_range(spark, lake, "2026-03-20", 2, [TRIPS])
    with pytest.raises(FileNotFoundError):
        ingest(spark, lake, TRIPS, "2026-03-21")
    with pytest.raises(FileNotFoundError):
        run_range(spark, lake, "2026-03-21", 1, [TRIPS])
    assert {name: keys(spark, lake, TRIPS, name) for name in before} == before
    runs = spark.read.parquet(lake.runs).orderBy("run_at").select("status")
    assert [r.status for r in runs.collect()] == ["success", "incomplete", "failed"]


def test_cleanse_without_bronze_writes_nothing(spark, lake, tmp_path):
    write_lines(lake, "trips", DAY, [trip(1)])
    run_range(spark, lake, DAY, 1, [TRIPS])
    moved = Lake(root=lake.root, raw=lake.raw)
    counts = cleanse(spark, moved, TRIPS, "2026-03-25")
    assert (counts.evaluated, counts.valid) == (0, 0)
    assert layer(spark, lake, TRIPS, "silver").count() == 1


def test_newest_copy_stays_and_dropped_rows_are_counted(spark, lake):
    write_lines(lake, "payments", DAY, [
        payment(1, payment_time="2026-03-21T10:00:00", fare_vnd=1), payment(1, payment_time="2026-03-21T12:00:00", fare_vnd=9),
        payment(2),
    ])
    counts = ingest(spark, lake, PAYMENTS, DAY, validate=lambda df: df.filter("payment_id <> 'PAY00000002'"))
    assert (counts.read, counts.written, counts.dropped) == (3, 2, 1)
    cleanse(spark, lake, PAYMENTS, DAY)
    assert [r.fare_vnd for r in layer(spark, lake, PAYMENTS, "silver").collect()] == [9]
