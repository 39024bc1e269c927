from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan, tuples, write_lines
from millrace.entities import TRIPS
from millrace.lake import Lake, checked_day, day_path, day_range
from millrace.operators.dedupe import dedupe
from millrace.operators.quality import split_by_rules
from millrace.functions.predicates import at_least, one_of, required
from millrace.sources import (
    list_days,
    on_day,
    read_days,
    read_jsonl,
    read_table,
    read_table_day,
)

EDGE_LINES = [
    '{"_meta":{"b":1},"trip_id":"T1","fare":5,"dist":1.5,"ts":"2026-03-21T14:30:05"}',
    '{"trip_id":"T1","fare":6,"dist":1,"ts":"2026-03-21T14:30:05"}',
    "{bad json",
    "",
    '{"trip_id":null,"fare":9}',
    '{"trip_id":"T2","fare":12.0,"dist":"NaN"}',
    '{"trip_id":"T3","fare":99999999999,"dist":-0.0}',
    '{"trip_id":"T4","fare":"7","dist":"abc","ts":"nope"}',
    '{"trip_id":123,"fare":1,"dist":NaN}',
]
EDGE_SCHEMA = "trip_id string, fare int, dist double, ts timestamp"


@pytest.fixture
def edge(spark, lake):
    write_lines(lake, "trips", "2026-03-21", EDGE_LINES)
    schema = spark.createDataFrame([], EDGE_SCHEMA).schema
    return read_jsonl(spark, day_path(lake.raw, "trips", "2026-03-21"), schema)


def test_fixed_schema_keeps_bad_lines_as_nulls(edge):
    at = datetime(2026, 3, 21, 14, 30, 5)
    rows = edge.collect()
    assert edge.columns == ["trip_id", "fare", "dist", "ts"]
    assert [tuple(r) for r in rows[:4]] == [
        ("T1", 5, 1.5, at),
        ("T1", 6, 1.0, at),
        (None, None, None, None),
        (None, 9, None, None),
    ]
    assert (rows[4].trip_id, rows[4].fare, rows[4].ts) == ("T2", None, None)
    assert math.isnan(rows[4].dist)
    assert (rows[5].trip_id, rows[5].fare, math.copysign(1, rows[5].dist)) == ("T3", None, -1)
    assert tuple(rows[6]) == ("T4", None, None, None)
    assert rows[7].trip_id == "123" and math.isnan(rows[7].dist)
    assert len(rows) == 8


def test_edge_lines_through_dedupe_and_split(edge):
    deduped = dedupe(edge, "trip_id")
    assert deduped.count() == 6
    assert dedupe(edge, "trip_id", null_keys="keep").count() == 7
    rules = (
        required("trip_id"),
        at_least("fare", 0),
        at_least("dist", 0),
        one_of("trip_id", ("T1", "T2", "T3")),
    )
    valid, invalid = split_by_rules(edge, rules)
    assert (valid.count(), invalid.count()) == (2, 6)


def test_inferred_schema_keeps_everything(spark, lake):
    write_lines(lake, "trips", "2026-03-21", EDGE_LINES[:3])
    df = read_jsonl(spark, day_path(lake.raw, "trips", "2026-03-21"))
    types = dict(df.dtypes)
    assert types["fare"] == "bigint" and types["ts"] == "string"
    assert types["_meta"] == "struct<b:bigint>" and "_corrupt_record" in types


def test_missing_day_is_an_error(spark, lake):
    with pytest.raises(AnalysisException) as error:
        read_jsonl(spark, day_path(lake.raw, "trips", "2026-03-21"), TRIPS.schema)
    assert error.value.getCondition() == "PATH_NOT_FOUND"


def test_days_are_listed_without_parsing(spark, lake):
    for day in ("2026-03-22", "2026-03-20", "2026-03-21"):
        write_lines(lake, "trips", day, ["{}"])
    days = list_days(spark, lake.raw_entity("trips"))
    assert [r.date for r in days.collect()] == ["2026-03-20", "2026-03-21", "2026-03-22"]
    assert dict(days.dtypes) == {"date": "string"}
    assert "FileScan" not in plan(days)


def test_range_read_prunes_days_and_keeps_the_day_as_text(spark, lake):
    for day in day_range("2026-02-27", 4):
        write_lines(lake, "trips", day, [f'{{"trip_id":"{day}"}}'])
    rows = read_days(spark, lake.raw_entity("trips"), TRIPS.schema, "2026-02-28", "2026-03-01")
    assert tuples(rows, "trip_id", "date") == [("2026-02-28",) * 2, ("2026-03-01",) * 2]
    assert dict(rows.dtypes)["date"] == "string"
    assert "PartitionFilters: [isnotnull(date" in plan(rows)


def test_table_day_by_filter_and_by_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [("a", "2026-03-21"), ("b", "2026-03-22")], "k string, ingest_date string"
    )
    df.write.partitionBy("ingest_date").parquet(path)
    whole = on_day(read_table(spark, path, df.schema), "2026-03-21")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan(whole)
    folder = read_table_day(spark, path, df.schema, "2026-03-21")
    assert tuples(whole, "k", "ingest_date") == [("a", "2026-03-21")]
    assert tuples(folder, "k", "ingest_date") == [("a", "2026-03-21")]
    assert dict(folder.dtypes)["ingest_date"] == "string"
    assert read_table_day(spark, path, df.schema, "2026-03-23").count() == 0


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_table(spark, path, TRIPS.schema, missing_ok=True).count() == 0
    with pytest.raises(AnalysisException):
        read_table(spark, path, TRIPS.schema)
    with pytest.raises(Exception, match="no_such_format"):
        read_table(spark, path, TRIPS.schema, fmt="no_such_format", missing_ok=True)


def test_other_table_formats(spark, tmp_path):
    path = str(tmp_path / "orc")
    df = spark.createDataFrame([("a", "2026-03-21")], "k string, ingest_date string")
    df.write.format("orc").partitionBy("ingest_date").save(path)
    assert read_table_day(spark, path, df.schema, "2026-03-21", "orc").count() == 1


def test_days_are_checked_before_they_become_paths():
    assert checked_day("2026-03-21") == "2026-03-21"
    for bad in ("2026-3-21", "../x", "", "2026-02-30"):
        with pytest.raises(ValueError):
            checked_day(bad)
    assert day_range("2024-02-28", 3) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    lake = Lake("s3a://b/l", "s3a://b/raw")
    assert lake.quarantine("trips") == "s3a://b/l/silver/quarantine/trips"


def test_key_scan_reads_one_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).withColumn("other", F.lit(1)).write.parquet(path)
    df = spark.read.parquet(path).select("id")
    assert "ReadSchema: struct<id:bigint>" in plan(df)
