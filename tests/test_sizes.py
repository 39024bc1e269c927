from __future__ import annotations

import gzip
import time
from pathlib import Path

import pytest
from conftest import plan, tuples
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from millrace.entities import PAYMENTS
from millrace.lake import Lake
from millrace.plans import run_range
from millrace.registry import lakes, views
from millrace.session import (
    ADVISORY,
    INITIAL_PARTITIONS,
    OPEN_DAYS,
    SORT_ADVISORY_BYTES,
    SORT_SPLIT_BYTES,
    SPLIT_BYTES,
    SPLITS,
    STATE_STORE,
    WRITERS,
    setting,
    size_reads,
    size_shuffles,
    size_state,
    small_sorts,
)
from millrace.sinks import append_partitioned, replace_days, replace_micro_batch, write_day_jsonl
from millrace.streaming import start_ingest
from millrace.sources import read_days


def test_a_small_table_is_spread_without_a_sort(spark):
    text = plan(views.spread(spark.range(1000, numPartitions=1).selectExpr("id", "id % 7 AS n"), 4))
    assert "hashpartitioning" in text and "RoundRobin" not in text and "Sort" not in text


def test_a_large_table_is_staged_by_the_tasks_that_read_it(spark, tmp_path, monkeypatch):
    spark.range(1000).selectExpr(
        "id AS s_suppkey", "id % 3 AS s_nationkey"
    ).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(views, "SPREAD_BELOW", 1)
    assert not views.is_small(spark, str(tmp_path), "v_drivers")
    path = views._stage(spark, str(tmp_path), "v_drivers")
    assert len(list(Path(path).glob("*.parquet"))) == 1 and spark.read.parquet(path).count() == 1000


def test_raw_lines_without_a_shuffle_are_bounded_compressed_files(spark, tmp_path):
    rows = spark.range(10, numPartitions=1).selectExpr("id", "concat('2026-03-2', id % 2) AS day")
    write_day_jsonl(rows, str(tmp_path), "day", gather=False, compression="gzip", lines_per_file=2)
    files = sorted(tmp_path.glob("date=*/*.json.gz"))
    assert len(files) == 6 and all(len(gzip.decompress(f.read_bytes()).splitlines()) <= 2 for f in files)
    back = read_days(spark, str(tmp_path), rows.select("id").schema)
    assert tuples(back, "id", "date") == tuples(rows, "id", "day")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None


def test_compressed_input_counts_as_the_rows_it_holds(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(b"0" * 300_000_000)
    own = spark.newSession()
    own.conf.unset(INITIAL_PARTITIONS)
    own.conf.set("spark.sql.shuffle.partitions", "50")
    size_shuffles(own, str(tmp_path), only_up=True)
    assert own.conf.get(INITIAL_PARTITIONS, None) is None  # 12 are wanted, 50 are there
    size_shuffles(own, str(tmp_path))
    assert own.conf.get(INITIAL_PARTITIONS) == "12"


def test_a_plain_session_gets_small_splits_and_state_off_the_heap(spark):
    own = spark.newSession()
    own.conf.set(SPLITS, "128m")
    for key in STATE_STORE:
        own.conf.unset(key)
    size_reads(own)
    size_state(own)
    assert own.conf.get(SPLITS) == str(SPLIT_BYTES)
    assert all(own.conf.get(key) == value for key, value in STATE_STORE.items())
    own.conf.set(SPLITS, "1m")
    size_reads(own)
    assert own.conf.get(SPLITS) == "1m"


@pytest.fixture
def writes(spark, monkeypatch):
    """The settings at each write: open writers, splits, advisory size."""
    seen = []
    for name in ("save", "parquet"):
        real = getattr(DataFrameWriter, name)

        def write(self, path=None, *args, _real=real, _name=name, **options):
            seen.append((path, *(spark.conf.get(key, None) for key in (WRITERS, SPLITS, ADVISORY))))
            return _real(self, path, *args, **options)

        monkeypatch.setattr(DataFrameWriter, name, write)
    return seen


def test_tables_by_day_are_written_without_a_sort(spark, tmp_path, writes):
    days = ["2026-03-20", "2026-03-21"]
    rows = spark.range(10).selectExpr("id", "concat('2026-03-2', id % 2) AS ingest_date")
    append_partitioned(rows, str(tmp_path / "a"))
    replace_days(spark, rows, str(tmp_path / "b"), days)
    replace_days(spark, rows, str(tmp_path / "b"), days, gather=False)
    replace_micro_batch(rows, str(tmp_path / "c"), 0)
    assert [open_at_a_time for _, open_at_a_time, *_ in writes] == [str(OPEN_DAYS)] * 4
    assert tuples(spark.read.parquet(str(tmp_path / "b")).select("id"), "id") == tuples(rows, "id")
    assert spark.conf.get(WRITERS, None) is None


def payments(spark, lake):
    rows = spark.range(20).select(
        F.concat(F.lit("PAY"), F.col("id") % 15).alias("payment_id"), F.lit("TRP1").alias("trip_id"),
        F.lit("success").alias("payment_status"), F.lit("cash").alias("payment_method"),
        F.col("id").cast("int").alias("final_amount_vnd"), F.lit("2026-03-21").alias("day"),
    )
    write_day_jsonl(rows, lake.raw_entity("payments"), "day")


def test_a_backfill_sorts_little_at_a_time(spark, tmp_path, writes):
    lake = Lake(root=str(tmp_path / "lake"), raw=str(tmp_path / "raw"))
    payments(spark, lake)
    before = [spark.conf.get(key, None) for key in (WRITERS, SPLITS, ADVISORY)]
    counts = run_range(spark, lake, "2026-03-21", 1, (PAYMENTS,)).first()
    assert (counts["bronze_rows"], counts["valid_rows"], counts["quarantine_rows"]) == (20, 15, 0)
    (staged,) = [found for found in writes if "_staging" in found[0]]
    assert int(staged[2]) <= SORT_SPLIT_BYTES and int(staged[3]) <= SORT_ADVISORY_BYTES
    assert [spark.conf.get(key, None) for key in (WRITERS, SPLITS, ADVISORY)] == before


def test_small_sorts_keep_smaller_sizes(spark):
    own = spark.newSession()
    own.conf.set(SPLITS, "1m")
    own.conf.set(ADVISORY, "64m")
    own.conf.set(INITIAL_PARTITIONS, "10")
    with small_sorts(own), small_sorts(own):  # as two jobs side by side
        assert own.conf.get(SPLITS) == str(2**20) and own.conf.get(ADVISORY) == str(SORT_ADVISORY_BYTES)
        assert own.conf.get(INITIAL_PARTITIONS) == "40"
    assert [own.conf.get(key) for key in (SPLITS, ADVISORY, INITIAL_PARTITIONS)] == ["1m", "64m", "10"]


def test_a_setting_stays_as_long_as_a_job_beside_needs_it(spark):
    first, second = setting(spark, WRITERS, 3), setting(spark, WRITERS, 3)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(WRITERS, None) == "3"
    second.__exit__(None, None, None)
    assert spark.conf.get(WRITERS, None) is None


def test_a_stream_lands_its_files_without_a_sort(spark, tmp_path):
    lake = Lake(root=str(tmp_path / "lake"), raw=str(tmp_path / "raw"))
    payments(spark, lake)
    query = start_ingest(spark, lake, PAYMENTS)
    assert spark.conf.get(WRITERS, None) == str(OPEN_DAYS)
    query.awaitTermination()
    assert spark.read.parquet(lake.bronze("payments")).count() == 20
    for _ in range(100):
        if spark.conf.get(WRITERS, None) is None:
            break
        time.sleep(0.1)
    assert spark.conf.get(WRITERS, None) is None


def test_replaced_days_come_from_small_sorts(spark, tmp_path, writes):
    lines = spark.range(12).selectExpr(
        "id % 10 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(1 AS INT) AS l_linenumber",
        "CAST(100 + id AS DOUBLE) AS l_extendedprice", "'A' AS l_returnflag", "CAST('1997-03-05' AS TIMESTAMP_NTZ) AS l_shipdate",
    )
    lines = lines.union(lines.limit(1).withColumn("l_shipdate", F.expr("CAST('1997-04-05' AS TIMESTAMP_NTZ)")))
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    writes.clear()
    found = lakes.replace_idempotent(spark, str(tmp_path)).collect()
    assert [(row["ingest_date"], row["n"]) for row in found] == [("1997-04-01", 1)]
    saved = [found for found in writes if "/offered-" in found[0] or "/replace-" in found[0]]
    assert len(saved) == 4 and all(found[1] == str(OPEN_DAYS) for found in saved)
    assert int(saved[0][2]) <= SORT_SPLIT_BYTES and int(saved[0][3]) <= SORT_ADVISORY_BYTES
