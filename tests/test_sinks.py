from __future__ import annotations

import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from millrace.entities import RUNS_SCHEMA
from millrace.operators.stamps import with_audit, with_quarantine_reason, with_silver_stamp
from millrace.session import CLEANUP, scratch_dir, settings
from millrace.sinks import (
    append_partitioned,
    log_run,
    replace_day,
    replace_days,
    replace_micro_batch,
    sample_rows,
    write_day_jsonl,
)
from millrace.sinks.tables import days_predicate, replace_days
from millrace.sources import latest_runs, read_table

SCHEMA = "k string, ingest_date string"


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def stored(spark, path):
    return tuples(spark.read.schema(SCHEMA).parquet(path), "k", "ingest_date")


def test_append_doubles_and_skips_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not append_partitioned(frame(spark), path)
    assert not (tmp_path / "t").exists()
    day = frame(spark, ("a", "2026-03-21"))
    assert append_partitioned(day, path) and append_partitioned(day, path)
    assert stored(spark, path) == [("a", "2026-03-21")] * 2


def test_replacing_a_day_can_be_repeated_and_can_empty_it(spark, tmp_path):
    path = str(tmp_path / "t")
    append_partitioned(frame(spark, ("a", "2026-03-21"), ("b", "2026-03-22")), path)
    for _ in range(2):
        replace_day(frame(spark, ("c", "2026-03-21")), path, "2026-03-21")
        assert stored(spark, path) == [("b", "2026-03-22"), ("c", "2026-03-21")]
    replace_day(frame(spark), path, "2026-03-21")
    assert stored(spark, path) == [("b", "2026-03-22")]


@pytest.mark.parametrize("gather", [True, False])
def test_replacing_days_clears_requested_days_only(spark, tmp_path, gather):
    path = str(tmp_path / "t")
    first = frame(
        spark, ("a", "2026-03-20"), ("b", "2026-03-21"), ("c", "2026-03-22"), ("d", "2026-03-25")
    )
    replace_days(spark, first, path, ["2026-03-20", "2026-03-21", "2026-03-22", "2026-03-25"])
    assert len(stored(spark, path)) == 4
    again = frame(spark, ("e", "2026-03-20"))
    for _ in range(2):
        days = ["2026-03-20", "2026-03-21", "2026-03-23"]
        replace_days(spark, again, path, days, gather=gather)
        assert stored(spark, path) == [
            ("c", "2026-03-22"),
            ("d", "2026-03-25"),
            ("e", "2026-03-20"),
        ]


def test_replacing_days_with_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_days(spark, frame(spark), path, ["2026-03-20"])
    replace_days(spark, frame(spark, ("a", "2026-03-20")), path, ["2026-03-20"])
    replace_days(spark, frame(spark), path, ["2026-03-20"])
    assert stored(spark, path) == []


def test_a_replayed_micro_batch_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_micro_batch(frame(spark, ("a", "2026-03-21"), ("b", "2026-03-22")), path, 0)
    replace_micro_batch(frame(spark, ("c", "2026-03-21")), path, 1)
    replace_micro_batch(frame(spark, ("a", "2026-03-21")), path, 0)
    assert stored(spark, path) == [("a", "2026-03-21"), ("c", "2026-03-21")]


def test_raw_days_are_replaced_and_keep_every_digit(spark, tmp_path):
    root = str(tmp_path / "raw")

    def lines(k, day, at="2026-03-21 10:00:00.123456"):
        return spark.createDataFrame([(k, day, at)], "k string, day string, at string").withColumn(
            "at", F.col("at").cast("timestamp_ntz")
        )

    write_day_jsonl(lines("a", "2026-03-20").union(lines("b", "2026-03-21")), root, "day")
    write_day_jsonl(lines("c", "2026-03-21"), root, "day")
    back = spark.read.schema("k string, at timestamp, date string").json(root)
    assert tuples(back, "k", "date") == [("a", "2026-03-20"), ("c", "2026-03-21")]
    assert {r.at for r in back.collect()} == {datetime(2026, 3, 21, 10, 0, 0, 123456)}
    assert '"at":"2026-03-21T10:00:00.123456"' in spark.read.text(root).first().value


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    ids = [log_run(spark, path, "2026-03-21", "daily", s) for s in ("success", "failed")]
    runs = read_table(spark, path, RUNS_SCHEMA)
    assert len(set(ids)) == 2
    assert [(r.id, r.status) for r in latest_runs(runs, 1).collect()] == [(ids[1], "failed")]
    assert latest_runs(runs).columns == ["id", "run_at", "target_date", "dag_id", "status"]


def test_latest_runs_are_the_newest_twenty(spark):
    start = datetime(2026, 3, 21)
    rows = [(f"r{i:02}", start + timedelta(minutes=i // 2), "d", "j", "s") for i in range(50)]
    runs = spark.createDataFrame(rows, RUNS_SCHEMA)
    newest = [r.id for r in latest_runs(runs).collect()]
    assert newest == [f"r{i + j:02}" for i in range(48, 28, -2) for j in (0, 1)]


def test_stamps(spark):
    at = datetime(2026, 3, 21, 4, 5, 6)
    df = with_audit(spark.createDataFrame([("a",)], "k string"), "2026-03-21", at=at)
    df = with_quarantine_reason(with_silver_stamp(df, at))
    assert df.dtypes == [
        ("k", "string"),
        ("_ingested_at", "timestamp"),
        ("_batch_id", "string"),
        ("_source", "string"),
        ("ingest_date", "string"),
        ("_silver_at", "timestamp"),
        ("quarantine_reason", "string"),
    ]
    assert df.first()[2:5] == ("2026-03-21", "simulator", "2026-03-21")


def test_sample_is_settled_by_all_columns(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "k string, v int")
    assert [tuple(r) for r in sample_rows(df, "k", 2).collect()] == [("a", 1), ("a", 2)]


def session_stub(shared, master):
    conf = SimpleNamespace(get=lambda key, default=None: shared)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_is_below_the_shared_folder():
    cluster = session_stub("s3a://bucket/shared/", "spark://host:7077")
    one, two = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert one != two and one.startswith("s3a://bucket/shared/x-")


def test_only_a_local_session_may_use_a_temporary_folder():
    assert "/run-" in scratch_dir(session_stub(None, "local[8]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session_stub(None, "spark://host:7077"), "x")


def test_first_shuffle_is_sized_by_the_input():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert key not in settings()
    assert settings(1)[key] == "8"
    assert settings(300 * 1024**3)[key] == "1200"
    assert settings(100 * 1024**4)[key] == str(100 * 1024**4 // (256 * 1024**2))


def test_only_listed_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "listed")
    old = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-03")], "n int, ingest_date string")
    replace_days(spark, old, path, ["2026-01-01", "2026-01-02", "2026-01-03"])
    replace_days(spark, old.withColumn("n", old.n * 10), path, ["2026-01-01", "2026-01-03"])
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [2, 10, 30]
    assert days_predicate(["2026-01-03", "2026-01-01"]) == "ingest_date IN ('2026-01-01', '2026-01-03')"


def test_stale_days_are_cleared_without_a_job_each(spark, tmp_path):
    days = [f"2026-01-{n:02}" for n in range(1, 31)]

    def jobs(n):
        path = str(tmp_path / f"t{n}")
        replace_days(spark, frame(spark, *[("a", day) for day in days]), path, days)
        spark.sparkContext.setJobGroup(f"stale-{n}", "")
        replace_days(spark, frame(spark, *[("b", day) for day in days[n:]]), path, days)
        spark.sparkContext._jsc.clearJobGroup()
        assert stored(spark, path) == [("b", day) for day in days[n:]]
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"stale-{n}"))

    assert jobs(2) == jobs(29)


def test_a_write_of_many_days_leaves_no_shuffle_files(spark, tmp_path):
    """They would stay until the driver collects its garbage, beside all tables of a backfill."""

    def shuffled() -> set[str]:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}

    rows = spark.range(5000).selectExpr("string(id) AS id", "concat('2026-03-2', id % 3) AS ingest_date")
    before = shuffled()
    replace_days(spark, rows.repartition(4, "id"), str(tmp_path / "t"), ["2026-03-20", "2026-03-21", "2026-03-22"])
    replace_micro_batch(rows.repartition(4, "id"), str(tmp_path / "m"), 0)
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(CLEANUP) == "false"
    for name in ("t", "m"):
        assert spark.read.parquet(str(tmp_path / name)).count() == 5000
        assert all(".zstd." in file for file in spark.read.parquet(str(tmp_path / name)).inputFiles())
