from __future__ import annotations

from pyspark.sql import functions as F

from conftest import tuples, write_lines
from millrace.entities import PAYMENTS, TRIPS
from millrace.lake import Lake
from millrace.plans import run_range
from millrace.sources import read_table
from millrace.files import exists
from millrace.operators.dedupe import dedupe, survivor, unpacked
from millrace.sinks import tables
from millrace.streaming import jobs, start_closed_days, start_demand, start_ingest, start_silver
from test_medallion import BAD_TRIPS, DAY, fill, keys, layer, payment, trip


def ingest(spark, lake, entity=TRIPS, **options):
    start_ingest(spark, lake, entity, **options).awaitTermination()


def silver(spark, lake, entity=TRIPS, **options):
    start_silver(spark, lake, entity, **options).awaitTermination()


def test_each_file_lands_once(spark, lake):
    fill(lake)
    ingest(spark, lake)
    ingest(spark, lake)
    assert layer(spark, lake, TRIPS, "bronze").count() == 11
    write_lines(lake, "trips", DAY, [trip(50)], name="more.jsonl")
    write_lines(lake, "trips", "2026-03-22", [trip(51)])
    ingest(spark, lake)
    bronze = layer(spark, lake, TRIPS, "bronze")
    assert tuples(bronze.groupBy("ingest_date", "_batch_id", "_source").count()) == [
        (DAY, DAY, "simulator", 12),
        ("2026-03-22", "2026-03-22", "simulator", 1),
    ]
    assert bronze.filter(F.col("_ingested_at").isNull()).count() == 0


def test_stream_gives_the_batch_result(spark, lake, tmp_path):
    write_lines(lake, "trips", DAY, [trip(1), trip(1), trip(2), *BAD_TRIPS])
    write_lines(lake, "trips", "2026-03-22", [trip(3), trip(4, city=None), trip(5)])
    batch = Lake(root=str(tmp_path / "batch"), raw=lake.raw)
    run_range(spark, batch, DAY, 2, [TRIPS])
    ingest(spark, lake)
    silver(spark, lake)
    for name in ("silver", "quarantine"):
        assert keys(spark, lake, TRIPS, name) == keys(spark, batch, TRIPS, name)


def test_copies_in_later_micro_batches_are_dropped(spark, lake):
    write_lines(lake, "payments", DAY, [payment(1), payment(2)])
    ingest(spark, lake, PAYMENTS)
    silver(spark, lake, PAYMENTS)
    write_lines(lake, "payments", DAY, [payment(1), payment(3, final_amount_vnd=-1)], "b.jsonl")
    ingest(spark, lake, PAYMENTS)
    silver(spark, lake, PAYMENTS)
    assert tuples(layer(spark, lake, PAYMENTS, "silver"), "payment_id") == [
        ("PAY00000001",),
        ("PAY00000002",),
    ]
    assert tuples(layer(spark, lake, PAYMENTS, "quarantine"), "payment_id") == [("PAY00000003",)]
    parts = spark.read.parquet(lake.silver("payments")).select("_micro_batch").distinct()
    assert parts.count() == 1  # the second micro-batch had no valid row left


def deliver(spark, lake, lines, name, day=DAY, entity=PAYMENTS):
    write_lines(lake, entity.name, day, lines, name)
    ingest(spark, lake, entity)
    silver(spark, lake, entity)


def paid(number, clock, **changes):
    return payment(number, payment_time=f"{DAY}T{clock}" if clock else None, **changes)


def stored(spark, lake, name):
    return tuples(layer(spark, lake, PAYMENTS, name), "payment_id", "fare_vnd")


def test_a_newer_copy_in_a_later_micro_batch_takes_the_place_of_the_older(spark, lake):
    deliver(spark, lake, [paid(1, "08:00:00", fare_vnd=1), paid(2, "08:00:00", fare_vnd=2), paid(3, None, fare_vnd=3)], "a.jsonl")
    deliver(spark, lake, [paid(1, "09:00:00", fare_vnd=10, final_amount_vnd=-5), paid(2, "07:00:00", fare_vnd=20), paid(3, "01:00:00", fare_vnd=30)], "b.jsonl")
    assert stored(spark, lake, "silver") == [("PAY00000002", 2), ("PAY00000003", 30)]
    assert stored(spark, lake, "quarantine") == [("PAY00000001", 10)]
    deliver(spark, lake, [paid(1, "10:00:00", fare_vnd=100), paid(4, "10:00:00", fare_vnd=4)], "c.jsonl")
    assert stored(spark, lake, "silver") == [("PAY00000001", 100), ("PAY00000002", 2), ("PAY00000003", 30), ("PAY00000004", 4)]
    assert stored(spark, lake, "quarantine") == []
    parts = {int(r[0]) for r in spark.read.parquet(lake.silver("payments")).select("_micro_batch").distinct().collect()}
    assert parts == {0, 1, 2} and not exists(spark, f"{lake.staging('payments')}/stream/batch=2")


def test_copies_over_many_micro_batches_end_as_the_batch_job_does(spark, lake, tmp_path):
    import random

    rng = random.Random(11)
    days = [DAY, "2026-03-22", "2026-03-23"]
    for part in range(9):
        for day in days:
            lines = [
                payment(rng.randrange(25), payment_time=rng.choice([None, f"{day}T0{rng.randrange(8)}:00:00"]), fare_vnd=rng.randrange(50),
                        final_amount_vnd=rng.choice([-1, 5, None, 9]))
                for _ in range(12)
            ] + ["{broken"]
            write_lines(lake, "payments", day, lines, f"part-{part}.jsonl")
    batch = Lake(root=str(tmp_path / "batch"), raw=lake.raw)
    run_range(spark, batch, DAY, 3, [PAYMENTS])
    ingest(spark, lake, PAYMENTS, files_per_batch=4)
    silver(spark, lake, PAYMENTS, files_per_batch=3)
    columns = ["ingest_date", *PAYMENTS.schema.names]
    for name in ("silver", "quarantine"):
        ours, theirs = (tuples(layer(spark, where, PAYMENTS, name), *columns) for where in (lake, batch))
        assert ours == theirs and ours


def test_a_crash_between_two_writes_of_a_correction_is_mended(spark, lake, monkeypatch):
    """The job ends at each of its writes in turn; the next start has the same outcome as an undisturbed one."""
    first = [paid(1, "08:00:00", fare_vnd=1), paid(2, "08:00:00", fare_vnd=2), paid(5, "08:00:00", fare_vnd=5)]
    second = [paid(1, "09:00:00", fare_vnd=10), paid(2, "09:00:00", final_amount_vnd=-1, fare_vnd=20)]
    steps = ["replace_micro_batch", "withdraw_rows"]
    for number, (step, after) in enumerate((s, n) for s in steps for n in (0, 1)):
        here = Lake(root=f"{lake.root}-{number}", raw=f"{lake.raw}-{number}")
        deliver(spark, here, first, "a.jsonl")
        write_lines(here, "payments", DAY, second, "b.jsonl")
        ingest(spark, here, PAYMENTS)
        real, calls = getattr(jobs, step), []

        def failing(*args, real=real, calls=calls, after=after):
            if len(calls) == after:
                raise RuntimeError("executor room on fire")
            calls.append(real(*args))
            return calls[-1]

        with monkeypatch.context() as patched:
            patched.setattr(jobs, step, failing)
            try:
                silver(spark, here, PAYMENTS)
            except Exception as error:
                assert "on fire" in str(error)
        silver(spark, here, PAYMENTS)
        assert stored(spark, here, "silver") == [("PAY00000001", 10), ("PAY00000005", 5)]
        assert stored(spark, here, "quarantine") == [("PAY00000002", 20)]


def test_a_part_deleted_by_a_crash_comes_back_from_what_was_written_down(spark, lake, monkeypatch):
    """The worst moment: the old part is gone and the new one is not there yet."""
    deliver(spark, lake, [paid(1, "08:00:00", fare_vnd=1), paid(2, "08:00:00", fare_vnd=2)], "a.jsonl")
    write_lines(lake, "payments", DAY, [paid(1, "09:00:00", fare_vnd=10)], "b.jsonl")
    ingest(spark, lake, PAYMENTS)
    path = lake.silver("payments")

    def crash(spark, path):
        raise RuntimeError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "delete", crash)  # what was written down stays, the micro-batch is not committed
        try:
            silver(spark, lake, PAYMENTS)
        except Exception as error:
            assert "gone" in str(error)
    tables.delete(spark, f"{path}/ingest_date={DAY}/_micro_batch=0")
    silver(spark, lake, PAYMENTS)
    assert stored(spark, lake, "silver") == [("PAY00000001", 10), ("PAY00000002", 2)]


def test_closed_days_are_cleansed_whole_and_open_days_by_the_state(spark, lake):
    from datetime import date, timedelta

    today, old = date.today().isoformat(), (date.today() - timedelta(days=40)).isoformat()
    for turn, amount in enumerate((5, -5)):
        for day in (today, old):
            lines = [payment(1, payment_time=f"{day}T0{turn}:00:00", final_amount_vnd=amount), payment(10 + turn, payment_time=f"{day}T00:00:00")]
            write_lines(lake, "payments", day, lines, f"{turn}.jsonl")
        ingest(spark, lake, PAYMENTS)
        silver(spark, lake, PAYMENTS, keep_days=7)
        start_closed_days(spark, lake, PAYMENTS, keep_days=7).awaitTermination()
    for day in (today, old):
        for name, want in (("silver", ["PAY00000010", "PAY00000011"]), ("quarantine", ["PAY00000001"])):
            found = layer(spark, lake, PAYMENTS, name).filter(F.col("ingest_date") == day)
            assert [k for (k,) in tuples(found, "payment_id")] == want


def test_the_survivor_of_an_aggregate_is_that_of_the_window(spark):
    rows = spark.sql(
        """SELECT id % 7 AS k, CASE WHEN id % 5 > 0 THEN timestamp_seconds(id * 7919 % 13) END AS t,
        CASE WHEN id % 3 > 0 THEN string(id * 31 % 17) END AS a, CASE WHEN id % 4 > 0 THEN id * 17 % 11 / 4 END AS b, id AS c
        FROM range(400)"""
    )
    for newest in ("t", "b", None):
        want = dedupe(rows, "k", newest=newest)
        best = rows.groupBy("k").agg(survivor(rows, ["k"], newest).alias("best"))
        assert tuples(best.select(*unpacked(best, "best", rows, ["k"], newest))) == tuples(want)


def test_hot_key_over_many_files(spark, lake):
    """A third of the rows are copies of one payment, spread over all files and micro-batches."""
    for part in range(12):
        lines = [
            payment(0 if n % 3 == 0 else 1 + part * 100 + n, fare_vnd=part * 100 + n)
            for n in range(90)
        ]
        write_lines(lake, "payments", DAY, lines, f"part-{part}.jsonl")
    ingest(spark, lake, PAYMENTS, files_per_batch=5)
    silver(spark, lake, PAYMENTS, files_per_batch=4)
    rows = layer(spark, lake, PAYMENTS, "silver")
    assert rows.count() == rows.select("payment_id").distinct().count() == 12 * 60 + 1


def test_a_replayed_micro_batch_leaves_one_result(spark, lake, tmp_path):
    """The same micro-batch written again, as after a lost commit, replaces its first result."""
    fill(lake)
    ingest(spark, lake)
    silver(spark, lake)
    before = [keys(spark, lake, TRIPS, name) for name in ("silver", "quarantine")]
    commits = tmp_path / "lake" / "_checkpoints" / "silver-trips" / "commits"
    for commit in [*commits.glob("[0-9]*"), *commits.glob(".[0-9]*.crc")]:
        commit.unlink()
    silver(spark, lake)
    assert [keys(spark, lake, TRIPS, name) for name in ("silver", "quarantine")] == before


def test_demand_closes_windows_behind_the_watermark(spark, lake):
    def at(number, clock):
        return trip(number, request_time=f"{DAY}T{clock}")

    write_lines(lake, "trips", DAY, [at(1, "08:00:00"), at(2, "08:14:59"), at(3, "08:15:00")])
    ingest(spark, lake)
    start_demand(spark, lake, delay="10 minutes").awaitTermination()
    write_lines(lake, "trips", DAY, [at(4, "09:00:00")], "b.jsonl")
    ingest(spark, lake)
    start_demand(spark, lake, delay="10 minutes").awaitTermination()
    # Too late by now: its window has been written.
    write_lines(lake, "trips", DAY, [at(5, "08:01:00")], "c.jsonl")
    ingest(spark, lake)
    start_demand(spark, lake, delay="10 minutes").awaitTermination()
    counted = spark.read.parquet(f"{lake.root}/demand")
    assert tuples(counted, "batch_id", "city", "status", "n") == [
        ("20260321_0800", "HCMC", "completed", 2),
        ("20260321_0815", "HCMC", "completed", 1),
    ]


def test_stream_tables_read_like_batch_tables(spark, lake):
    fill(lake)
    ingest(spark, lake)
    silver(spark, lake)
    rows = read_table(spark, lake.silver("trips"), TRIPS.silver_schema)
    assert set(TRIPS.silver_schema.names) <= set(rows.columns)
    assert dict(rows.dtypes)["ingest_date"] == "string"


def test_a_key_on_two_days_and_another_format(spark, tmp_path):
    from millrace.plans import reconcile_layers
    from millrace.sources import read_table_day

    lake = Lake(root=str(tmp_path / "lake"), raw=str(tmp_path / "raw"), fmt="orc")
    for day in (DAY, "2026-03-22"):
        write_lines(lake, "trips", day, [trip(1), trip(2), "{broken"])
    ingest(spark, lake)
    silver(spark, lake)
    assert read_table(spark, lake.silver("trips"), TRIPS.silver_schema, "orc").count() == 4
    assert read_table(spark, lake.quarantine("trips"), TRIPS.quarantine_schema, "orc").count() == 2
    assert reconcile_layers(spark, lake, TRIPS).count() == 0
    assert read_table_day(spark, lake.silver("trips"), TRIPS.silver_schema, DAY, "orc").count() == 2


def test_rows_that_tie_in_time_are_settled_by_all_columns_over_micro_batches(spark, lake, tmp_path):
    """Copies as new as those sent out, equal or not, with and without a time, a key, a fare."""
    first = [paid(1, "08:00:00", fare_vnd=5), paid(2, "08:00:00", fare_vnd=5), paid(3, None, fare_vnd=5), paid(4, "08:00:00", fare_vnd=None), "{broken"]
    second = [paid(1, "08:00:00", fare_vnd=4), paid(2, "08:00:00", fare_vnd=6), paid(3, None, fare_vnd=None), paid(4, "08:00:00", fare_vnd=9), "{broken"]
    for name, lines in (("a.jsonl", first), ("b.jsonl", second), ("c.jsonl", first + second)):
        deliver(spark, lake, lines, name)
    batch = Lake(root=str(tmp_path / "batch"), raw=lake.raw)
    run_range(spark, batch, DAY, 1, [PAYMENTS])
    for name in ("silver", "quarantine"):
        ours, theirs = (tuples(layer(spark, where, PAYMENTS, name), "ingest_date", *PAYMENTS.schema.names) for where in (lake, batch))
        assert ours == theirs and ours
    parts = spark.read.parquet(lake.silver("payments")).groupBy("_micro_batch").count()
    assert {int(n): rows for n, rows in tuples(parts)} == {0: 2, 1: 2}  # of rows that are equal the one sent stays


def test_the_tables_are_all_that_the_stream_knows(spark, lake):
    """No state beside the tables; copies meet them in an adaptive session, so a day gets a file and not one per task."""
    deliver(spark, lake, [paid(n, "08:00:00", fare_vnd=n) for n in range(200)], "a.jsonl")
    deliver(spark, lake, [paid(n, "09:00:00", fare_vnd=n) for n in range(0, 400, 2)], "b.jsonl")
    assert not exists(spark, f"{lake.checkpoint('silver-payments')}/state")
    table = spark.read.parquet(lake.silver("payments"))
    assert table.count() == 300 and len(table.inputFiles()) == 2
    assert tuples(table.groupBy(F.col("_micro_batch").cast("int").alias("n")).count()) == [(0, 100), (1, 200)]


def test_many_withdrawn_keys_meet_the_rows_in_a_join(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "FEW_KEYS", 0)
    deliver(spark, lake, [paid(n, "08:00:00", fare_vnd=n) for n in range(9)], "a.jsonl")
    deliver(spark, lake, [paid(n, "09:00:00", fare_vnd=-n) for n in range(4)], "b.jsonl")
    assert stored(spark, lake, "silver") == [(f"PAY{n:08d}", -n if n < 4 else n) for n in range(9)]


def test_rows_without_a_day_are_read_by_their_folder(spark, tmp_path):
    from millrace.sources import read_table_days

    rows = spark.sql("SELECT * FROM VALUES (1, '2026-03-21'), (2, NULL), (3, '2026-03-22') AS t(id, ingest_date)")
    rows.write.partitionBy("ingest_date").parquet(str(tmp_path / "t"))
    found = read_table_days(spark, str(tmp_path / "t"), rows.schema, [None, DAY, "2026-03-29"])
    assert tuples(found) == [(1, DAY), (2, None)] and len(found.inputFiles()) == 2
    assert read_table_days(spark, str(tmp_path / "none"), rows.schema, [DAY]).count() == 0
