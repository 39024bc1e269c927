from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import tuples, write_lines
from millrace.__main__ import execute, parser
from millrace.entities import PAYMENTS
from millrace.files import folders
from millrace.sources import read_table, read_table_day
from millrace.sources.generations import covered_days, generation
from millrace.streaming import compact_stream, compaction, jobs, start_closed_days, vacuum, vacuum_stream
from test_medallion import DAY, layer, payment
from test_streaming import deliver, ingest, paid, silver

NEXT = "2026-03-22"
COLUMNS = ["ingest_date", *PAYMENTS.schema.names]


def fill(spark, lake, turns=3):
    for turn in range(turns):
        write_lines(lake, "payments", NEXT, [paid(60 + turn, "08:00:00")], f"{turn}.jsonl")
        lines = [paid(1, f"0{turn}:00:00", fare_vnd=turn), paid(10 + turn, "08:00:00"), paid(30 + turn, "08:00:00", final_amount_vnd=-1)]
        deliver(spark, lake, lines, f"{turn}.jsonl")


def rows(spark, lake, name="silver"):
    return tuples(layer(spark, lake, PAYMENTS, name), *COLUMNS)


def parts(spark, lake, name="silver", day=DAY):
    path = {"silver": lake.silver, "quarantine": lake.quarantine}[name]("payments")
    return folders(spark, f"{path}/ingest_date={day}")


def test_a_compacted_day_has_the_same_rows_in_one_folder(spark, lake):
    fill(spark, lake)
    before = {name: rows(spark, lake, name) for name in ("silver", "quarantine")}
    files = len(spark.read.parquet(lake.silver("payments")).inputFiles())
    taken = compact_stream(spark, lake, PAYMENTS)
    assert taken == {"silver": [DAY, NEXT], "quarantine": [DAY]}
    table = read_table(spark, lake.silver("payments"), PAYMENTS.silver_schema)
    assert tuples(table.select(F.col("_micro_batch").cast("int")).distinct()) == [(generation(2),)]
    for name, wanted in before.items():
        assert rows(spark, lake, name) == wanted and wanted
    assert len(parts(spark, lake)) == 4  # readers that have begun go on
    assert vacuum_stream(spark, lake, PAYMENTS) == 9
    assert parts(spark, lake) == [f"_micro_batch={generation(2)}"]
    assert len(spark.read.parquet(lake.silver("payments")).inputFiles()) < files
    for name, wanted in before.items():
        assert rows(spark, lake, name) == wanted
    of_day = read_table_day(spark, lake.silver("payments"), PAYMENTS.silver_schema, NEXT)
    assert tuples(of_day, "payment_id") == [("PAY00000060",), ("PAY00000061",), ("PAY00000062",)]
    assert compact_stream(spark, lake, PAYMENTS) == {"silver": [], "quarantine": []}


def test_replaced_folders_are_not_opened(spark, lake):
    fill(spark, lake)
    compact_stream(spark, lake, PAYMENTS, days=[DAY])
    table = read_table(spark, lake.silver("payments"), PAYMENTS.silver_schema).filter(F.col("ingest_date") == DAY)
    partitions = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in partitions and "_micro_batch" in partitions
    opened = {r[0].rsplit("/", 2)[1] for r in table.select(F.input_file_name()).distinct().collect()}
    assert opened == {f"_micro_batch={generation(2)}"}
    assert covered_days(spark, lake.silver("payments")) == {DAY: 2}


@pytest.mark.parametrize("vacuumed", [False, True])
def test_the_stream_goes_on_after_a_compaction_and_corrects_it(spark, lake, vacuumed):
    fill(spark, lake)
    compact_stream(spark, lake, PAYMENTS)
    if vacuumed:
        vacuum_stream(spark, lake, PAYMENTS)
    deliver(spark, lake, [paid(1, "09:00:00", fare_vnd=99), paid(11, "09:00:00", final_amount_vnd=-7), paid(50, "09:00:00")], "late.jsonl")
    wanted = ["PAY00000001", "PAY00000010", "PAY00000012", "PAY00000050"]
    for _ in range(2):
        found = layer(spark, lake, PAYMENTS, "silver").filter(F.col("ingest_date") == DAY)
        assert [k for (k,) in tuples(found, "payment_id")] == wanted
        assert tuples(found.filter("payment_id = 'PAY00000001'"), "fare_vnd") == [(99,)]
        ids = [k for (k,) in tuples(layer(spark, lake, PAYMENTS, "quarantine"), "payment_id")]
        assert ids == ["PAY00000011", "PAY00000030", "PAY00000031", "PAY00000032"]
        compact_stream(spark, lake, PAYMENTS)  # a generation made from a generation and newer folders
        vacuum_stream(spark, lake, PAYMENTS)
    assert parts(spark, lake) == [f"_micro_batch={generation(3)}"]


@pytest.mark.parametrize("step", ["begin", "publish"])
def test_a_compaction_that_breaks_off_changes_no_result(spark, lake, monkeypatch, step):
    fill(spark, lake)
    before = rows(spark, lake)

    def broken(*args):
        raise RuntimeError("off")

    with monkeypatch.context() as patched:
        patched.setattr(compaction, step, broken)
        with pytest.raises(RuntimeError, match="off"):
            compact_stream(spark, lake, PAYMENTS)
    assert rows(spark, lake) == before
    assert vacuum(spark, lake.silver("payments")) == 0
    deliver(spark, lake, [paid(1, "09:30:00", fare_vnd=77)], "more.jsonl")
    compact_stream(spark, lake, PAYMENTS)
    vacuum_stream(spark, lake, PAYMENTS)
    found = rows(spark, lake)
    assert len(found) == len(before) and [r for r in found if "PAY00000001" in r] != [r for r in before if "PAY00000001" in r]
    assert parts(spark, lake) == [f"_micro_batch={generation(3)}"]


def test_nothing_is_compacted_while_a_micro_batch_is_unfinished(spark, lake, monkeypatch):
    assert compact_stream(spark, lake, PAYMENTS) == {"silver": [], "quarantine": []}
    fill(spark, lake, 2)
    write_lines(lake, "payments", DAY, [paid(1, "09:00:00", fare_vnd=10)], "b.jsonl")
    ingest(spark, lake, PAYMENTS)

    def crash(*args):
        raise RuntimeError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "withdraw_rows", crash)
        with pytest.raises(Exception, match="gone"):
            silver(spark, lake, PAYMENTS)
    with pytest.raises(RuntimeError, match="unfinished"):
        compact_stream(spark, lake, PAYMENTS)
    silver(spark, lake, PAYMENTS)
    before = rows(spark, lake)
    assert compact_stream(spark, lake, PAYMENTS)["silver"] == [DAY, NEXT] and rows(spark, lake) == before


def test_a_closed_day_replaces_its_generation(spark, lake):
    fill(spark, lake)  # days long past, kept by a state without bound
    compact_stream(spark, lake, PAYMENTS)
    vacuum_stream(spark, lake, PAYMENTS)
    before = rows(spark, lake)
    start_closed_days(spark, lake, PAYMENTS, keep_days=7).awaitTermination()
    assert rows(spark, lake) == before
    assert parts(spark, lake) == ["_micro_batch=-1"] and covered_days(spark, lake.silver("payments")) == {}


def test_command_line(spark, lake, capsys):
    fill(spark, lake)
    run = ["--lake", lake.root, "--raw", lake.raw, "--entity", "payments", "compact"]
    execute(spark, parser().parse_args([*run, "--day", DAY]))
    execute(spark, parser().parse_args([*run, "--vacuum"]))
    said = capsys.readouterr().out
    assert "payments, silver: 1 days compacted" in said and "payments: 6 folders deleted" in said
