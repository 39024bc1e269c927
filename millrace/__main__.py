"""Command line of the jobs: ``python -m millrace run --lake URI --raw URI --day 2026-03-21``.

Cluster, storage access and memory are given to ``spark-submit``; a failed job exits with 1.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from millrace.entities import ENTITIES, RUNS_SCHEMA, Entity
from millrace.lake import Lake, day_path
from millrace.plans import (
    cleanse,
    ingest,
    reconcile_digests,
    reconcile_layers,
    reconcile_raw,
    reconcile_raw_rows,
    run_day,
    run_range,
)
from millrace.session import build_session, size_shuffles
from millrace.sources import latest_runs, read_table
from millrace.streaming import (
    compact_stream,
    demand_with_late,
    start_closed_days,
    start_demand,
    start_demand_late,
    start_ingest,
    start_silver,
    vacuum_stream,
)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    top.add_argument("--lake", required=True, help="root of the tables")
    top.add_argument("--raw", required=True, help="root of the raw lines")
    top.add_argument("--format", default="parquet", help="table format")
    top.add_argument("--entity", action="append", choices=sorted(ENTITIES), help="default: all")
    top.add_argument("--master", default=None)
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("ingest", "cleanse", "run"):
        job = jobs.add_parser(name)
        job.add_argument("--day", required=True)
        job.add_argument("--mode", default="replace", choices=("replace", "append"))
    backfill = jobs.add_parser("backfill")
    backfill.add_argument("--start", required=True)
    backfill.add_argument("--days", type=int, required=True)
    reconcile = jobs.add_parser("reconcile")
    reconcile.add_argument("--day", help="show the keys behind one day's difference")
    reconcile.add_argument("--keys", action="store_true", help="count the keys that differ on every day, by digests")
    stream = jobs.add_parser("stream")
    stream.add_argument("--files-per-batch", type=int, help="most new files of a micro-batch")
    stream.add_argument("--keep-days", type=int, help="days back from today whose new rows meet those sent out; older ones are cleansed whole")
    stream.add_argument("--keep-late", action="store_true", help="also count the trips that come late and keep their rows")
    compact = jobs.add_parser("compact")
    compact.add_argument("--day", action="append", help="default: all days")
    compact.add_argument("--vacuum", action="store_true", help="delete the folders that earlier compactions have replaced, too")
    jobs.add_parser("runs")
    return top


def execute(spark, args) -> None:
    lake = Lake(root=args.lake, raw=args.raw, fmt=args.format)
    entities = [ENTITIES[name] for name in args.entity or ENTITIES]
    if args.job in ("ingest", "cleanse"):
        job = {"ingest": ingest, "cleanse": cleanse}[args.job]
        for entity in entities:
            day_folder = {"ingest": day_path(lake.raw, entity.name, args.day), "cleanse": f"{lake.bronze(entity.name)}/ingest_date={args.day}"}
            size_shuffles(spark, day_folder[args.job])
            counts = job(spark, lake, entity, args.day, args.mode)
            print(entity.name, counts)
            show_bad_lines(lake, entity.name, counts)
    elif args.job == "run":
        for name, counts in run_day(spark, lake, args.day, entities, args.mode).items():
            print(name, *counts)
            show_bad_lines(lake, name, counts[0])
    elif args.job == "backfill":
        totals = run_range(spark, lake, args.start, args.days, entities)
        totals.groupBy("entity").sum("bronze_rows", "valid_rows", "quarantine_rows").show()
    elif args.job == "reconcile":
        for entity in entities:
            show_differences(spark, lake, entity, args.day, args.keys)
    elif args.job == "stream":
        size_shuffles(spark, *(lake.raw_entity(entity.name) for entity in entities))
        for entity in entities:
            start_ingest(spark, lake, entity, files_per_batch=args.files_per_batch).awaitTermination()
            start_silver(spark, lake, entity, args.keep_days, args.files_per_batch).awaitTermination()
            if args.keep_days is not None:
                start_closed_days(spark, lake, entity, args.keep_days, args.files_per_batch).awaitTermination()
        if ENTITIES["trips"] in entities:
            start_demand(spark, lake, files_per_batch=args.files_per_batch).awaitTermination()
            if args.keep_late:
                start_demand_late(spark, lake, files_per_batch=args.files_per_batch).awaitTermination()
                demand_with_late(spark, lake).agg(F.sum("n_on_time").alias("on time"), F.sum("n_late").alias("late")).show()
    elif args.job == "compact":
        for entity in entities:
            if args.vacuum:  # of what earlier calls have replaced; readers may still be at what this one replaces
                print(f"{entity.name}: {vacuum_stream(spark, lake, entity)} folders deleted")
            for name, days in compact_stream(spark, lake, entity, args.day).items():
                print(f"{entity.name}, {name}: {len(days)} days compacted")
    else:
        runs = read_table(spark, lake.runs, RUNS_SCHEMA, lake.fmt, missing_ok=True)
        latest_runs(runs).show(truncate=False)


def show_bad_lines(lake: Lake, name: str, counts) -> None:
    broken, damaged = getattr(counts, "broken", 0), getattr(counts, "damaged", 0)
    if broken or damaged:
        print(f"{name}: {broken} broken and {damaged} damaged lines, kept in {lake.bad_lines(name)}")


def show_differences(spark, lake: Lake, entity: Entity, day: str | None, keys: bool = False) -> None:
    size_shuffles(spark, lake.raw_entity(entity.name), lake.bronze(entity.name))
    if keys:
        print(f"{entity.name}: keys that raw or Bronze lacks")
        found = reconcile_digests(spark, lake, entity)
        lacking = [F.count_if(F.col(c) == 0).alias(name) for c, name in (("stored_rows", "not in Bronze"), ("raw_rows", "not in raw"))]
        found.groupBy("ingest_date").agg(*lacking).orderBy("ingest_date").show(10_000, truncate=False)
        return
    if day:
        found = reconcile_raw_rows(spark, lake, entity, day)
        counts = found.counts().first()
        sides = (("not in Bronze", "lost", found.lost_rows), ("not in raw", "extra", found.extra_rows))
        for side, name, rows in sides:
            print(f"{entity.name}: {counts[name]} keys {side}; the first rows with a key:")
            rows.show(truncate=False)
        return
    layers = {
        "raw and Bronze": reconcile_raw(spark, lake, entity),
        "Bronze and Silver with quarantine": reconcile_layers(spark, lake, entity),
    }
    for name, days in layers.items():
        print(f"{entity.name}: days on which {name} differ")
        found = 0
        for found, row in enumerate(days.orderBy("ingest_date").toLocalIterator(), 1):
            print("  ", *row)
        print(f"{entity.name}: {found} days differ" if found else f"{entity.name}: all days match")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"millrace-{args.job}", master=args.master)
    try:
        execute(spark, args)
    except Exception as error:  # noqa: BLE001 - any failure must reach the caller's exit code
        print(f"{args.job} failed: {error}", file=sys.stderr)
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
