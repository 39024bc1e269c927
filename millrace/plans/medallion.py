"""The daily jobs: raw to Bronze, Bronze to Silver and quarantine, one day or a range."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.entities import DEFAULT_SOURCE, ENTITIES, RUNS_SCHEMA, Entity
from millrace.files import delete
from millrace.lake import Lake, checked_day, day_path, day_range
from millrace.operators.dedupe import dedupe, dedupe_in_place
from millrace.operators.quality import PASSES, invalid_rows, judge, valid_rows
from millrace.operators.stamps import with_audit, with_quarantine_reason, with_silver_stamp
from millrace.sinks.runlog import days_done, log_run, log_runs
from millrace.sinks.tables import COMPRESSION, append_partitioned, replace_day, replace_days
from millrace.session import brief_shuffles, size_shuffles, small_sorts
from millrace.sources.jsonl import BAD_LINE, RAW_DAY, is_broken, is_damaged, raw_days, read_days, read_jsonl
from millrace.sources.tables import LOG_FORMATS, read_table, read_table_day

REPLACE, APPEND = "replace", "append"
#: Days of a backfill that go through the layers together; what a run that breaks off has to do again at most.
DAYS_PER_PASS = 90


@dataclass(frozen=True)
class IngestCounts:
    """Lines read, and rows written; of the lines, those that are no JSON object, and those with fields of another type."""

    read: int
    written: int
    broken: int = field(default=0, compare=False, repr=False)
    damaged: int = field(default=0, compare=False, repr=False)

    @property
    def dropped(self) -> int:
        return self.read - self.written


@dataclass(frozen=True)
class CleanseCounts:
    evaluated: int
    valid: int

    @property
    def quarantined(self) -> int:
        return self.evaluated - self.valid


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _checked_mode(mode: str) -> str:
    if mode not in (REPLACE, APPEND):
        raise ValueError(f"mode must be {REPLACE!r} or {APPEND!r}, not {mode!r}")
    return mode


def ingest(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    day: str,
    mode: str = REPLACE,
    source: str = DEFAULT_SOURCE,
    validate: Callable[[DataFrame], DataFrame] | None = None,
) -> IngestCounts:
    """Land one raw day in Bronze as it is, bad rows included, or what ``validate`` leaves of it.

    Rows are counted as they are read and as they are written, by the write itself, and so are the
    lines that could not be read; their texts go to ``lake.bad_lines``. A missing raw day raises
    PATH_NOT_FOUND, a folder without a file FileNotFoundError; the tables stay.
    """
    folder = day_path(lake.raw, entity.name, day)
    raw = read_jsonl(spark, folder, entity.schema, bad_lines=True)
    if not raw.inputFiles():
        raise FileNotFoundError(f"no raw file in {folder}")
    if _checked_mode(mode) == APPEND and raw.isEmpty():
        return IngestCounts(read=0, written=0)
    found, kept = Observation(), Observation()
    names = entity.schema.names
    read = raw.observe(
        found,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_broken(names)).alias("broken"),
        F.count_if(is_damaged(names)).alias("damaged"),
    ).drop(BAD_LINE)
    checked = validate(read) if validate else read
    rows = with_audit(checked, day, source, at=_now())
    rows = rows.observe(kept, F.count(F.lit(1)).alias("rows"))
    if mode == APPEND:
        rows.write.format(lake.fmt).mode("append").partitionBy("ingest_date").save(
            lake.bronze(entity.name)
        )
    else:
        replace_day(rows, lake.bronze(entity.name), day, lake.fmt)
    seen = found.get
    if seen["broken"] or seen["damaged"]:
        replace_day(bad_lines(raw, names, F.lit(day)), lake.bad_lines(entity.name), day, lake.fmt)
    elif lake.fmt not in LOG_FORMATS:
        delete(spark, f"{lake.bad_lines(entity.name)}/ingest_date={checked_day(day)}")  # those of an earlier try
    return IngestCounts(seen["rows"], kept.get["rows"], seen["broken"], seen["damaged"])


def bad_lines(raw: DataFrame, columns: list[str], day: Column) -> DataFrame:
    """The texts of lines that could not be read as they should: ingest_date, fault, line."""
    fault = F.when(is_broken(columns), "broken").otherwise("damaged")
    return raw.filter(F.col(BAD_LINE).isNotNull()).select(
        day.alias("ingest_date"), fault.alias("fault"), F.col(BAD_LINE).alias("line")
    )


def line_counts(spark: SparkSession, lake: Lake, entity: Entity) -> DataFrame:
    """Raw lines per day, and how many of them are broken or damaged, in one scan of all days."""
    raw = read_days(spark, lake.raw_entity(entity.name), entity.schema, bad_lines=True)
    names = entity.schema.names
    return raw.groupBy(F.col(RAW_DAY).alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(is_broken(names)).alias("broken"),
        F.count_if(is_damaged(names)).alias("damaged"),
    )


def checked_rows(bronze: DataFrame, entity: Entity, per_day: bool = False) -> DataFrame:
    """One row per key with its verdict. Copies on different days are no copies; rows of many days stay where they are
    unless their key may come again."""
    if per_day:
        best = dedupe_in_place(bronze, ["ingest_date", entity.key], newest=entity.newest)
    else:
        best = dedupe(bronze, entity.key, newest=entity.newest)
    return judge(best, entity.rules)


def cleanse(
    spark: SparkSession, lake: Lake, entity: Entity, day: str, mode: str = REPLACE
) -> CleanseCounts:
    """Split one Bronze day into Silver and quarantine.

    The scan, dedupe and rules run once, for both writes and the counts. Should cached blocks
    get lost with an executor, Spark computes the same rows again, as the dedupe has one outcome.
    """
    bronze = read_table_day(
        spark, lake.bronze(entity.name), entity.bronze_schema, day, lake.fmt
    )
    if lake.fmt not in LOG_FORMATS and not bronze.inputFiles():
        return CleanseCounts(evaluated=0, valid=0)  # never ingested: nothing to replace Silver by
    judged = checked_rows(bronze, entity).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        counted = Observation()
        observed = judged.observe(
            counted,
            F.count(F.lit(1)).alias("evaluated"),
            F.count_if(F.col(PASSES)).alias("valid"),
        )
        at = _now()
        valid = with_silver_stamp(valid_rows(observed), at)
        # Few rows out of every partition: brought together, or each would become a tiny file.
        invalid = with_quarantine_reason(
            with_silver_stamp(invalid_rows(judged).hint("rebalance"), at)
        )
        if _checked_mode(mode) == APPEND:
            append_partitioned(valid, lake.silver(entity.name), lake.fmt)
            append_partitioned(invalid, lake.quarantine(entity.name), lake.fmt)
            row = judged.agg(
                F.count(F.lit(1)).alias("evaluated"),
                F.count_if(F.col(PASSES)).alias("valid"),
            ).first()
            return CleanseCounts(evaluated=row["evaluated"], valid=row["valid"])
        replace_day(valid, lake.silver(entity.name), day, lake.fmt)
        replace_day(invalid, lake.quarantine(entity.name), day, lake.fmt)
        return CleanseCounts(
            evaluated=counted.get["evaluated"], valid=counted.get["valid"]
        )
    finally:
        judged.unpersist()


def _for_each(spark: SparkSession, entities: Iterable[Entity], work: Callable) -> dict:
    """``work(entity)`` for all entities side by side; one that fails does not stop the others."""
    entities = list(entities)
    with ThreadPoolExecutor(max_workers=len(entities)) as pool:
        started = {
            entity.name: pool.submit(inheritable_thread_target(spark)(work), entity)
            for entity in entities
        }
    return {name: future.result() for name, future in started.items()}


@contextmanager
def _logged(spark: SparkSession, lake: Lake, target: str, job: str):
    """Log the run as it ended: ``success``, the status that the job set, or ``failed`` when it raised.

    The job's own error is raised even if its log entry can't be written.
    """
    run = {"status": "success"}
    try:
        yield run
    except Exception as error:
        try:
            log_run(spark, lake.runs, target, job, "failed", lake.fmt)
        except Exception as unlogged:  # noqa: BLE001 - the first error is the one to report
            error.add_note(f"the run could not be logged: {unlogged}")
        raise
    log_run(spark, lake.runs, target, job, run["status"], lake.fmt)


def run_day(
    spark: SparkSession,
    lake: Lake,
    day: str,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    mode: str = REPLACE,
    job: str = "medallion_daily",
) -> dict[str, tuple[IngestCounts, CleanseCounts]]:
    """Bronze, then Silver, for every entity; entities do not wait for each other."""

    def both(entity: Entity):
        return ingest(spark, lake, entity, day, mode), cleanse(spark, lake, entity, day, mode)

    entities = list(entities)
    with _logged(spark, lake, day, job):
        size_shuffles(spark, *(day_path(lake.raw, e.name, day) for e in entities))
        return _for_each(spark, entities, both)


def backfill_entity(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    days: list[str],
    source: str = DEFAULT_SOURCE,
    validate: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Load a range of days in one pass per layer, each day as if run alone.

    Returns the days without a raw file; their tables stay as they are. If no day has one, that
    raises FileNotFoundError. The judged rows are written to shared storage once, in a folder of this
    run, and both tables are made from there, so the range needs no cache, a lost executor costs its
    tasks only and runs side by side do not meet.
    """
    root = lake.raw_entity(entity.name)
    present = raw_days(spark, root, days)
    missing = sorted(set(days) - set(present))
    if not present:
        raise FileNotFoundError(f"no raw file in {root} from {days[0]} to {days[-1]}")
    raw = read_days(spark, root, entity.schema, present[0], present[-1])
    raw = raw.filter(F.col(RAW_DAY).isin(present))
    at = _now()
    checked = validate(raw) if validate else raw
    landed = with_audit(checked, F.col(RAW_DAY), source, at).drop(RAW_DAY)
    # Raw splits lie within a day, so the Bronze write needs no shuffle to keep files few.
    replace_days(spark, landed, lake.bronze(entity.name), present, lake.fmt, gather=False)

    bronze = read_table(spark, lake.bronze(entity.name), entity.bronze_schema, lake.fmt).filter(
        F.col("ingest_date").isin(present)
    )
    best, staged = checked_rows(bronze, entity, per_day=True), f"{lake.staging(entity.name)}/range-{uuid.uuid4().hex}"
    try:
        with small_sorts(spark), brief_shuffles(spark):
            best.write.option("compression", COMPRESSION).parquet(staged)
        judged = spark.read.schema(best.schema).parquet(staged)
        valid = with_silver_stamp(valid_rows(judged), at)
        invalid = with_quarantine_reason(with_silver_stamp(invalid_rows(judged), at))
        replace_days(spark, valid, lake.silver(entity.name), present, lake.fmt)
        replace_days(spark, invalid, lake.quarantine(entity.name), present, lake.fmt)
    finally:
        delete(spark, staged)
    return missing


def range_counts(spark: SparkSession, lake: Lake, entity: Entity, days: list[str]) -> DataFrame:
    """Rows per layer for every day of the range, zero where a day has none.

    The counts need only partition values and file footers.
    """
    layers = {
        "bronze_rows": (lake.bronze(entity.name), entity.bronze_schema),
        "valid_rows": (lake.silver(entity.name), entity.silver_schema),
        "quarantine_rows": (lake.quarantine(entity.name), entity.quarantine_schema),
    }
    tallies = None
    for name, (path, schema) in layers.items():
        table = read_table(spark, path, schema, lake.fmt, missing_ok=True)
        here = table.filter(F.col("ingest_date").between(days[0], days[-1])).select(
            "ingest_date", *[F.lit(int(name == layer)).alias(layer) for layer in layers]
        )
        tallies = here if tallies is None else tallies.unionByName(here)
    first, last = (F.to_date(F.lit(day)) for day in (days[0], days[-1]))
    calendar = spark.range(1).select(F.explode(F.sequence(first, last)).alias("day")).select(
        F.col("day").cast("string").alias("ingest_date"),
        *[F.lit(0).alias(layer) for layer in layers],
    )
    return (
        tallies.unionByName(calendar)
        .groupBy("ingest_date")
        .agg(*[F.sum(layer).alias(layer) for layer in layers])
        .withColumn("entity", F.lit(entity.name))
    )


def run_range(
    spark: SparkSession,
    lake: Lake,
    start: str,
    n_days: int,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    job: str = "medallion_backfill",
    days_per_pass: int = DAYS_PER_PASS,
    resume: bool = True,
    validate: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Backfill ``n_days`` days from ``start``; returns the rows per entity, day and layer.

    Days without a raw file keep the tables they have, and the run is logged as ``incomplete``. The days
    that have one go through in passes of ``days_per_pass``, and the entity's log of days gets a row for each
    day of a finished pass. If a run breaks off, the next one of the same range and job leaves those days out, unless
    ``resume`` is off; a range that came to its end is done anew as a whole.
    """
    days = day_range(start, n_days)
    if not days:
        raise ValueError("a backfill needs at least one day")
    target = f"{days[0]}/{days[-1]}"
    entities = list(entities)

    def load(entity: Entity) -> tuple[list[str], DataFrame]:
        root = lake.raw_entity(entity.name)
        present = raw_days(spark, root, days)
        if not present:
            raise FileNotFoundError(f"no raw file in {root} from {days[0]} to {days[-1]}")
        done = set()
        if resume:
            runs, passed = (read_table(spark, path, RUNS_SCHEMA, lake.fmt, missing_ok=True) for path in (lake.runs, lake.day_runs(entity.name)))
            done = {row["target_date"] for row in days_done(runs, passed, target, job).collect()}  # days of the range
        left = [day for day in present if day not in done]
        for at in range(0, len(left), days_per_pass):
            some = left[at : at + days_per_pass]
            backfill_entity(spark, lake, entity, some, validate=validate)
            log_runs(spark, lake.day_runs(entity.name), some, job, "success", lake.fmt)
        return sorted(set(days) - set(present)), range_counts(spark, lake, entity, days)

    with _logged(spark, lake, target, job) as run:
        size_shuffles(spark, *(lake.raw_entity(e.name) for e in entities))
        loaded = _for_each(spark, entities, load)
        if any(missing for missing, _ in loaded.values()):
            run["status"] = "incomplete"
    counts = {name: table for name, (_, table) in loaded.items()}
    return reduce(DataFrame.unionByName, counts.values())
