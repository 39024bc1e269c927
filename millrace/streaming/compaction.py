"""Compaction of the tables that the Silver stream writes: a day's micro-batches become one folder of few files.

A compaction writes a new generation of a day beside the folders it is made from, and a pointer swaps them when it is
complete. The old folders stay until ``vacuum``, so readers that have begun go on. Both run between two runs of the
stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.entities import Entity
from millrace.files import delete, folders, matching
from millrace.lake import Lake, checked_day
from millrace.sinks.tables import COMPRESSION, DAY, MICRO_BATCH
from millrace.sources.generations import begin, covered_days, generation, is_visible, publish
from millrace.sources.tables import LOG_FORMATS


def micro_batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The micro-batch folders of each day, generations included, by folder names alone; rows without a day are left out."""
    found: dict[str, list[int]] = {}
    for name in matching(spark, f"{path}/{DAY}=*/{MICRO_BATCH}=*"):
        day, number = (part.split("=", 1)[1] for part in name.rsplit("/", 2)[1:])
        if not day.startswith("__"):
            found.setdefault(day, []).append(int(number))
    return found


def _counts(covered: Mapping[str, int], day: str, number: int) -> bool:
    through = covered.get(day)
    return number >= -1 if through is None else number > through or number == generation(through)


def compact_days(
    spark: SparkSession,
    path: str,
    schema: StructType,
    through: int,
    fmt: str = "parquet",
    days: Sequence[str] | None = None,
    least: int = 2,
) -> list[str]:
    """Write the micro-batches up to ``through`` of each day as one folder; the days that were compacted.

    A day is taken if at least ``least`` (2 or more) of its folders count; all days go in one job. AQE merges small
    and splits big days, so a day's files have the size of its tasks. Readers see a day's new folder when it is
    complete. If the job breaks off, days without a pointer are as they were and the next call writes them again.
    """
    covered = covered_days(spark, path) or {}
    wanted = None if days is None else {checked_day(day) for day in days}
    taken = []
    for day, numbers in sorted(micro_batches(spark, path).items()):
        of_day = [n for n in numbers if n <= through and _counts(covered, day, n)]
        if len(of_day) >= max(2, least) and (wanted is None or day in wanted):
            taken.append(day)
    if not taken:
        return []
    begin(spark, path)
    stored = StructType([*schema.fields, StructField(MICRO_BATCH, LongType(), True)])
    rows = spark.read.format(fmt).schema(stored).load(path)
    rows = rows.filter(F.col(DAY).isin(taken) & (F.col(MICRO_BATCH) <= through) & is_visible(covered))
    (
        rows.withColumn(MICRO_BATCH, F.lit(generation(through)).cast("long")).hint("rebalance", F.col(DAY))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(DAY, MICRO_BATCH)
        .save(path)
    )
    for day in taken:
        publish(spark, path, day, through)
    return taken


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders that a newer generation has taken the place of; their number. No reader may still use them."""
    covered = covered_days(spark, path) or {}
    gone = 0
    for day, numbers in micro_batches(spark, path).items():
        for number in numbers:
            if day in covered and not _counts(covered, day, number):
                delete(spark, f"{path}/{DAY}={day}/{MICRO_BATCH}={number}")
                gone += 1
    return gone


def last_commit(spark: SparkSession, lake: Lake, entity: Entity) -> int | None:
    """The last micro-batch that the Silver stream has ended."""
    commits = matching(spark, f"{lake.checkpoint(f'silver-{entity.name}')}/commits/*")
    numbers = [name.rsplit("/", 1)[1] for name in commits]
    return max((int(n) for n in numbers if n.isdigit()), default=None)


def _silver_tables(lake: Lake, entity: Entity):
    yield "silver", lake.silver(entity.name), entity.silver_schema
    yield "quarantine", lake.quarantine(entity.name), entity.quarantine_schema


def compact_stream(
    spark: SparkSession, lake: Lake, entity: Entity, days: Sequence[str] | None = None, least: int = 2
) -> dict[str, list[str]]:
    """Compact the Silver and quarantine tables of ``start_silver``; the days taken of each.

    Only ended micro-batches are taken. While one is unfinished nothing is, as its replay has still to find the folders
    it has begun to correct.
    """
    if lake.fmt in LOG_FORMATS:
        raise ValueError(f"{lake.fmt} tables have a compaction of their own")
    if folders(spark, f"{lake.staging(entity.name)}/stream"):
        raise RuntimeError(f"a micro-batch of {entity.name} is unfinished; run the stream first")
    through = last_commit(spark, lake, entity)
    if through is None:
        return {name: [] for name, _, _ in _silver_tables(lake, entity)}
    return {
        name: compact_days(spark, path, schema, through, lake.fmt, days, least)
        for name, path, schema in _silver_tables(lake, entity)
    }


def vacuum_stream(spark: SparkSession, lake: Lake, entity: Entity) -> int:
    return sum(vacuum(spark, path) for _, path, _ in _silver_tables(lake, entity))
