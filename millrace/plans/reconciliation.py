"""Reconciliation jobs: counts per day, and the rows behind a difference."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.entities import Entity
from millrace.functions.predicates import passes
from millrace.lake import Lake, day_path
from millrace.operators.dedupe import dedupe
from millrace.operators.digests import compare_keys_by_digest
from millrace.operators.reconcile import compare_counts, compare_keys
from millrace.sinks.tables import sample_rows
from millrace.sources.jsonl import RAW_DAY, read_days, read_jsonl
from millrace.sources.tables import read_table, read_table_day

Filter = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    return df


def recon_filter(entity: Entity, day_column: str | None = None) -> Filter:
    """One row per key that passes the entity's comparison rules, for ``df.transform``.

    With a day column, copies are looked for within a day, as when each day is compared alone.
    """
    key = [day_column, entity.key] if day_column else entity.key

    def comparable(df: DataFrame) -> DataFrame:
        return dedupe(df, key).filter(passes(entity.recon_rules))

    return comparable


def reconcile_counts(
    raw: DataFrame,
    stored: DataFrame,
    raw_filter: Filter = as_is,
    stored_filter: Filter = as_is,
    day_column: str = "ingest_date",
) -> DataFrame:
    """Days whose filtered row counts differ, for all days of both sides in one job.

    Which rows count is the caller's choice on each side: compared with a layer that keeps bad
    rows, raw must not be filtered either.
    """
    return compare_counts(
        raw.transform(raw_filter), stored.transform(stored_filter), day_column
    )


def reconcile_layers(spark: SparkSession, lake: Lake, entity: Entity) -> DataFrame:
    """Days on which Silver and quarantine together are not the deduped Bronze."""
    bronze = read_table(
        spark, lake.bronze(entity.name), entity.bronze_schema, lake.fmt, missing_ok=True
    )
    silver = read_table(
        spark, lake.silver(entity.name), entity.silver_schema, lake.fmt, missing_ok=True
    )
    quarantine = read_table(
        spark, lake.quarantine(entity.name), entity.quarantine_schema, lake.fmt, missing_ok=True
    )
    kept = silver.select("ingest_date").unionByName(quarantine.select("ingest_date"))
    return compare_counts(
        bronze.select("ingest_date", entity.key).distinct(), kept, "ingest_date"
    )


def reconcile_raw(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    raw_filter: Filter = as_is,
    stored_filter: Filter = as_is,
) -> DataFrame:
    """Days on which raw and Bronze differ in their filtered row counts."""
    raw = read_days(spark, lake.raw_entity(entity.name), entity.schema)
    bronze = read_table(
        spark, lake.bronze(entity.name), entity.bronze_schema, lake.fmt, missing_ok=True
    )
    return reconcile_counts(
        raw.withColumnRenamed(RAW_DAY, "ingest_date"), bronze, raw_filter, stored_filter
    )


@dataclass(frozen=True)
class RowDifferences:
    compared: DataFrame
    lost_keys: DataFrame
    lost_rows: DataFrame
    extra_keys: DataFrame
    extra_rows: DataFrame

    def counts(self) -> DataFrame:
        """Both differences as one row of numbers, from one tally of the keys; null is a key."""
        return self.compared.agg(
            F.count_if(F.col("stored_rows") == 0).alias("lost"),
            F.count_if(F.col("raw_rows") == 0).alias("extra"),
        )


def reconcile_rows(
    raw: DataFrame,
    stored: DataFrame,
    key: str,
    raw_filter: Filter = as_is,
    stored_filter: Filter = as_is,
    sample: int = 10,
) -> RowDifferences:
    """Keys on one side only, with the first rows behind them.

    A null key is reported as a key but has no rows, as null equals nothing in a join. The first rows belong to the
    first keys, so a sample reads the rows of ``sample`` keys and filters those alone: a filter has to judge every key
    by its own rows, as ``recon_filter`` does.
    """
    compared = compare_keys(raw.transform(raw_filter), stored.transform(stored_filter), key)
    lost = compared.filter(F.col("stored_rows") == 0).select(key)
    extra = compared.filter(F.col("raw_rows") == 0).select(key)

    def first_rows(df: DataFrame, keep: Filter, keys: DataFrame) -> DataFrame:
        first = keys.filter(F.col(key).isNotNull()).orderBy(key).limit(sample)
        return sample_rows(df.join(F.broadcast(first), key, "left_semi").transform(keep), key, sample)

    return RowDifferences(
        compared=compared,
        lost_keys=lost,
        lost_rows=first_rows(raw, raw_filter, lost),
        extra_keys=extra,
        extra_rows=first_rows(stored, stored_filter, extra),
    )


def reconcile_digests(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    raw_filter: Filter = as_is,
    stored_filter: Filter = as_is,
) -> DataFrame:
    """Keys that raw or Bronze lacks, for all days at once: ingest_date, the key, raw_rows, stored_rows.

    Days and key buckets are compared by digests first, so layers that agree exchange digests only.
    """
    raw = read_days(spark, lake.raw_entity(entity.name), entity.schema).withColumnRenamed(RAW_DAY, "ingest_date")
    bronze = read_table(
        spark, lake.bronze(entity.name), entity.bronze_schema, lake.fmt, missing_ok=True
    )
    return compare_keys_by_digest(
        raw.transform(raw_filter), bronze.transform(stored_filter), entity.key, ["ingest_date"]
    )


def reconcile_raw_rows(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    day: str,
    raw_filter: Filter = as_is,
    stored_filter: Filter = as_is,
    sample: int = 10,
) -> RowDifferences:
    """The keys behind one day's difference between raw and Bronze."""
    raw = read_jsonl(spark, day_path(lake.raw, entity.name, day), entity.schema)
    bronze = read_table_day(
        spark, lake.bronze(entity.name), entity.bronze_schema, day, lake.fmt
    )
    return reconcile_rows(raw, bronze, entity.key, raw_filter, stored_filter, sample)
