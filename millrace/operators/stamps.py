"""Audit columns of the layers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.entities import DEFAULT_SOURCE, QUARANTINE_REASON


def with_audit(
    df: DataFrame,
    day: str | Column,
    source: str = DEFAULT_SOURCE,
    at: datetime | None = None,
) -> DataFrame:
    """When, in which batch and from where a row came in; the batch is the raw day."""
    batch = F.lit(day) if isinstance(day, str) else day
    return df.withColumns(
        {
            "_ingested_at": F.lit(at) if at else F.current_timestamp(),
            "_batch_id": batch,
            "_source": F.lit(source),
            "ingest_date": batch,
        }
    )


def with_silver_stamp(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Pass one time per run, as separate writes would otherwise differ."""
    return df.withColumn("_silver_at", F.lit(at) if at else F.current_timestamp())


def with_quarantine_reason(df: DataFrame, reason: str = QUARANTINE_REASON) -> DataFrame:
    return df.withColumn("quarantine_reason", F.lit(reason))
