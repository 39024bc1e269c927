"""The run log: one row per finished run, whatever its outcome."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def log_run(
    spark: SparkSession,
    path: str,
    target_date: str,
    job: str,
    status: str,
    fmt: str = "parquet",
) -> str:
    """Append one run, creating the table on first use; returns the run's id."""
    return log_runs(spark, path, [target_date], job, status, fmt)[0]


def log_runs(
    spark: SparkSession,
    path: str,
    target_dates: Sequence[str],
    job: str,
    status: str,
    fmt: str = "parquet",
) -> list[str]:
    """Append a run for each of the dates in one write; returns their ids."""
    ids = [uuid.uuid4().hex for _ in target_dates]
    (
        spark.createDataFrame(list(zip(ids, target_dates, strict=True)), "id string, target_date string")
        .select(
            "id",
            F.current_timestamp().alias("run_at"),
            "target_date",
            F.lit(job).alias("dag_id"),
            F.lit(status).alias("status"),
        )
        .coalesce(1)
        .write.format(fmt)
        .mode("append")
        .save(path)
    )
    return ids


def days_done(runs: DataFrame, days: DataFrame, target: str, job: str) -> DataFrame:
    """The days that ``job`` has logged in ``days`` since, by ``runs``, it last came to the end of ``target``: what a
    range that broke off need not do again."""
    ended = runs.filter(
        (F.col("dag_id") == job) & (F.col("target_date") == target) & F.col("status").isin("success", "incomplete")
    ).agg(F.max("run_at").alias("ended"))  # one row
    passed = days.filter((F.col("dag_id") == job) & (F.col("status") == "success"))
    later = F.col("ended").isNull() | (F.col("run_at") > F.col("ended"))
    return passed.join(F.broadcast(ended), later).select("target_date").distinct()
