"""Scans of the lake's tables and of the run log."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.files import folders
from millrace.lake import checked_day
from millrace.sources.generations import DAY, MICRO_BATCH, covered_days, is_visible

# Formats that keep their own file list and cannot be read by partition folder.
LOG_FORMATS = ("delta",)
#: What Spark calls the folder of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    missing_ok: bool = False,
) -> DataFrame:
    """A whole table. The schema keeps ``ingest_date`` a string instead of an inferred date.

    With ``missing_ok`` a table that was never written is empty; any other error is raised.
    """
    reader = spark.read.format(fmt)
    if fmt not in LOG_FORMATS:
        reader = reader.schema(schema)
    return _current(spark, _load(spark, reader, path, schema, missing_ok), path, fmt)


def on_day(df: DataFrame, day: str) -> DataFrame:
    """One day of a table; Spark prunes the other partitions."""
    return df.filter(F.col("ingest_date") == checked_day(day))


def read_table_day(
    spark: SparkSession, path: str, schema: StructType, day: str, fmt: str = "parquet"
) -> DataFrame:
    """One day of a table, empty when the day or the table is missing.

    Opening the day's folder saves listing the folders of all other days.
    """
    if fmt in LOG_FORMATS:
        return on_day(read_table(spark, path, schema, fmt, missing_ok=True), day)
    reader = spark.read.format(fmt).schema(schema).option("basePath", path)
    folder = f"{path}/ingest_date={checked_day(day)}"
    return _current(spark, _load(spark, reader, folder, schema, missing_ok=True), path, fmt)


def read_table_days(
    spark: SparkSession, path: str, schema: StructType, days: Sequence[str | None], fmt: str = "parquet"
) -> DataFrame:
    """Some days of a table, empty when the table or all of them are missing; None stands for the rows without a day.

    One listing names the folders that are there, and only those of these days are looked into.
    """
    if fmt in LOG_FORMATS:
        rows = read_table(spark, path, schema, fmt, missing_ok=True)
        named = F.col(DAY).isin([day for day in days if day is not None])
        return rows.filter(named | F.col(DAY).isNull() if None in days else named)
    wanted, lead = {NO_VALUE if day is None else day for day in days}, f"{DAY}="
    found = [name for name in folders(spark, path) if name.startswith(lead) and unquote(name[len(lead) :]) in wanted]
    if not found:
        return empty_table(spark, schema)
    reader = spark.read.format(fmt).schema(schema).option("basePath", path)
    return _current(spark, reader.load([f"{path}/{name}" for name in found]), path, fmt)


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The newest runs of the run log; the id settles equal times."""
    return runs.orderBy(F.desc("run_at"), F.asc("id")).limit(n)


def _current(spark: SparkSession, df: DataFrame, path: str, fmt: str) -> DataFrame:
    """A table of micro-batches without the folders that a compaction has replaced, or not yet ended."""
    if fmt in LOG_FORMATS or MICRO_BATCH not in df.columns:
        return df
    covered = covered_days(spark, path)
    return df if covered is None else df.filter(is_visible(covered))


def _load(spark, reader, path, schema, missing_ok) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, schema)
        raise
