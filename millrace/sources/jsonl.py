"""Raw newline-JSON, one folder per entity and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.files import exists, filled
from millrace.sources.partitions import partition_values

RAW_DAY = "date"
#: The text of a line that could not be read as it should, beside the typed columns.
BAD_LINE = "_bad_line"


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType | None = None, bad_lines: bool = False
) -> DataFrame:
    """One row per line. A schema fixes names and types and drops every other field.

    Broken lines become all-null rows and wrong-typed fields become null, so the quality rules
    see them. With ``bad_lines`` the column ``_bad_line`` holds the text of such a line; null
    elsewhere, also for a sound line without any field. Without a schema Spark reads the input
    once more to infer one.
    """
    if schema is None:
        return spark.read.json(path)
    if bad_lines:
        schema = StructType([*schema.fields, StructField(BAD_LINE, StringType(), True)])
        return spark.read.schema(schema).option("columnNameOfCorruptRecord", BAD_LINE).json(path)
    return spark.read.schema(schema).json(path)


def is_broken(columns: Sequence[str]) -> Column:
    """A line of which nothing could be read: no JSON object."""
    return F.col(BAD_LINE).isNotNull() & F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull()


def is_damaged(columns: Sequence[str]) -> Column:
    """A line of which some fields could be read and others not, as they have another type."""
    return F.col(BAD_LINE).isNotNull() & ~is_broken(columns)


def read_days(
    spark: SparkSession,
    root: str,
    schema: StructType,
    first: str | None = None,
    last: str | None = None,
    bad_lines: bool = False,
) -> DataFrame:
    """Raw rows of all days, or from ``first`` to ``last``, with the folder's day as ``date``."""
    with_day = StructType(schema.fields + [StructField(RAW_DAY, StringType(), True)])
    rows = read_jsonl(spark, root, with_day, bad_lines)
    if first is not None:
        rows = rows.filter(F.col(RAW_DAY) >= first)
    if last is not None:
        rows = rows.filter(F.col(RAW_DAY) <= last)
    return rows


def list_days(spark: SparkSession, root: str) -> DataFrame:
    """The days that have a folder with a file below ``root``, ascending; no file is opened."""
    return spark.createDataFrame([(day,) for day in raw_days(spark, root)], f"{RAW_DAY} string")


def raw_days(spark: SparkSession, root: str, days: Sequence[str] | None = None) -> list[str]:
    """The days, of ``days`` or of all, that have a folder with a file below ``root``, ascending.

    The names come from one listing; a folder that is named is then looked into as far as its first file. A missing
    ``root`` raises PATH_NOT_FOUND.
    """
    if not exists(spark, root):
        spark.read.text(root)  # Spark's own error
    named = partition_values(spark, root, RAW_DAY)
    wanted = named if days is None else sorted(set(days) & set(named))
    full = set(filled(spark, [f"{root}/{RAW_DAY}={day}" for day in wanted]))
    return [day for day in wanted if f"{root}/{RAW_DAY}={day}" in full]
