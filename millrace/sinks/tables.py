"""Partitioned table writes: plain append, and replacements that are safe to repeat."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.files import delete, is_written, matching
from millrace.lake import checked_day
from millrace.session import brief_shuffles, open_writers
from millrace.sources.generations import DAY, MICRO_BATCH
from millrace.sources.partitions import partition_values
from millrace.sources.tables import LOG_FORMATS, read_table_days

#: Of tables that hold many days; about a quarter less than Spark's own choice.
COMPRESSION = "zstd"
#: Keys that are sent whole to every task; more are joined by a shuffle.
FEW_KEYS = 200_000


def append_partitioned(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Append, or write nothing when there are no rows. A repeated append doubles the rows."""
    if df.isEmpty():
        return False
    with open_writers(df.sparkSession):
        df.write.format(fmt).mode("append").partitionBy(DAY).save(path)
    return True


def replace_day(df: DataFrame, path: str, day: str, fmt: str = "parquet") -> None:
    """Make ``df`` the only content of one day, also when it is empty."""
    day = checked_day(day)
    if fmt in LOG_FORMATS:
        (
            df.write.format(fmt)
            .mode("overwrite")
            .option("replaceWhere", f"{DAY} = '{day}'")
            .partitionBy(DAY)
            .save(path)
        )
    else:
        df.drop(DAY).write.format(fmt).mode("overwrite").save(f"{path}/{DAY}={day}")


def days_predicate(days: Sequence[str]) -> str:
    """The rows of exactly these days, as SQL."""
    return f"{DAY} IN ({', '.join(repr(checked_day(day)) for day in sorted(set(days)))})"


def replace_days(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    days: Sequence[str],
    fmt: str = "parquet",
    gather: bool = True,
) -> None:
    """Make ``df`` the only content of the given days; other days stay, whatever ``df`` holds.

    ``gather`` brings each day's rows together before the write, so that a shuffled input does
    not leave one file per task and day. AQE splits days that are too big for a task. No task sorts
    its rows by day: it keeps the files of its days open.
    """
    days = sorted({checked_day(day) for day in days})
    if not days:
        return
    rows = df.filter(F.col(DAY).isin(days))
    if fmt in LOG_FORMATS:
        writer = rows.write.option("replaceWhere", days_predicate(days))
        writer.format(fmt).mode("overwrite").partitionBy(DAY).save(path)
        return
    if gather:
        rows = rows.hint("rebalance", F.col(DAY))
    # Observed above the exchange: below it, AQE drops the metrics along with an empty input. At
    # most one value per requested day, so the set stays as small as the request.
    written = Observation()
    rows = rows.observe(written, F.collect_set(DAY).alias("days"))
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with open_writers(spark), brief_shuffles(spark):
        writer.option("compression", COMPRESSION).partitionBy(DAY).save(path)
    _clear_days(spark, path, set(days) - set(written.get["days"]))


def _clear_days(spark: SparkSession, path: str, unwritten: set[str]) -> None:
    """A dynamic overwrite leaves days without new rows as they were; their folders go, by one request each and no job."""
    if not unwritten:
        return
    for day in sorted(unwritten & set(partition_values(spark, path, DAY))):
        delete(spark, f"{path}/{DAY}={day}")


def replace_micro_batch(
    df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", replayed: bool = True
) -> None:
    """Make ``df`` the only content of one micro-batch, so that a replay changes nothing.

    The day lies above the micro-batch, so a day is read from its own folder. Only a micro-batch that may be ``replayed``
    can have left rows on a day that it has no more; the folders of its own number are looked for then.
    """
    spark = df.sparkSession
    written = Observation()
    rows = df.hint("rebalance", F.col(DAY)).withColumn(MICRO_BATCH, F.lit(batch_id).cast("long"))
    rows = rows.observe(written, F.collect_set(DAY).alias("days"))
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with open_writers(spark), brief_shuffles(spark):
        writer.option("compression", COMPRESSION).partitionBy(DAY, MICRO_BATCH).save(path)
    if not replayed:
        return
    days = written.get["days"]
    for folder in matching(spark, f"{path}/{DAY}=*/{MICRO_BATCH}={batch_id}"):
        if folder.split(f"{DAY}=")[-1].split("/")[0] not in days:
            delete(spark, folder)


def withdraw_rows(
    keys: DataFrame, path: str, schema: StructType, batch_id: int, staged: str, fmt: str = "parquet"
) -> int:
    """Take the rows of ``keys`` (day and key) out of the micro-batches before ``batch_id``; the number of parts rewritten.

    Only the days of ``keys`` are listed and read, first by their keys alone, and only the parts that hold one are written
    again. What stays of those goes to ``staged`` first: if the job ends half-way, the next try finds it there and goes on.
    Up to ``FEW_KEYS`` are sent to the tasks that read the parts, so no row is shuffled; more meet the rows in a join.
    """
    spark = keys.sparkSession
    of_days = keys.groupBy(DAY).count().collect()  # at most the days of a micro-batch
    days = [row[DAY] for row in of_days if row[DAY] is not None]
    if not days:
        return 0
    few = sum(row["count"] for row in of_days) <= FEW_KEYS
    stored = StructType([*schema.fields, StructField(MICRO_BATCH, LongType(), True)])

    def earlier() -> DataFrame:  # listed anew each time, as files come and go
        return read_table_days(spark, path, stored, days, fmt).filter(F.col(MICRO_BATCH) < batch_id)

    part = F.concat_ws("/", DAY, MICRO_BATCH)
    wanted = keys.select(*[F.col(c).alias(f"_{c}") for c in keys.columns])
    wanted = F.broadcast(wanted) if few else wanted
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys.columns])
    found = earlier().select(*keys.columns, part.alias("part")).join(wanted, same, "left_semi").select("part").distinct()
    parts = sorted(row["part"] for row in found.collect())  # folders of the days of one micro-batch
    with open_writers(spark), brief_shuffles(spark):
        if not is_written(spark, staged):
            if not parts:
                return 0
            stay = earlier().filter(part.isin(parts)).join(wanted, same, "left_anti")
            stay = stay if few else stay.hint("rebalance", F.col(DAY), F.col(MICRO_BATCH))
            writer = stay.write.format(fmt).mode("overwrite").option("compression", COMPRESSION)
            writer.partitionBy(DAY, MICRO_BATCH).save(staged)
        (
            spark.read.format(fmt).schema(stored).load(staged)
            .write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", COMPRESSION)
            .partitionBy(DAY, MICRO_BATCH)
            .save(path)
        )
    left = {tuple(unquote(x.split("=", 1)[1]) for x in name.rsplit("/", 2)[1:]) for name in matching(spark, f"{staged}/{DAY}=*/{MICRO_BATCH}=*")}
    for day, number in (name.rsplit("/", 1) for name in parts):
        if (day, number) not in left:  # nothing stays
            delete(spark, f"{path}/{DAY}={day}/{MICRO_BATCH}={number}")
    return len(parts)


def sample_rows(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first rows by key; the other columns settle equal keys."""
    rest = [column for column in df.columns if column != key]
    return df.orderBy(key, *rest).limit(n)
