"""Demand on a stream that keeps its late rows.

``start_demand`` lets Spark's watermark drop what comes too late. Here each micro-batch leaves the counts of its own
rows by window, told apart by whether the window had closed before, and the late rows themselves go to a table. Sums of
counts need no state, and on-time and late rows together are all rows of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.entities import TRIPS
from millrace.lake import Lake
from millrace.operators.rides import BATCH_LABEL, WINDOW
from millrace.sinks.tables import DAY, MICRO_BATCH
from millrace.sources.partitions import partition_values

BY = ("city", "status")
PARTS_SCHEMA = f"window_start timestamp, window_end timestamp, city string, status string, is_late boolean, n long, newest long, {MICRO_BATCH} long"
LATE_SCHEMA = f"{TRIPS.key} string, request_time timestamp, city string, status string, {DAY} string, {MICRO_BATCH} long"


def _parts(lake: Lake) -> str:
    return f"{lake.root}/demand_late/parts"


def _rows(lake: Lake) -> str:
    return f"{lake.root}/demand_late/rows"


def _marks(lake: Lake) -> str:
    return f"{lake.root}/demand_late/marks"


def newest_before(spark: SparkSession, lake: Lake, batch_id: int | None = None) -> int | None:
    """Microseconds of the newest request time before a micro-batch, or of all: one row of the folder before it is read."""
    numbers = [int(n) for n in partition_values(spark, _marks(lake), MICRO_BATCH)]
    earlier = [n for n in numbers if batch_id is None or n < batch_id]
    if not earlier:
        return None
    return spark.read.schema("newest long").parquet(f"{_marks(lake)}/{MICRO_BATCH}={max(earlier)}").first()["newest"]


def _line(newest: int | None, delay: str) -> Column:
    """Windows that end up to here are closed; null if nothing has come yet."""
    at = F.timestamp_micros(F.lit(newest).cast("long"))
    return at - F.expr(f"INTERVAL {delay}")


def start_demand_late(
    spark: SparkSession, lake: Lake, delay: str = "1 hour", files_per_batch: int | None = None
) -> StreamingQuery:
    """Count all new trips by window in parts and keep the late ones, then stop.

    A row is late if its window ended ``delay`` or more before the newest request time of the micro-batches before.
    What a micro-batch writes depends on its rows and the one mark before it, in folders of its own number, so a replay
    gives the same. Rows without request time belong to no window and are in neither table. Always give the same
    ``delay`` for one lake.
    """
    reader = spark.readStream.schema(TRIPS.bronze_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    trips = reader.format(lake.fmt).load(lake.bronze(TRIPS.name)).select(TRIPS.key, "request_time", *BY, DAY)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        own = f"{MICRO_BATCH}={batch_id}"
        before = newest_before(session, lake, batch_id)
        window = F.window("request_time", WINDOW)
        timed = batch.filter(F.col("request_time").isNotNull()).withColumn("_window", window)
        timed = timed.withColumn("is_late", F.coalesce(F.col("_window.end") <= _line(before, delay), F.lit(False)))
        counted = timed.groupBy("_window", *BY, "is_late").agg(
            F.count(F.lit(1)).alias("n"), F.unix_micros(F.max("request_time")).alias("newest")
        )
        parts = counted.select(
            F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *BY, "is_late", "n", "newest"
        )
        parts.write.mode("overwrite").parquet(f"{_parts(lake)}/{own}")
        timed.filter("is_late").drop("_window", "is_late").write.mode("overwrite").parquet(f"{_rows(lake)}/{own}")
        written = session.read.schema(parts.schema).parquet(f"{_parts(lake)}/{own}")
        mark = written.agg(F.greatest(F.max("newest"), F.lit(before).cast("long")).alias("newest"))
        mark.write.mode("overwrite").parquet(f"{_marks(lake)}/{own}")

    return (
        trips.writeStream.foreachBatch(write)
        .option("checkpointLocation", lake.checkpoint("demand-late"))
        .trigger(availableNow=True)
        .start()
    )


def demand_with_late(spark: SparkSession, lake: Lake, delay: str = "1 hour") -> DataFrame:
    """Of each window: on-time and late rows, and whether it can no longer get on-time ones."""
    parts = spark.read.schema(PARTS_SCHEMA).parquet(_parts(lake))
    line = _line(newest_before(spark, lake), delay)
    summed = parts.groupBy("window_start", "window_end", *BY).agg(
        F.sum(F.when(F.col("is_late"), 0).otherwise(F.col("n"))).alias("n_on_time"),
        F.sum(F.when(F.col("is_late"), F.col("n")).otherwise(0)).alias("n_late"),
    )
    return summed.select(
        F.date_format("window_start", BATCH_LABEL).alias("batch_id"), *BY, "n_on_time", "n_late",
        F.coalesce(F.col("window_end") <= line, F.lit(False)).alias("is_closed"),
    )


def late_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    """The rows that came after their window had closed, with the micro-batch that brought them."""
    return spark.read.schema(LATE_SCHEMA).parquet(_rows(lake))
