"""The same jobs on streams: ingest of new files, Silver, and demand.

A lake is filled either by these or by the batch jobs: Bronze written here carries the file
sink's log, and Silver is partitioned by day, then micro-batch.
"""

from __future__ import annotations

from contextlib import ExitStack, suppress
from datetime import datetime, timezone
from functools import reduce
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from millrace.entities import DEFAULT_SOURCE, TRIPS, Entity
from millrace.files import delete, exists, is_written
from millrace.lake import Lake
from millrace.operators.dedupe import dedupe
from millrace.operators.quality import PASSES, invalid_rows, judge, valid_rows
from millrace.operators.rides import demand
from millrace.operators.stamps import with_audit, with_quarantine_reason, with_silver_stamp
from millrace.session import brief_shuffles, open_writers, size_reads, size_state, small_sorts
from millrace.sinks.tables import COMPRESSION, DAY, MICRO_BATCH, replace_micro_batch, withdraw_rows
from millrace.sources.generations import forget
from millrace.sources.jsonl import RAW_DAY
from millrace.sources.tables import read_table, read_table_days

#: The micro-batch of days that are cleansed as a whole.
CLOSED = -1
#: How a new row stands to those of its day and key that were sent out before.
_STANDING, FIRST, CORRECTS, TIED = "_standing", "first", "corrects", "tied"
_KEY, _SENT, _SENT_TIME, _NEW = "_of_key", "_sent", "_sent_time", "_is_new"


def _limited(reader, files_per_batch: int | None):
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def ingest_stream(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    source: str = DEFAULT_SOURCE,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New raw files with audit columns; the folder's day becomes ``ingest_date``."""
    with_day = StructType(entity.schema.fields + [StructField(RAW_DAY, StringType(), True)])
    reader = _limited(spark.readStream.schema(with_day), files_per_batch)
    lines = reader.json(lake.raw_entity(entity.name))
    return with_audit(lines, F.col(RAW_DAY), source).drop(RAW_DAY)


def start_ingest(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    source: str = DEFAULT_SOURCE,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Land all new raw files in Bronze, each exactly once, then stop."""
    size_reads(spark)
    writer = (
        ingest_stream(spark, lake, entity, source, files_per_batch)
        .writeStream.format(lake.fmt)
        .outputMode("append")
        .option("compression", COMPRESSION)
        .option("checkpointLocation", lake.checkpoint(f"ingest-{entity.name}"))
        .partitionBy("ingest_date")
        .trigger(availableNow=True)
    )
    with ExitStack() as held:  # the file sink asks the session for its settings at every micro-batch
        held.enter_context(open_writers(spark))
        query = writer.start(lake.bronze(entity.name))
        Thread(target=_release, args=(query, held.pop_all()), daemon=True).start()
    return query


def _release(query: StreamingQuery, held: ExitStack) -> None:
    """Give settings back when a stream has ended, whatever its end."""
    with suppress(Exception):  # raised where the caller waits for the stream
        query.awaitTermination()
    with suppress(Exception):  # no session any more
        held.close()


def silver_stream(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    keep_days: int | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Bronze rows, as ``start_silver`` takes them in.

    With ``keep_days`` rows of days outside it, also of days to come, are left to ``start_closed_days``; without it all
    days are taken.
    """
    reader = _limited(spark.readStream.schema(entity.bronze_schema), files_per_batch)
    arrived = reader.format(lake.fmt).load(lake.bronze(entity.name))
    return arrived if keep_days is None else arrived.filter(_is_open(keep_days))


def survivors(batch: DataFrame, sent: DataFrame, entity: Entity) -> DataFrame:
    """The best row of each day and key of a micro-batch, and how it stands to the rows ``sent`` out before.

    ``_standing`` is ``first`` (none was sent), ``corrects`` (it is newer) or ``tied`` (as new, so the other columns
    decide); older ones are left out. Of the rows sent only keys and times are shuffled, and of each key of the
    micro-batch one row per map task.
    """
    keys = [DAY, entity.key]
    of_key = F.struct(*keys)  # never null, so rows without a day or key meet as well
    best = dedupe(batch.withColumn(_KEY, of_key).drop(*keys), _KEY, newest=entity.newest)
    time = entity.newest or F.lit(0)
    before = sent.groupBy(of_key.alias(_KEY)).agg(F.max(time).alias(_SENT_TIME), F.count(F.lit(1)).alias(_SENT))
    time, sent_time = F.col(entity.newest) if entity.newest else time, F.col(_SENT_TIME)
    standing = (
        F.when(F.col(_SENT).isNull(), FIRST)
        .when(time.eqNullSafe(sent_time), TIED)
        .when(sent_time.isNull() | (time > sent_time), CORRECTS)
    )
    columns = [F.col(f"{_KEY}.{c}").alias(c) if c in keys else F.col(c) for c in batch.columns]
    met = best.join(before, _KEY, "left").select(*columns, standing.alias(_STANDING))
    return met.filter(F.col(_STANDING).isNotNull())


def tie_winners(tied: DataFrame, sent: DataFrame, entity: Entity) -> DataFrame:
    """Those of ``tied`` rows that come before all rows ``sent`` out for their day and key, by the batch dedupe's order."""
    keys = [DAY, entity.key]
    wanted = tied.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    older = sent.select(*tied.columns).join(wanted, same, "left_semi")
    both = older.withColumn(_NEW, F.lit(False)).unionByName(tied.withColumn(_NEW, F.lit(True)))
    return dedupe(both, keys, newest=entity.newest).filter(_NEW).drop(_NEW)  # equal rows: the one sent stays


def _sent(spark: SparkSession, lake: Lake, entity: Entity, days: list[str | None], batch_id: int) -> DataFrame:
    """The rows of Silver and quarantine on ``days`` that micro-batches before ``batch_id`` have sent out."""
    stored = StructType([*entity.bronze_schema.fields, StructField(MICRO_BATCH, LongType(), True)])
    paths = (lake.silver(entity.name), lake.quarantine(entity.name))
    silver, rejected = (read_table_days(spark, path, stored, days, lake.fmt) for path in paths)
    return silver.unionByName(rejected).filter(F.col(MICRO_BATCH) < batch_id).drop(MICRO_BATCH)


def _judged(batch: DataFrame, batch_id: int, lake: Lake, entity: Entity, staged: str) -> DataFrame:
    """The rows of a micro-batch that became the survivor of their day and key, with their verdict and standing.

    They are written down before a table changes, and a replay takes what was written down. Rows that tie in time go once
    more through the whole order, as only they need all columns of the rows sent out.
    """
    spark, met, settled = batch.sparkSession, f"{staged}/met", f"{staged}/settled"
    stored = StructType([*batch.schema.fields, StructField(PASSES, BooleanType(), True), StructField(_STANDING, StringType(), True)])
    days = [row[DAY] for row in batch.select(DAY).distinct().collect()]

    def write(rows: DataFrame, path: str) -> None:
        writer = judge(rows, entity.rules).write.mode("overwrite").option("partitionOverwriteMode", "static")
        with small_sorts(spark), open_writers(spark), brief_shuffles(spark):
            writer.option("compression", COMPRESSION).partitionBy(_STANDING).parquet(path)

    def written(path: str, standing: str = "") -> DataFrame:
        """All rows, or those of a folder, which is opened alone so that Spark knows its size."""
        return spark.read.schema(stored).option("basePath", path).parquet(path + standing)

    if not is_written(spark, met):
        write(survivors(batch, _sent(spark, lake, entity, days, batch_id), entity), met)
    if not exists(spark, f"{met}/{_STANDING}={TIED}"):
        return written(met)
    if not is_written(spark, settled):
        tied = written(met, f"/{_STANDING}={TIED}").select(*batch.columns)
        winners = tie_winners(tied, _sent(spark, lake, entity, days, batch_id), entity)
        write(winners.withColumn(_STANDING, F.lit(CORRECTS)), settled)
    return written(met).filter(F.col(_STANDING) != TIED).unionByName(written(settled))


def _is_open(keep_days: int):
    """Days from ``keep_days`` before today to tomorrow."""
    day = F.to_date(DAY)
    return F.coalesce(day.between(F.date_sub(F.current_date(), keep_days), F.date_add(F.current_date(), 1)), F.lit(False))


def start_silver(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    keep_days: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Split all new Bronze rows into Silver and quarantine, then stop; the newest copy of a key stays.

    The tables themselves are what is known of earlier micro-batches: new rows meet the keys that the days of the
    micro-batch hold in both tables. There is no state beside them to keep, grow or lose. Each micro-batch is written
    down once and both tables are made from that. If a newer copy comes with a later micro-batch, its row is written
    first and the older one is then taken out of the part that holds it. A replay after a crash finds what was written
    down and goes on from there.
    """
    staging, checkpoint = lake.staging(entity.name), lake.checkpoint(f"silver-{entity.name}")
    size_reads(spark)
    if exists(spark, f"{checkpoint}/state"):  # of the form that kept the survivors there, which all stand in the tables
        delete(spark, f"{checkpoint}/state")

    def write(batch: DataFrame, batch_id: int) -> None:
        session, staged = batch.sparkSession, f"{staging}/stream/batch={batch_id}"
        replayed = exists(session, staged)
        judged = _judged(batch, batch_id, lake, entity, staged)
        at = datetime.now(timezone.utc)
        rows = judged.drop(_STANDING)
        valid = with_silver_stamp(valid_rows(rows), at)
        invalid = with_quarantine_reason(with_silver_stamp(invalid_rows(rows), at))
        older = judged.filter(F.col(_STANDING) == CORRECTS).select(DAY, entity.key)
        tables = (
            ("silver", lake.silver(entity.name), entity.silver_schema, valid),
            ("quarantine", lake.quarantine(entity.name), entity.quarantine_schema, invalid),
        )
        for _, path, _, new in tables:
            replace_micro_batch(new, path, batch_id, lake.fmt, replayed)
        for name, path, schema, _ in tables:
            withdraw_rows(older, path, schema, batch_id, f"{staged}/{name}", lake.fmt)
        delete(session, staged)

    return (
        silver_stream(spark, lake, entity, keep_days, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_closed_days(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    keep_days: int,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Cleanse the days again that got new Bronze rows but that ``start_silver`` does not take in, then stop.

    Such a day is judged from all its Bronze rows, as the batch job does, and replaces its whole folder.
    """
    staging = lake.staging(entity.name)

    def write(batch: DataFrame, batch_id: int) -> None:
        session, staged = batch.sparkSession, f"{staging}/closed/batch={batch_id}"
        days = sorted(row[DAY] for row in batch.select(DAY).distinct().collect())
        if not days:
            return
        bronze = read_table(session, lake.bronze(entity.name), entity.bronze_schema, lake.fmt)
        best = dedupe(bronze.filter(F.col(DAY).isin(days)), [DAY, entity.key], newest=entity.newest)
        judged = judge(best, entity.rules)
        judged.write.mode("overwrite").parquet(staged)
        rows, at = session.read.schema(judged.schema).parquet(staged), datetime.now(timezone.utc)
        valid = with_silver_stamp(valid_rows(rows), at)
        invalid = with_quarantine_reason(with_silver_stamp(invalid_rows(rows), at))
        for path, new in ((lake.silver(entity.name), valid), (lake.quarantine(entity.name), invalid)):
            for day in days:
                forget(session, path, day)
                of_day = new.filter(F.col(DAY) == day).drop(DAY).withColumn(MICRO_BATCH, F.lit(CLOSED).cast("long"))
                of_day.hint("rebalance").write.format(lake.fmt).mode("overwrite").partitionBy(MICRO_BATCH).save(f"{path}/{DAY}={day}")
        delete(session, staged)

    reader = _limited(spark.readStream.schema(entity.bronze_schema), files_per_batch)
    arrived = reader.format(lake.fmt).load(lake.bronze(entity.name))
    return (
        arrived.filter(~_is_open(keep_days) & F.col(DAY).isNotNull())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", lake.checkpoint(f"closed-{entity.name}"))
        .trigger(availableNow=True)
        .start()
    )


def demand_stream(
    spark: SparkSession,
    lake: Lake,
    delay: str = "1 hour",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Trips per 15 minutes, city and status by request time; later rows than ``delay`` drop."""
    reader = _limited(spark.readStream.schema(TRIPS.bronze_schema), files_per_batch)
    trips = reader.format(lake.fmt).load(lake.bronze(TRIPS.name))
    return demand(trips.withWatermark("request_time", delay), "request_time")


def start_demand(
    spark: SparkSession,
    lake: Lake,
    delay: str = "1 hour",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append every window that can no longer change to ``<root>/demand``, then stop."""
    size_reads(spark)
    size_state(spark)
    return (
        demand_stream(spark, lake, delay, files_per_batch)
        .writeStream.format(lake.fmt)
        .outputMode("append")
        .option("checkpointLocation", lake.checkpoint("demand"))
        .trigger(availableNow=True)
        .start(f"{lake.root}/demand")
    )
