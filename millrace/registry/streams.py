"""Streaming jobs over the whole raw lines, read back as tables and compared with the batch SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.entities import ENTITIES, PAYMENTS, TRIPS
from millrace.lake import Lake
from millrace.registry import Query
from millrace.registry.lakes import batched, batched_sql, deduped_sql, deliver, fresh, passes_sql
from millrace.registry.tables import SILVER_SQL
from millrace.registry.views import once, oracle
from millrace.session import scratch_dir
from millrace.sources import read_table
from millrace.sinks.tables import MICRO_BATCH
from millrace.streaming import (
    compact_stream,
    demand_with_late,
    late_rows,
    start_demand,
    start_demand_late,
    start_ingest,
    start_silver,
    vacuum_stream,
)


def landed(spark: SparkSession, sf: str, name: str) -> Lake:
    """A lake whose Bronze was filled by the ingest stream."""
    lake = fresh(spark, sf, "stream", name)
    start_ingest(spark, lake, ENTITIES[name]).awaitTermination()
    return lake


def _verdicts(spark, lake, entity):
    silver = read_table(spark, lake.silver(entity.name), entity.silver_schema)
    rejected = read_table(spark, lake.quarantine(entity.name), entity.quarantine_schema)
    return silver.select("ingest_date", entity.key, F.lit("valid").alias("layer")).unionByName(
        rejected.select("ingest_date", entity.key, F.lit("quarantine").alias("layer"))
    )


def stream_ingest(spark, sf):
    lake = once(landed, spark, sf, "payments")
    bronze = read_table(spark, lake.bronze("payments"), PAYMENTS.bronze_schema)
    return bronze.groupBy("ingest_date", "_batch_id", "_source").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_ingested_at").alias("stamped"),
        F.sum(F.col("fare_vnd").cast("bigint")).alias("fare_vnd"),
    )


def stream_silver(spark, sf):
    lake = once(landed, spark, sf, "trips")
    start_silver(spark, lake, TRIPS).awaitTermination()
    return _verdicts(spark, lake, TRIPS).drop("ingest_date")


def delivered(spark: SparkSession, sf: str) -> Lake:
    """Payments in three deliveries, each a micro-batch: copies meet older ones and take their place if they are newer."""
    lake = Lake(root=scratch_dir(spark, "stream-copies"), raw=scratch_dir(spark, "stream-copies-raw"))
    rows = batched(spark, sf, "payments")
    for turn in range(3):
        part = F.pmod(F.crc32(F.concat_ws("-", "fare_vnd", "payment_time").cast("binary")), F.lit(3)) == turn
        deliver(spark, sf, "payments", rows.filter(part), lake, mode="append")
        start_ingest(spark, lake, PAYMENTS).awaitTermination()
        start_silver(spark, lake, PAYMENTS).awaitTermination()
    return lake


def stream_dedupe(spark, sf):
    lake = once(delivered, spark, sf)
    kept = []
    for layer, path, schema in (
        ("valid", lake.silver("payments"), PAYMENTS.silver_schema),
        ("quarantine", lake.quarantine("payments"), PAYMENTS.quarantine_schema),
    ):
        kept.append(read_table(spark, path, schema).select(
            "ingest_date", "payment_id", F.lit(layer).alias("layer"),
            F.date_format("payment_time", "yyyy-MM-dd HH:mm:ss").alias("paid_at"), "fare_vnd", "rider_id",
        ))
    return kept[0].unionByName(kept[1])


def stream_compact(spark, sf):
    """The same deliveries, compacted and vacuumed: rows of each day and layer, and the folders they lie in."""
    lake = delivered(spark, sf)
    compact_stream(spark, lake, PAYMENTS)
    vacuum_stream(spark, lake, PAYMENTS)
    kept = []
    for layer, path, schema in (
        ("valid", lake.silver("payments"), PAYMENTS.silver_schema),
        ("quarantine", lake.quarantine("payments"), PAYMENTS.quarantine_schema),
    ):
        kept.append(read_table(spark, path, schema).select("*", F.lit(layer).alias("layer")).groupBy("ingest_date", "layer").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("fare_vnd").cast("bigint")).alias("fare_vnd"),
            F.count_distinct(MICRO_BATCH).alias("folders"),
        ))
    return kept[0].unionByName(kept[1])


def out_of_order(spark: SparkSession, sf: str) -> Lake:
    """Trips in three deliveries by the year of their request, old years after newer ones."""
    lake = Lake(root=scratch_dir(spark, "stream-late"), raw=scratch_dir(spark, "stream-late-raw"))
    rows = batched(spark, sf, "trips")
    turn = F.coalesce((F.year("request_time") + 1) % 3, F.lit(0))
    for n in range(3):
        deliver(spark, sf, "trips", rows.filter(turn == n), lake, mode="append")
        start_ingest(spark, lake, TRIPS).awaitTermination()
        start_demand_late(spark, lake).awaitTermination()
    return lake


def stream_late_counts(spark, sf):
    """On-time and late trips of every window; together they are all trips."""
    return demand_with_late(spark, once(out_of_order, spark, sf))


def stream_late_rows(spark, sf):
    """The trips that came after their window had closed."""
    rows = late_rows(spark, once(out_of_order, spark, sf))
    return rows.select("trip_id", "city", "status", "ingest_date", F.date_format("request_time", "yyyy-MM-dd HH:mm:ss").alias("requested_at"))


def stream_demand(spark, sf):
    """Windows that closed; those of the last hour are still open when the input ends."""
    lake = once(landed, spark, sf, "trips")
    start_demand(spark, lake).awaitTermination()
    counted = spark.read.parquet(f"{lake.root}/demand")
    return counted.select("batch_id", "city", "status", "n")


#: Trips by delivery, whether their window had closed before it, and whether it is closed at the end.
_DELIVERED_SQL = """
SELECT t.*, coalesce(w + INTERVAL '15 minutes' <= b.newest - INTERVAL '1 hour', false) AS is_late,
  w + INTERVAL '15 minutes' <= (SELECT max(request_time) FROM {v_trips}) - INTERVAL '1 hour' AS is_closed
FROM (SELECT trip_id, city, status, request_time, substr(ingest_date, 1, 8) || '01' AS ingest_date,
    time_bucket(INTERVAL '15 minutes', request_time) AS w, (year(request_time) + 1) % 3 AS turn
  FROM {v_trips} WHERE request_time IS NOT NULL) t
JOIN (SELECT turn, (SELECT max(request_time) FROM {v_trips} WHERE (year(request_time) + 1) % 3 < turn) AS newest
  FROM range(3) r(turn)) b ON t.turn = b.turn"""

QUERIES = {
    "stream_late_counts": Query(
        stream_late_counts,
        oracle(f"""SELECT strftime(w, '%Y%m%d_%H%M') AS batch_id, city, status,
  count(*) FILTER (NOT is_late) AS n_on_time, count(*) FILTER (is_late) AS n_late, is_closed
FROM ({_DELIVERED_SQL}) d GROUP BY ALL"""),
    ),
    "stream_late_rows": Query(
        stream_late_rows,
        oracle(f"""SELECT trip_id, city, status, ingest_date,
  strftime(request_time, '%Y-%m-%d %H:%M:%S') AS requested_at FROM ({_DELIVERED_SQL}) d WHERE is_late"""),
    ),
    "stream_compact": Query(
        stream_compact,
        oracle(f"""SELECT ingest_date, layer, count(*) AS n, CAST(sum(fare_vnd) AS BIGINT) AS fare_vnd, 1 AS folders
FROM (SELECT batch_day AS ingest_date, fare_vnd,
    CASE WHEN {passes_sql('payments')} THEN 'valid' ELSE 'quarantine' END AS layer
  FROM ({deduped_sql('payments')}) d) k GROUP BY ALL"""),
    ),
    "stream_ingest": Query(
        stream_ingest,
        oracle(f"""SELECT batch_day AS ingest_date, batch_day AS _batch_id,
  'simulator' AS _source, count(*) AS n, count(*) AS stamped,
  CAST(sum(fare_vnd) AS BIGINT) AS fare_vnd
FROM ({batched_sql('payments')}) b GROUP BY batch_day"""),
    ),
    "stream_silver": Query(
        stream_silver,
        oracle(f"""SELECT trip_id, CASE WHEN coalesce({SILVER_SQL['trips']}, false)
  THEN 'valid' ELSE 'quarantine' END AS layer FROM {{v_trips}}"""),
    ),
    "stream_dedupe": Query(
        stream_dedupe,
        oracle(f"""SELECT batch_day AS ingest_date, payment_id,
  CASE WHEN {passes_sql('payments')} THEN 'valid' ELSE 'quarantine' END AS layer,
  strftime(payment_time, '%Y-%m-%d %H:%M:%S') AS paid_at, fare_vnd, rider_id
FROM ({deduped_sql('payments')}) d"""),
    ),
    "stream_demand": Query(
        stream_demand,
        oracle("""SELECT strftime(w, '%Y%m%d_%H%M') AS batch_id, city, status, count(*) AS n
FROM (SELECT time_bucket(INTERVAL '15 minutes', request_time) AS w, city, status FROM {v_trips}) t
WHERE w + INTERVAL '15 minutes' <=
  (SELECT date_trunc('millisecond', max(request_time)) - INTERVAL '1 hour' FROM {v_trips})
GROUP BY ALL"""),
    ),
}
