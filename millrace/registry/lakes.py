"""Jobs that write files: raw lines, Bronze, Silver, quarantine, run log.

The raw lines hold whole test tables. A batch is a month here, named by its first day, so that
the check writes some hundred partitions instead of thousands.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.entities import ENTITIES, PAYMENTS, RATINGS, RUNS_SCHEMA, TRIPS
from millrace.lake import Lake
from millrace.operators.dedupe import dedupe
from millrace.operators.rides import BATCH_LABEL, WINDOW
from millrace.operators.stamps import with_audit
from millrace.plans import (
    line_counts,
    recon_filter,
    reconcile_raw,
    reconcile_raw_rows,
    run_day,
    run_range,
)
from millrace.registry import Query
from millrace.registry.tables import RECON_SQL, SILVER_SQL
from millrace.registry.views import derived, is_small, load, once, oracle
from millrace.session import SPLITS, scratch_dir, setting, size_shuffles, small_sorts
from millrace.sinks import append_partitioned, replace_days, sample_rows, write_day_jsonl
from millrace.sources import (
    latest_runs,
    list_days,
    on_day,
    read_days,
    read_jsonl,
    read_table,
)

ONE_DAY = "1997-03-01"
RATINGS_DAY = "2024-01-01"
#: Raw lines are delivered compressed; a reader gets a whole file in one task, so files are bounded.
LINES_PER_FILE = 250_000
DELIVERY_SPLITS = 128 * 1024 * 1024
CODEC = "spark.sql.parquet.compression.codec"
EVENT_TIME = {"trips": "request_time", "payments": "payment_time", "ratings": "rated_at"}


def batched(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """An entity's columns and the month it is delivered in, straight from the test tables."""
    month = F.concat(F.substring("ingest_date", 1, 8), F.lit("01")).alias("batch_day")
    return derived(spark, sf, f"v_{name}").select(*ENTITIES[name].schema.names, month)


def deliver(spark: SparkSession, sf: str, name: str, rows: DataFrame, lake: Lake, mode: str = "overwrite") -> None:
    """Write ``batched`` rows as raw lines. There are some hundred months at most, so the tasks that read a large table
    write it too; large splits keep files few."""
    small = is_small(spark, sf, f"v_{name}")
    with setting(spark, SPLITS, DELIVERY_SPLITS):
        write_day_jsonl(rows, lake.raw_entity(name), "batch_day", mode, small, "gzip", LINES_PER_FILE)


def batched_sql(name: str) -> str:
    columns = ", ".join(ENTITIES[name].schema.names)
    return f"SELECT {columns}, substr(ingest_date, 1, 8) || '01' AS batch_day FROM {{v_{name}}}"


def deduped_sql(name: str) -> str:
    """One row per batch and key: the newest, then the first by all other columns, nulls last."""
    entity = ENTITIES[name]
    rest = [c for c in entity.schema.names if c not in (entity.key, entity.newest)]
    order = ", ".join([f"{entity.newest} DESC NULLS LAST", *(f"{c} NULLS LAST" for c in rest)])
    return f"""SELECT * FROM ({batched_sql(name)}) b QUALIFY row_number() OVER (
  PARTITION BY batch_day, {entity.key} ORDER BY {order}) = 1"""


def passes_sql(name: str) -> str:
    return f"coalesce({SILVER_SQL[name]}, false)"


def _base(spark: SparkSession, sf: str) -> Lake:
    base = scratch_dir(spark, "lake")
    return Lake(root=f"{base}/filled", raw=f"{base}/raw")


def _raw_lines(spark: SparkSession, sf: str, name: str) -> Lake:
    lake = once(_base, spark, sf)
    start = F.window(EVENT_TIME[name], WINDOW)["start"]
    meta = F.struct(
        F.lit("1.0").alias("schema_version"),
        F.date_format(start, BATCH_LABEL).alias("batch_id"),
    )
    rows = batched(spark, sf, name).withColumn("_meta", meta)
    deliver(spark, sf, name, rows, lake)
    return lake


def raw_lake(spark: SparkSession, sf: str, *names: str) -> Lake:
    """A lake with the raw lines of the named entities."""
    for name in names:
        lake = once(_raw_lines, spark, sf, name)
    return lake


def raw_span(spark: SparkSession, lake: Lake, name: str) -> tuple[str, int]:
    """The first day that has raw lines, and the number of days up to the last one."""
    days = list_days(spark, lake.raw_entity(name)).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return days.select("a", (F.datediff("b", "a") + 1).alias("n")).first()


def _filled(spark: SparkSession, sf: str, name: str) -> DataFrame:
    lake = raw_lake(spark, sf, name)
    return run_range(spark, lake, *raw_span(spark, lake, name), (ENTITIES[name],))


def filled_lake(spark: SparkSession, sf: str, name: str) -> tuple[Lake, DataFrame]:
    """The lake after a backfill of one entity over all its days, and the backfill's counts."""
    totals = once(_filled, spark, sf, name)
    return raw_lake(spark, sf, name), totals


def fresh(spark: SparkSession, sf: str, label: str, *names: str) -> Lake:
    """The shared raw lines, with a folder of its own for the tables."""
    return Lake(root=scratch_dir(spark, label), raw=raw_lake(spark, sf, *names).raw)


# --- scans and sinks -----------------------------------------------------------------------------


def raw_days(spark, sf):
    """All trips by the day they were ordered, a folder each: thousands of days, listed by their names."""
    root = scratch_dir(spark, "day-folders")
    rows = load(spark, sf, "v_trips").select("trip_id", F.col("ingest_date").alias("date"))
    rows.repartition(64, "date").write.partitionBy("date").json(root)
    return list_days(spark, root)


def jsonl_typed(spark, sf):
    rows = read_jsonl(spark, raw_lake(spark, sf, "ratings").raw_entity("ratings"), RATINGS.schema)
    return rows.select(
        "rating_id",
        F.coalesce(F.col("stars").cast("string"), F.lit("null")).alias("stars"),
        F.coalesce("tags", F.lit("null")).alias("tags"),
        F.date_format("rated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("rated_at"),
    )


def malformed_lines(spark, sf):
    """All trips as raw lines, some cut off and some with a fare that is no number, counted by day in one scan."""
    lake = Lake(root=scratch_dir(spark, "malformed"), raw=scratch_dir(spark, "malformed-raw"))
    rows = batched(spark, sf, "trips")
    line = F.to_json(F.struct(*TRIPS.schema.names))
    number = F.substring("trip_id", 4, 8).cast("int")
    spoilt = (
        F.when(number % 89 == 0, F.expr("substr(line, 1, length(line) - 9)"))
        .when(number % 97 == 0, F.regexp_replace("line", '"fare_vnd":-?[0-9]+', '"fare_vnd":"free"'))
        .when(number % 101 == 0, F.lit("{}"))
        .otherwise(F.col("line"))
    )
    lines = rows.select("trip_id", "batch_day", line.alias("line")).select(spoilt.alias("value"), F.col("batch_day").alias("date"))
    lines.hint("rebalance", F.col("date")).write.partitionBy("date").text(lake.raw_entity("trips"))
    return line_counts(spark, lake, TRIPS)


def jsonl_inferred(spark, sf):
    rows = read_jsonl(spark, raw_lake(spark, sf, "trips").raw_entity("trips"))
    return rows.groupBy(
        "status",
        F.typeof("fare_vnd").alias("fare_type"),
        F.typeof("request_time").alias("time_type"),
        F.col("_meta.schema_version").alias("schema_version"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("fare_vnd").alias("fare_vnd"),
        F.max("_meta.batch_id").alias("last_batch"),
    )


def bronze_roundtrip(spark, sf):
    lake = fresh(spark, sf, "bronze", "trips")
    raw = read_days(spark, lake.raw_entity("trips"), TRIPS.schema)
    append_partitioned(with_audit(raw, F.col("date")).drop("date"), lake.bronze("trips"))
    bronze = read_table(spark, lake.bronze("trips"), TRIPS.bronze_schema)
    return bronze.groupBy("ingest_date", "_batch_id", "_source").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_ingested_at").alias("stamped"),
        F.count("rider_id").alias("riders"),
        F.sum(F.col("fare_vnd").cast("bigint")).alias("fare_vnd"),
        F.date_format(F.max("request_time"), "yyyy-MM-dd HH:mm:ss").alias("last_request"),
    )


def bronze_day(spark, sf):
    lake, _ = filled_lake(spark, sf, "trips")
    day = on_day(read_table(spark, lake.bronze("trips"), TRIPS.bronze_schema), ONE_DAY)
    return day.select("trip_id", "status", "city", "fare_vnd", "ingest_date")


def first_trips(spark, sf):
    lake, _ = filled_lake(spark, sf, "trips")
    silver = read_table(spark, lake.silver("trips"), TRIPS.silver_schema)
    return sample_rows(silver, "trip_id", 10).select("trip_id", "status", "fare_vnd")


def replace_idempotent(spark, sf):
    """Three writes of all days, the last one without rows for one of them.

    The rows are deduped and gathered by day once, so what is offered three times lies within a day already.
    """
    path, offered = scratch_dir(spark, "replace"), scratch_dir(spark, "offered")
    days = [row["date"] for row in raw_day_list(spark, sf)]
    size_shuffles(spark, raw_lake(spark, sf, "payments").raw_entity("payments"), only_up=True)
    best = dedupe(batched(spark, sf, "payments"), ["batch_day", "payment_id"], newest=PAYMENTS.newest)
    best = best.withColumnRenamed("batch_day", "ingest_date")
    with setting(spark, CODEC, "zstd"):
        with small_sorts(spark):
            replace_days(spark, best, offered, days)
        rows = spark.read.schema(best.schema).parquet(offered)
        replace_days(spark, rows, path, days, gather=False)
        replace_days(spark, rows, path, days, gather=False)
        replace_days(spark, rows.filter(F.col("ingest_date") != ONE_DAY), path, days, gather=False)
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("fare_vnd").cast("bigint")).alias("fare_vnd")
    )


def replace_listed_days(spark, sf):
    """All days are offered again with an added mark; only the listed ones, of odd months, are replaced."""
    path = scratch_dir(spark, "listed")
    rows = batched(spark, sf, "trips").select(
        "trip_id", F.lit(0).alias("mark"), F.col("batch_day").alias("ingest_date")
    )
    days = [row["date"] for row in list_days(spark, raw_lake(spark, sf, "trips").raw_entity("trips")).collect()]
    replace_days(spark, rows, path, days)
    replace_days(spark, rows.withColumn("mark", F.lit(1)), path, [day for day in days if int(day[6]) % 2])
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("mark").alias("marked")
    )


def raw_day_list(spark, sf):
    """One value per delivered month."""
    return list_days(spark, raw_lake(spark, sf, "payments").raw_entity("payments")).collect()


def newest_runs(spark, sf):
    """A run log with one run per day of trips; the newest 20."""
    path = scratch_dir(spark, "runs")
    runs = (
        load(spark, sf, "v_trips")
        .groupBy("ingest_date")
        .agg(F.max("request_time").cast("timestamp").alias("run_at"), F.count("*").alias("n"))
        .select(
            F.concat(F.lit("run-"), "ingest_date").alias("id"),
            "run_at",
            F.col("ingest_date").alias("target_date"),
            F.lit("medallion_daily").alias("dag_id"),
            F.when(F.col("n") % 5 == 0, "failed").otherwise("success").alias("status"),
        )
    )
    runs.write.mode("append").parquet(path)
    newest = latest_runs(read_table(spark, path, RUNS_SCHEMA), 20)
    return newest.withColumn("run_at", F.date_format("run_at", "yyyy-MM-dd HH:mm:ss"))


# --- jobs ----------------------------------------------------------------------------------------


def daily_run(spark, sf):
    """Both layers for one delivered month, and the tables it leaves."""
    lake = fresh(spark, sf, "daily", *ENTITIES)
    done = {
        **run_day(spark, lake, ONE_DAY, (TRIPS, PAYMENTS)),
        **run_day(spark, lake, RATINGS_DAY, (RATINGS,)),
    }
    parts = []
    for name, (landed, split) in done.items():
        entity = ENTITIES[name]
        silver = read_table(spark, lake.silver(name), entity.silver_schema)
        rejected = read_table(spark, lake.quarantine(name), entity.quarantine_schema)
        both = silver.select(
            "_silver_at", F.lit("valid").alias("layer"), F.lit("none").alias("reason")
        ).unionByName(
            rejected.select(
                "_silver_at",
                F.lit("quarantine").alias("layer"),
                F.col("quarantine_reason").alias("reason"),
            )
        )
        counted = both.groupBy("layer", "reason").agg(F.count("_silver_at").alias("n"))
        parts.append(
            counted.select(
                F.lit(name).alias("entity"),
                "layer",
                "reason",
                "n",
                F.lit(landed.written).cast("bigint").alias("landed"),
                F.lit(split.evaluated).cast("bigint").alias("evaluated"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def backfill(spark, sf):
    totals = [filled_lake(spark, sf, name)[1] for name in ENTITIES]
    return reduce(DataFrame.unionByName, totals)


def backfill_missing_day(spark, sf):
    """All trips, then a backfill from raw lines that lack a day and the trips without a driver.

    The day that is missing keeps the rows of the first run, and so do those of which no trip is left.
    """
    lake = fresh(spark, sf, "missing", "trips")
    run_range(spark, lake, *raw_span(spark, lake, "trips"), (TRIPS,))
    later = Lake(root=lake.root, raw=scratch_dir(spark, "missing-raw"))
    rows = batched(spark, sf, "trips").filter((F.col("batch_day") != ONE_DAY) & F.col("driver_id").isNotNull())
    deliver(spark, sf, "trips", rows, later)
    totals = run_range(spark, later, *raw_span(spark, lake, "trips"), (TRIPS,))
    status = latest_runs(read_table(spark, lake.runs, RUNS_SCHEMA), 1).first()["status"]
    return totals.drop("entity").filter("bronze_rows > 0").withColumn("status", F.lit(status))


def _stored(name: str, layer: str):
    def run(spark, sf):
        lake, _ = filled_lake(spark, sf, name)
        entity = ENTITIES[name]
        if layer == "valid":
            rows = read_table(spark, lake.silver(name), entity.silver_schema)
        else:
            rows = read_table(spark, lake.quarantine(name), entity.quarantine_schema)
        return rows.select(
            "ingest_date",
            F.coalesce(entity.key, F.lit("null")).alias("key"),
            F.date_format(EVENT_TIME[name], "yyyy-MM-dd HH:mm:ss").alias("at"),
        )

    return run


def _stored_sql(name: str, layer: str) -> str:
    return oracle(f"""SELECT batch_day AS ingest_date,
  coalesce({ENTITIES[name].key}, 'null') AS key,
  strftime({EVENT_TIME[name]}, '%Y-%m-%d %H:%M:%S') AS at
FROM ({deduped_sql(name)}) d WHERE {'' if layer == 'valid' else 'NOT '}{passes_sql(name)}""")


def medallion_flow(spark, sf):
    """Trips from raw lines to Silver; valid trips per status."""
    lake, _ = filled_lake(spark, sf, "trips")
    silver = read_table(spark, lake.silver("trips"), TRIPS.silver_schema)
    return silver.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("fare_vnd").cast("bigint")).alias("fare_vnd")
    )


def recon_raw_bronze(spark, sf):
    """Raw by the comparison rules against Bronze as it is: days with bad rows show up."""
    lake, _ = filled_lake(spark, sf, "payments")
    return reconcile_raw(spark, lake, PAYMENTS, recon_filter(PAYMENTS, "ingest_date"))


def recon_raw_rows(spark, sf):
    """The same comparison by key, for the month that holds all ratings."""
    lake, _ = filled_lake(spark, sf, "ratings")
    found = reconcile_raw_rows(spark, lake, RATINGS, RATINGS_DAY, recon_filter(RATINGS))
    lost = found.lost_keys.select(F.lit("lost").alias("side"), "rating_id")
    return lost.unionByName(found.extra_keys.select(F.lit("extra").alias("side"), "rating_id"))


def _backfill_sql() -> str:
    parts = []
    for name in ENTITIES:
        parts.append(f"""SELECT '{name}' AS entity, day AS ingest_date,
  (SELECT count(*) FROM ({batched_sql(name)}) b WHERE b.batch_day = day) AS bronze_rows,
  (SELECT count(*) FROM ({deduped_sql(name)}) d
    WHERE d.batch_day = day AND {passes_sql(name)}) AS valid_rows,
  (SELECT count(*) FROM ({deduped_sql(name)}) d
    WHERE d.batch_day = day AND NOT {passes_sql(name)}) AS quarantine_rows
FROM (SELECT CAST(CAST(unnest(generate_series(min(CAST(batch_day AS DATE)), max(CAST(batch_day AS DATE)),
  INTERVAL '1' DAY)) AS DATE) AS VARCHAR) AS day FROM ({batched_sql(name)}) b) days""")
    return oracle("\nUNION ALL\n".join(parts))


def _daily_sql() -> str:
    parts = []
    for name in ENTITIES:
        day = RATINGS_DAY if name == "ratings" else ONE_DAY
        for layer, reason, condition in (
            ("valid", "none", ""),
            ("quarantine", "Failed Data Quality Checks at Silver Layer", "NOT "),
        ):
            parts.append(f"""SELECT '{name}' AS entity, '{layer}' AS layer, '{reason}' AS reason,
  (SELECT count(*) FROM ({batched_sql(name)}) b WHERE batch_day = '{day}') AS landed,
  count(*) AS evaluated, count(*) FILTER (WHERE {condition}{passes_sql(name)}) AS n
FROM ({deduped_sql(name)}) d WHERE batch_day = '{day}'""")
    return oracle("\nUNION ALL\n".join(parts))


QUERIES = {
    "medallion_flow": Query(
        medallion_flow,
        oracle(f"""SELECT status, count(*) AS n, CAST(sum(fare_vnd) AS BIGINT) AS fare_vnd
FROM ({deduped_sql('trips')}) d WHERE {SILVER_SQL['trips']} GROUP BY status"""),
    ),
    "list_days": Query(
        raw_days, oracle("SELECT DISTINCT ingest_date AS date FROM {v_trips}")
    ),
    "jsonl_typed": Query(
        jsonl_typed,
        oracle("""SELECT rating_id, coalesce(CAST(stars AS VARCHAR), 'null') AS stars,
  coalesce(tags, 'null') AS tags, strftime(rated_at, '%Y-%m-%d %H:%M:%S.%f') AS rated_at
FROM {v_ratings}"""),
    ),
    "malformed_lines": Query(
        malformed_lines,
        oracle(f"""SELECT batch_day AS ingest_date, count(*) AS lines, count(*) FILTER (n % 89 = 0) AS broken,
  count(*) FILTER (n % 89 <> 0 AND n % 97 = 0) AS damaged
FROM (SELECT batch_day, CAST(substr(trip_id, 4) AS INT) AS n FROM ({batched_sql('trips')}) b) t GROUP BY batch_day"""),
    ),
    "jsonl_inferred": Query(
        jsonl_inferred,
        oracle("""SELECT status, 'bigint' AS fare_type, 'string' AS time_type,
  '1.0' AS schema_version, count(*) AS n, CAST(sum(fare_vnd) AS BIGINT) AS fare_vnd,
  max(strftime(time_bucket(INTERVAL '15 minutes', request_time), '%Y%m%d_%H%M')) AS last_batch
FROM {v_trips} GROUP BY status"""),
    ),
    "bronze_roundtrip": Query(
        bronze_roundtrip,
        oracle(f"""SELECT batch_day AS ingest_date, batch_day AS _batch_id,
  'simulator' AS _source, count(*) AS n, count(*) AS stamped, count(rider_id) AS riders,
  CAST(sum(fare_vnd) AS BIGINT) AS fare_vnd,
  strftime(max(request_time), '%Y-%m-%d %H:%M:%S') AS last_request
FROM ({batched_sql('trips')}) b GROUP BY batch_day"""),
    ),
    "bronze_day": Query(
        bronze_day,
        oracle(f"""SELECT trip_id, status, city, fare_vnd, batch_day AS ingest_date
FROM ({batched_sql('trips')}) b WHERE batch_day = '{ONE_DAY}'"""),
    ),
    "sample_rows": Query(
        first_trips,
        oracle(f"""SELECT trip_id, status, fare_vnd FROM ({deduped_sql('trips')}) d
WHERE {SILVER_SQL['trips']} ORDER BY trip_id LIMIT 10"""),
    ),
    "replace_idempotent": Query(
        replace_idempotent,
        oracle(f"""SELECT batch_day AS ingest_date, count(*) AS n,
  CAST(sum(fare_vnd) AS BIGINT) AS fare_vnd
FROM ({deduped_sql('payments')}) d WHERE batch_day <> '{ONE_DAY}' GROUP BY batch_day"""),
    ),
    "replace_listed_days": Query(
        replace_listed_days,
        oracle(f"""SELECT batch_day AS ingest_date, count(*) AS n,
  CAST(sum(CAST(substr(batch_day, 7, 1) AS INT) % 2) AS BIGINT) AS marked
FROM ({batched_sql('trips')}) b GROUP BY batch_day"""),
    ),
    "backfill_missing_day": Query(
        backfill_missing_day,
        oracle(f"""SELECT batch_day AS ingest_date, count(*) AS bronze_rows,
  count(*) FILTER (WHERE {passes_sql('trips')}) AS valid_rows,
  count(*) FILTER (WHERE NOT {passes_sql('trips')}) AS quarantine_rows, 'incomplete' AS status
FROM (SELECT *, count(driver_id) OVER (PARTITION BY batch_day) AS drivers FROM ({batched_sql('trips')}) b) b
WHERE batch_day = '{ONE_DAY}' OR drivers = 0 OR driver_id IS NOT NULL GROUP BY batch_day"""),
    ),
    "latest_runs": Query(
        newest_runs,
        oracle("""SELECT 'run-' || ingest_date AS id,
  strftime(max(request_time), '%Y-%m-%d %H:%M:%S') AS run_at, ingest_date AS target_date,
  'medallion_daily' AS dag_id,
  CASE WHEN count(*) % 5 = 0 THEN 'failed' ELSE 'success' END AS status
FROM {v_trips} GROUP BY ingest_date ORDER BY max(request_time) DESC, id LIMIT 20"""),
    ),
    "daily_run": Query(daily_run, _daily_sql()),
    "backfill": Query(backfill, _backfill_sql()),
    **{
        f"backfill_{name}_{layer}": Query(_stored(name, layer), _stored_sql(name, layer))
        for name in ENTITIES
        for layer in ("valid", "quarantine")
    },
    "recon_raw_rows": Query(
        recon_raw_rows,
        oracle(f"""SELECT 'extra' AS side, rating_id FROM ({batched_sql('ratings')}) b
WHERE batch_day = '{RATINGS_DAY}' AND NOT coalesce({RECON_SQL['ratings']}, false)"""),
    ),
    "recon_raw_bronze": Query(
        recon_raw_bronze,
        oracle(f"""WITH r AS (SELECT batch_day, count(*) AS n FROM ({deduped_sql('payments')}) d
  WHERE {RECON_SQL['payments']} GROUP BY batch_day),
s AS (SELECT batch_day, count(*) AS n FROM ({batched_sql('payments')}) b GROUP BY batch_day)
SELECT coalesce(r.batch_day, s.batch_day) AS ingest_date, coalesce(r.n, 0) AS raw_rows,
  coalesce(s.n, 0) AS stored_rows, coalesce(r.n, 0) - coalesce(s.n, 0) AS difference
FROM r FULL JOIN s ON r.batch_day = s.batch_day WHERE coalesce(r.n, 0) <> coalesce(s.n, 0)"""),
    ),
}
