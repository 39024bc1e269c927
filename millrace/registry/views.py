"""Ride entities derived from the test tables, in SQL that Spark and DuckDB both run.

The test tables hold no rides, so trips come from orders, payments from lineitem and ratings from
events. Faults are spread by modulus. ``{name}`` stands for a table or another view.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.files import total_bytes
from millrace.session import scratch_dir, size_reads, size_shuffles

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Great circle in km between the pickup and dropoff columns of a row.
DIRECT_KM = """(1.2742e4 * asin(sqrt(
  power(sin(radians(dropoff_lat - pickup_lat) / 2e0), 2e0)
  + cos(radians(pickup_lat)) * cos(radians(dropoff_lat))
  * power(sin(radians(dropoff_lng - pickup_lng) / 2e0), 2e0))))"""

VIEWS = {
    "v_trip_places": """
SELECT *, 1.07e1 + (o_orderkey % 100) * 1e-3 AS pickup_lat,
  1.066e2 + (o_custkey % 100) * 1e-3 AS pickup_lng,
  1.07e1 + (o_custkey % 90) * 1e-3 AS dropoff_lat,
  1.066e2 + (o_orderkey % 80) * 1e-3 AS dropoff_lng,
  o_orderdate + INTERVAL '1' SECOND * CAST((o_orderkey * 7919) % 86400 AS INT) AS request_time
FROM {orders}""",
    "v_trip_steps": f"""
SELECT *,
  CASE WHEN o_orderstatus <> 'P'
    THEN request_time + INTERVAL '1' SECOND * CAST(20 + o_orderkey % 480 AS INT)
    END AS pickup_time,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 57 + 3 AS INT) END AS duration_min,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL
    WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey % 300 AS DOUBLE) / 1e1
    ELSE round((1.2e0 + (o_orderkey % 40) * 1e-2) * {DIRECT_KM}, 2) END AS distance_km
FROM {{v_trip_places}}""",
    "v_trips": """
SELECT 'TRP' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS trip_id,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 71 <> 0 THEN NULL
    ELSE 'DRV' || lpad(CAST(o_orderkey % 500 + 1 AS STRING), 5, '0') END AS driver_id,
  CASE WHEN o_orderkey % 100 = 7 THEN NULL
    ELSE 'RDR' || lpad(CAST(o_custkey AS STRING), 6, '0') END AS rider_id,
  request_time, pickup_time,
  CASE WHEN o_orderstatus = 'F'
    THEN pickup_time + INTERVAL '1' SECOND
      * (duration_min * 60 + CASE WHEN o_orderkey % 31 = 0 THEN 60 ELSE 0 END)
    END AS dropoff_time,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled' ELSE 'no_driver' END
    AS status,
  CASE WHEN o_orderkey % 97 = 0 THEN 'DANANG' WHEN o_custkey % 3 < 2 THEN 'HCMC'
    ELSE 'HANOI' END AS city,
  'Z' || CAST(o_orderkey % 10 AS STRING) AS pickup_zone, pickup_lat, pickup_lng,
  'Z' || CAST(o_custkey % 10 AS STRING) AS dropoff_zone, dropoff_lat, dropoff_lng,
  distance_km, duration_min,
  CASE WHEN o_orderstatus <> 'F' THEN 0
    ELSE CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE 1 END
      * CASE WHEN o_orderkey % 4 = 0 THEN CAST(floor(o_totalprice) AS INT)
        ELSE 1000 * CAST(floor((1.2e4 + 5.5e3 * coalesce(distance_km, 1e1))
          * (9e-1 + (o_orderkey % 40) * 1e-2) / 1e3) AS INT) END
    END AS fare_vnd,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS ingest_date
FROM {v_trip_steps}""",
    "v_payments": """
SELECT 'PAY' || lpad(CAST(l_orderkey AS STRING), 8, '0') || '-' || CAST(l_linenumber AS STRING)
    AS payment_id,
  'TRP' || lpad(CAST(l_orderkey AS STRING), 8, '0') AS trip_id,
  'RDR' || lpad(CAST(l_partkey AS STRING), 6, '0') AS rider_id,
  payment_time, payment_method, fare_vnd, promo_code, discount_vnd,
  final_amount_vnd, payment_status,
  CAST(CASE WHEN final_amount_vnd < 0 THEN ceil(final_amount_vnd * 2e-1)
    ELSE floor(final_amount_vnd * 2e-1) END AS INT)
    + CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END AS platform_fee_vnd,
  CAST(CASE WHEN final_amount_vnd < 0 THEN ceil(final_amount_vnd * 8e-1)
    ELSE floor(final_amount_vnd * 8e-1) END AS INT) AS driver_earning_vnd,
  CAST(CAST(payment_time AS DATE) AS STRING) AS ingest_date,
  l_partkey, l_suppkey
FROM (
  SELECT *,
    CASE WHEN l_partkey % 41 = 0 THEN NULL
      WHEN l_suppkey % 50 = 0 THEN -fare_vnd
      WHEN payment_status = 'success' THEN greatest(fare_vnd - discount_vnd, 10000)
      WHEN l_partkey % 3 = 0 THEN fare_vnd ELSE 0 END AS final_amount_vnd
  FROM (
    SELECT *,
      CAST(floor(fare_vnd * CASE promo_code WHEN 'RIDE10' THEN 1e-1 WHEN 'GRAB20' THEN 2e-1
        WHEN 'NEWUSER30' THEN 3e-1 ELSE 0e0 END) AS INT)
        + CASE WHEN l_partkey % 23 = 0 THEN 1 ELSE 0 END AS discount_vnd
    FROM (
      SELECT *, l_shipdate AS payment_time,
        CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN 'cash' WHEN 1 THEN 'momo'
          WHEN 2 THEN 'zalopay' WHEN 3 THEN 'credit_card' WHEN 4 THEN 'vnpay'
          ELSE 'unknown_method' END AS payment_method,
        CAST(floor(l_extendedprice) AS INT) AS fare_vnd,
        CASE CAST(l_suppkey % 7 AS INT) WHEN 0 THEN 'RIDE10' WHEN 1 THEN 'GRAB20'
          WHEN 2 THEN 'NEWUSER30' END AS promo_code,
        CASE l_returnflag WHEN 'A' THEN 'success' WHEN 'N' THEN 'refunded' ELSE 'failed' END
          AS payment_status
      FROM {lineitem}) p1) p2) p3""",
    "v_ratings": """
SELECT 'RTG' || lpad(CAST(event_id AS STRING), 8, '0') AS rating_id,
  CASE WHEN event_id % 101 = 0 THEN NULL
    ELSE 'TRP' || lpad(CAST(user_id * 100 AS STRING), 8, '0') END AS trip_id,
  'RDR' || lpad(CAST(user_id AS STRING), 6, '0') AS rater_id,
  'DRV' || lpad(CAST(event_id % 500 + 1 AS STRING), 5, '0') AS ratee_id,
  CASE event_type WHEN 'error' THEN 'system' WHEN 'click' THEN 'rider' WHEN 'view' THEN 'rider'
    ELSE 'driver' END AS rater_type,
  CASE WHEN event_type IN ('click', 'view') THEN 'driver' ELSE 'rider' END AS ratee_type,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(event_id % 7 AS INT) END AS stars,
  CASE WHEN event_type = 'click' THEN 'a|b' WHEN event_type = 'view' THEN 'c' END AS tags,
  ts AS rated_at,
  CAST(CAST(ts AS DATE) AS STRING) AS ingest_date
FROM {events}""",
    # Payments and ratings timed against their trip's end, some outside the allowed delays.
    "v_timed_payments": """
SELECT p.payment_id, p.trip_id, p.l_partkey, p.l_suppkey,
  t.dropoff_time + INTERVAL '1' SECOND * CAST(p.l_partkey % 40 AS INT) AS payment_time
FROM {v_payments} p JOIN {v_trips} t ON p.trip_id = t.trip_id""",
    "v_timed_ratings": """
SELECT r.rating_id, r.trip_id, r.rater_type,
  t.dropoff_time + INTERVAL '1' SECOND
    * CAST((CAST(substr(r.rating_id, 4) AS INT) * 53) % 4000 AS INT) AS rated_at
FROM {v_ratings} r JOIN {v_trips} t ON r.trip_id = t.trip_id""",
    "v_drivers": """
SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN 'HCMC' ELSE 'HANOI' END AS city,
  s_suppkey % 10 <> 0 AS is_active
FROM {supplier}""",
}


#: Test tables below this size are spread by a shuffle, as one may be a single row group, which one task reads alone.
SPREAD_BELOW = 64 * 1024 * 1024
#: Row groups of staged tables: what a task reads of one at least.
ROW_GROUP_BYTES = 64 * 1024 * 1024

_BUILT: dict[tuple, object] = {}


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or a derived view as a table of its own."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.read.parquet(once(_stage, spark, sf_dir, name))


def once(build: Callable, spark: SparkSession, sf_dir: str, *args):
    """``build(spark, sf_dir, *args)``, called once per application."""
    key = (build, spark.sparkContext.applicationId, sf_dir, *args)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir, *args)
    return _BUILT[key]


def _stage(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write a view as a table, as the operators expect plain columns.

    A large table is written by the tasks that read it. A small one is spread over all cores by a hash of its rows: that
    needs no sort of what a task reads, as dealing the rows out in turn does.
    """
    path = f"{scratch_dir(spark, 'views')}/{name}"
    size_reads(spark)
    rows = derived(spark, sf_dir, name)
    if is_small(spark, sf_dir, name):
        rows = spread(rows, spark.sparkContext.defaultParallelism)
    rows.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    size_shuffles(spark, path, only_up=True)
    return path


def spread(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, *rows.columns)


def _tables(name: str) -> set[str]:
    """The test tables that a view is made from."""
    return {name} if name in TABLES else set().union(*(_tables(need) for need in _needs(VIEWS[name])))


def is_small(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether all test tables behind a view are too small to be read by many tasks."""
    return all(total_bytes(spark, f"{sf_dir}/{table}.parquet") < SPREAD_BELOW for table in _tables(name))


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return load(spark, sf_dir, name)
    text = VIEWS[name]
    return spark.sql(text, **{need: derived(spark, sf_dir, need) for need in _needs(text)})


def oracle(body: str) -> str:
    """DuckDB text of a query: the views it names, then its body."""
    clauses: dict[str, str] = {}

    def add(text: str) -> str:
        for need in _needs(text):
            if need in VIEWS and need not in clauses:
                view = add(VIEWS[need])
                clauses[need] = view
        return text.format(**{need: need for need in _needs(text)})

    final = add(body)
    views = ",\n".join(f"{name} AS ({text.strip()}\n)" for name, text in clauses.items())
    lead = final.lstrip()
    if not views:
        return lead
    if lead.upper().startswith("WITH "):
        return f"WITH {views},\n{lead[5:]}"
    return f"WITH {views}\n{lead}"
