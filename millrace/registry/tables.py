"""Operators on tables: rules, dedupe, joins, reconciliation and ride audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.entities import ENTITIES, TRIPS
from millrace.functions.geo import haversine_km
from millrace.operators.dedupe import dedupe, distinct_keys, repeated_keys
from millrace.operators.digests import compare_keys_by_digest
from millrace.operators.integrity import orphans, rows_with_keys, rows_without_keys
from millrace.operators.quality import audit, split_by_rules, verdict_counts, violation_profile
from millrace.operators.reconcile import compare_counts, extra_keys, lost_keys, metric_diff
from millrace.operators import rides
from millrace.plans.reconciliation import reconcile_counts, reconcile_rows, recon_filter
from millrace.registry import Query
from millrace.registry.views import DIRECT_KM, load, oracle

# Orders that settle which copy of a key survives.
ORDERS = {
    "trips": (),
    "payments": ("payment_time", "l_partkey", "l_suppkey", "fare_vnd"),
    "ratings": (),
}


def _entity_rows(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load(spark, sf, f"v_{name}")


def _deduped(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = _entity_rows(spark, sf, name)
    return dedupe(rows, ENTITIES[name].key, ORDERS[name])


def _text(column: str):
    """Integers that may be null, as text, so that both engines hand back the same type."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null")).alias(column)


# --- rules as SQL, for the oracles -------------------------------------------------------------

SILVER_SQL = {
    "trips": """trip_id IS NOT NULL AND rider_id IS NOT NULL
  AND status IN ('completed', 'cancelled', 'no_driver') AND city IN ('HCMC', 'HANOI')
  AND fare_vnd >= 0 AND distance_km >= 0e0""",
    "payments": """payment_id IS NOT NULL AND trip_id IS NOT NULL
  AND payment_status IN ('success', 'refunded', 'failed') AND final_amount_vnd >= 0
  AND payment_method IN ('cash', 'momo', 'zalopay', 'credit_card', 'vnpay')""",
    "ratings": """rating_id IS NOT NULL AND trip_id IS NOT NULL
  AND stars BETWEEN 1 AND 5 AND rater_type IN ('rider', 'driver')""",
}
RECON_SQL = {
    "trips": """trip_id IS NOT NULL AND rider_id IS NOT NULL
  AND status IN ('completed', 'cancelled', 'no_driver') AND city IN ('HCMC', 'HANOI')""",
    "payments": """payment_id IS NOT NULL AND trip_id IS NOT NULL
  AND payment_status IN ('success', 'refunded', 'failed')""",
    "ratings": "rating_id IS NOT NULL AND trip_id IS NOT NULL AND stars BETWEEN 1 AND 5",
}
DEDUPED_SQL = {
    "trips": "SELECT * FROM {v_trips}",
    "payments": """SELECT * FROM {v_payments} QUALIFY row_number() OVER (PARTITION BY payment_id
  ORDER BY payment_time, l_partkey, l_suppkey, fare_vnd) = 1""",
    "ratings": "SELECT * FROM {v_ratings}",
}
RULE_SQL = {
    "trips": {
        "trip_id_present": "trip_id IS NOT NULL",
        "rider_id_present": "rider_id IS NOT NULL",
        "status_known": "status IN ('completed', 'cancelled', 'no_driver')",
        "city_known": "city IN ('HCMC', 'HANOI')",
        "fare_vnd_not_below_0": "fare_vnd >= 0",
        "distance_km_not_below_0": "distance_km >= 0",
    },
    "payments": {
        "payment_id_present": "payment_id IS NOT NULL",
        "trip_id_present": "trip_id IS NOT NULL",
        "payment_status_known": "payment_status IN ('success', 'refunded', 'failed')",
        "final_amount_vnd_not_below_0": "final_amount_vnd >= 0",
        "payment_method_known":
            "payment_method IN ('cash', 'momo', 'zalopay', 'credit_card', 'vnpay')",
    },
    "ratings": {
        "rating_id_present": "rating_id IS NOT NULL",
        "trip_id_present": "trip_id IS NOT NULL",
        "stars_in_1_5": "stars BETWEEN 1 AND 5",
        "rater_type_known": "rater_type IN ('rider', 'driver')",
    },
}


def failed_sql(rules: dict[str, str]) -> str:
    parts = [f"CASE WHEN NOT coalesce({sql}, false) THEN '{n}' END" for n, sql in rules.items()]
    return f"concat_ws(',', {', '.join(parts)})"


def audit_sql(source: str, rules: dict[str, str], columns: str) -> str:
    return f"""SELECT * FROM (SELECT {columns}, {failed_sql(rules)} AS failed FROM {source}) a
WHERE failed <> ''"""


def _failed(df: DataFrame, rules, *columns) -> DataFrame:
    return audit(df, rules).select(*columns, F.array_join("failed_rules", ",").alias("failed"))


# --- dedupe, rules, split ------------------------------------------------------------------------

PAYMENT_COLUMNS = (
    "payment_id, trip_id, payment_method, payment_status, fare_vnd, l_partkey, l_suppkey"
)


def dedupe_payments(spark, sf):
    return _deduped(spark, sf, "payments").select(
        *PAYMENT_COLUMNS.split(", "),
        F.date_format("payment_time", "yyyy-MM-dd HH:mm:ss").alias("paid_at"),
    )


def _dedupe_null_keys(null_keys):
    def run(spark, sf):
        rows = _entity_rows(spark, sf, "ratings")
        return dedupe(rows, "trip_id", ("rated_at", "rating_id"), null_keys).select(
            F.coalesce("trip_id", F.lit("null")).alias("trip_id"), "rating_id"
        )

    return run


def _rated_once(condition: str) -> str:
    return oracle(f"""SELECT coalesce(trip_id, 'null') AS trip_id, rating_id FROM (
  SELECT trip_id, rating_id,
    row_number() OVER (PARTITION BY trip_id ORDER BY rated_at, rating_id) AS n
  FROM {{v_ratings}}) r WHERE {condition}""")


SPLIT_COLUMNS = {
    "trips": ("trip_id", "status", "city", "fare_vnd"),
    "payments": ("payment_id", "payment_method", "payment_status", "l_partkey"),
    "ratings": ("rating_id", "rater_type"),
}


def _split(name: str, side: int):
    def run(spark, sf):
        halves = split_by_rules(_deduped(spark, sf, name), ENTITIES[name].rules)
        return halves[side].select(*SPLIT_COLUMNS[name])

    return run


def _split_sql(name: str, side: int) -> str:
    condition = f"coalesce({SILVER_SQL[name]}, false)"
    return oracle(
        f"SELECT {', '.join(SPLIT_COLUMNS[name])} FROM ({DEDUPED_SQL[name]}) d "
        f"WHERE {'NOT ' if side else ''}{condition}"
    )


def _per_entity(spark, sf, build):
    parts = [build(name).withColumn("entity", F.lit(name)) for name in ENTITIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def rule_counts(spark, sf):
    return _per_entity(
        spark, sf, lambda n: verdict_counts(_deduped(spark, sf, n), ENTITIES[n].rules)
    )


def violations(spark, sf):
    return _per_entity(
        spark, sf, lambda n: violation_profile(_deduped(spark, sf, n), ENTITIES[n].rules)
    )


# --- joins, set difference, reconciliation -------------------------------------------------------


def _order_keys(spark, sf):
    """All trips, and one row per line with its trip's id: what should be there and what is."""
    return load(spark, sf, "v_trips"), load(spark, sf, "v_payments")


def orders_without_lines(spark, sf):
    return lost_keys(*_order_keys(spark, sf), "trip_id")


def missing_rows(spark, sf):
    trips, lines = _order_keys(spark, sf)
    lost = lost_keys(trips, lines, "trip_id")
    return rows_with_keys(trips, lost, "trip_id").select("trip_id", "status", "city", "fare_vnd")


def _valid_completed(trips: DataFrame) -> DataFrame:
    return trips.transform(recon_filter(TRIPS)).filter(F.col("status") == "completed")


def extra_trip_keys(spark, sf):
    trips, lines = _order_keys(spark, sf)
    return extra_keys(_valid_completed(trips), lines, "trip_id")


def extra_rows(spark, sf):
    trips, lines = _order_keys(spark, sf)
    extra = rows_without_keys(lines, _valid_completed(trips), "trip_id")
    return extra.select("trip_id", "payment_id", "l_partkey")


def orphan_payments(spark, sf):
    trips, payments = _order_keys(spark, sf)
    completed = trips.filter(F.col("status") == "completed")
    return orphans(payments, completed, "trip_id").select(
        "payment_id", "trip_id", "l_partkey", "l_suppkey"
    )


def orphan_ratings(spark, sf):
    trips, ratings = load(spark, sf, "v_trips"), load(spark, sf, "v_ratings")
    completed = trips.filter(F.col("status") == "completed")
    return orphans(ratings, completed, "trip_id").select(
        "rating_id", F.coalesce("trip_id", F.lit("null")).alias("trip_id")
    )


def dup_keys(spark, sf):
    return repeated_keys(load(spark, sf, "v_payments"), "payment_id")


def key_projection(spark, sf):
    return distinct_keys(load(spark, sf, "v_payments"), "payment_id")


def cardinality(spark, sf):
    payments = load(spark, sf, "v_payments").filter(F.col("trip_id").isNotNull())
    ratings = load(spark, sf, "v_ratings").filter(F.col("trip_id").isNotNull())
    paid = repeated_keys(payments, "trip_id").withColumn("what", F.lit("payment"))
    rated = repeated_keys(ratings, ["trip_id", "rater_type"]).withColumnRenamed(
        "rater_type", "what"
    )
    return paid.unionByName(rated)


def fare_metric(spark, sf):
    payments = load(spark, sf, "v_payments")
    return metric_diff(payments, _deduped(spark, sf, "payments"), "fare_vnd")


def km_metric(spark, sf):
    trips = load(spark, sf, "v_trips")
    return metric_diff(trips, trips.filter("status = 'completed'"), "distance_km")


def _scaled(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Prices in cents against discounted prices in millionths."""
    lines = load(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    cut = (price * (1 - F.col("l_discount").cast("decimal(4,2)")) / 3).cast("decimal(20,6)")
    return lines.select(price.alias("price")), lines.select(cut.alias("price"))


def decimal_metric(spark, sf):
    totals = metric_diff(*_scaled(spark, sf), "price")
    return totals.select(*[F.col(c).cast("string").alias(c) for c in totals.columns])


def recon_digest(spark, sf):
    """Payments against a copy that lacks some and has others; most buckets of most days agree."""
    payments = load(spark, sf, "v_payments").select("ingest_date", "payment_id", "trip_id", "l_partkey", "l_suppkey")
    other = payments.filter("l_partkey % 701 <> 0 OR l_suppkey % 5 = 0").withColumn(
        "payment_id", F.expr("CASE WHEN l_partkey % 997 = 1 THEN payment_id || 'x' ELSE payment_id END")
    )
    return compare_keys_by_digest(payments, other, "payment_id", ["ingest_date"])


def _recon_days(name: str):
    def run(spark, sf):
        entity = ENTITIES[name]
        raw = load(spark, sf, f"v_{name}")
        stored, _ = split_by_rules(_deduped(spark, sf, name), entity.rules)
        return reconcile_counts(raw, stored, raw_filter=recon_filter(entity, "ingest_date"))

    return run


def _recon_days_sql(name: str, key: str) -> str:
    return oracle(f"""WITH raw_days AS (
  SELECT ingest_date, count(DISTINCT {key}) AS n FROM {{v_{name}}}
  WHERE {RECON_SQL[name]} GROUP BY ingest_date),
stored_days AS (
  SELECT ingest_date, count(*) AS n FROM ({DEDUPED_SQL[name]}) d
  WHERE {SILVER_SQL[name]} GROUP BY ingest_date)
SELECT coalesce(r.ingest_date, s.ingest_date) AS ingest_date, coalesce(r.n, 0) AS raw_rows,
  coalesce(s.n, 0) AS stored_rows, coalesce(r.n, 0) - coalesce(s.n, 0) AS difference
FROM raw_days r FULL JOIN stored_days s ON r.ingest_date = s.ingest_date
WHERE coalesce(r.n, 0) <> coalesce(s.n, 0)""")


def _row_differences(spark, sf):
    trips, payments = _order_keys(spark, sf)
    return reconcile_rows(trips, payments, "trip_id", raw_filter=recon_filter(TRIPS))


def recon_rows(spark, sf):
    found = _row_differences(spark, sf)
    lost = found.lost_rows.select(F.lit("lost").alias("side"), "trip_id", "fare_vnd")
    extra = found.extra_rows.select(F.lit("extra").alias("side"), "trip_id", "fare_vnd")
    return lost.unionByName(extra)


def recon_row_counts(spark, sf):
    return _row_differences(spark, sf).counts()


def volume_mismatch(spark, sf):
    """Payments against trips per day: a comparison in which whole days are on one side only."""
    payments, trips = load(spark, sf, "v_payments"), load(spark, sf, "v_trips")
    return compare_counts(payments, trips, "ingest_date")


# --- ride audits and metrics ---------------------------------------------------------------------


def haversine(spark, sf):
    direct = haversine_km("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")
    return load(spark, sf, "v_trips").select("trip_id", F.round(direct, 6).alias("direct_km"))


def distance_audit(spark, sf):
    return _failed(load(spark, sf, "v_trips"), rides.distance_rules(), "trip_id")


DISTANCE_SQL = {
    "distance_plausible": f"""distance_km BETWEEN greatest(13e-1 * {DIRECT_KM}, 5e-1) - 1e-2
    AND greatest(15e-1 * {DIRECT_KM}, 5e-1) + 1e-2"""
}


def lifecycle(spark, sf):
    return _failed(load(spark, sf, "v_trips"), rides.lifecycle_rules(), "trip_id", "status")


_WAIT = "date_diff('second', request_time, pickup_time)"
LIFECYCLE_SQL = {
    "status_known": "status IN ('completed', 'cancelled', 'no_driver')",
    "driver_fits_status": "(driver_id IS NOT NULL) = (status <> 'no_driver')",
    "pickup_fits_status": "(pickup_time IS NOT NULL) = (status <> 'no_driver')",
    "dropoff_fits_status": "(dropoff_time IS NOT NULL) = (status = 'completed')",
    "duration_fits_status": "(duration_min IS NOT NULL) = (status = 'completed')",
    "wait_in_band": f"""CASE status WHEN 'no_driver' THEN true
    WHEN 'completed' THEN {_WAIT} BETWEEN 90 AND 480
    WHEN 'cancelled' THEN {_WAIT} BETWEEN 30 AND 180 END""",
    "ride_takes_duration": """CASE WHEN status = 'completed'
    THEN date_diff('second', pickup_time, dropoff_time) = duration_min * 60 ELSE true END""",
}


def fare_band(spark, sf):
    return _failed(load(spark, sf, "v_trips"), rides.fare_rules(), "trip_id", "fare_vnd")


_MIDDLE = """((1.2e4 + distance_km * 5.5e3)
    * CASE WHEN hour(request_time) IN (7, 8, 17, 18, 19) THEN 13e-1 ELSE 1e0 END)"""
FARE_SQL = {
    "fare_in_band": f"""CASE WHEN status = 'completed' THEN fare_vnd
    BETWEEN greatest(round_even({_MIDDLE} * 9e-1 / 1e3, 0) * 1e3, 15e3)
    AND greatest(round_even({_MIDDLE} * 11e-1 / 1e3, 0) * 1e3, 15e3)
    ELSE fare_vnd = 0 END"""
}


def payment_arith(spark, sf):
    return _failed(
        load(spark, sf, "v_payments"),
        rides.payment_rules(),
        "payment_id",
        "l_partkey",
        "l_suppkey",
    )


_RATE = """CASE promo_code WHEN 'RIDE10' THEN 1e-1 WHEN 'GRAB20' THEN 2e-1
    WHEN 'NEWUSER30' THEN 3e-1 ELSE 0e0 END"""
PAYMENT_SQL = {
    "discount_follows_promo": f"discount_vnd = trunc(fare_vnd * {_RATE})",
    "final_follows_fare": """CASE WHEN payment_status = 'success'
    THEN final_amount_vnd = greatest(fare_vnd - discount_vnd, 10000)
    ELSE final_amount_vnd = 0 END""",
    "fee_is_share": "platform_fee_vnd = trunc(final_amount_vnd * 2e-1)",
    "earning_is_share": "driver_earning_vnd = trunc(final_amount_vnd * 8e-1)",
}


def promo_lookup(spark, sf):
    payments = load(spark, sf, "v_payments").withColumn("rate", rides.discount_rate())
    code = F.coalesce("promo_code", F.lit("none")).alias("promo_code")
    return payments.groupBy(code, "rate").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("fare_vnd") * F.col("rate")).cast("bigint")).alias("discount_vnd"),
    )


def time_bounds(spark, sf):
    trips = load(spark, sf, "v_trips")
    paid = rides.audit_against_trips(
        load(spark, sf, "v_timed_payments"), trips, rides.payment_time_rules()
    ).select(
        F.concat_ws("/", "payment_id", "l_partkey", "l_suppkey").alias("id"),
        F.array_join("failed_rules", ",").alias("failed"),
    )
    rated = rides.audit_against_trips(
        load(spark, sf, "v_timed_ratings"), trips, rides.rating_time_rules()
    ).select(F.col("rating_id").alias("id"), F.array_join("failed_rules", ",").alias("failed"))
    return paid.unionByName(rated)


TIME_SQL = """SELECT id, failed FROM (
  SELECT concat_ws('/', p.payment_id, p.l_partkey, p.l_suppkey) AS id,
    'paid_soon_after_dropoff' AS failed,
    date_diff('second', t.dropoff_time, p.payment_time) BETWEEN 2 AND 30 AS ok
  FROM {v_timed_payments} p JOIN {v_trips} t ON p.trip_id = t.trip_id
  WHERE t.dropoff_time IS NOT NULL
  UNION ALL
  SELECT r.rating_id, 'rated_soon_after_dropoff',
    CASE r.rater_type
      WHEN 'rider' THEN date_diff('second', t.dropoff_time, r.rated_at) BETWEEN 60 AND 1800
      WHEN 'driver' THEN date_diff('second', t.dropoff_time, r.rated_at) BETWEEN 60 AND 3600 END
  FROM {v_timed_ratings} r JOIN {v_trips} t ON r.trip_id = t.trip_id
  WHERE t.dropoff_time IS NOT NULL) a
WHERE NOT coalesce(ok, false)"""


def tag_counts(spark, sf):
    counts = rides.tag_counts(load(spark, sf, "v_ratings"))
    return counts.withColumn("positive", F.coalesce(F.col("positive").cast("string"), F.lit("-")))


def demand_15min(spark, sf):
    counted = rides.demand(load(spark, sf, "events"), "ts", by=())
    return counted.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "batch_id",
        "n",
    )


def demand_trips(spark, sf):
    counted = rides.demand(load(spark, sf, "v_trips"), "request_time")
    return counted.select("batch_id", "city", "status", "n")


def supply_by_hour(spark, sf):
    online = F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda h: F.when((F.col("s_suppkey") * 7 + h) % 24 < 13, 1).otherwise(0),
    )
    drivers = load(spark, sf, "v_drivers").withColumn("online_hours", online)
    return rides.supply_by_hour(drivers)


def daily_volume(spark, sf):
    return rides.daily_volumes({name: load(spark, sf, f"v_{name}") for name in ENTITIES})


def _union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


QUERIES = {
    "dedupe_payments": Query(
        dedupe_payments,
        oracle(
            f"SELECT {PAYMENT_COLUMNS}, strftime(payment_time, '%Y-%m-%d %H:%M:%S') AS paid_at "
            f"FROM ({DEDUPED_SQL['payments']}) d"
        ),
    ),
    "dedupe_null_keys_collapse": Query(_dedupe_null_keys("collapse"), _rated_once("n = 1")),
    "dedupe_null_keys_keep": Query(
        _dedupe_null_keys("keep"), _rated_once("n = 1 OR trip_id IS NULL")
    ),
    **{
        f"silver_{name}_{label}": Query(_split(name, side), _split_sql(name, side))
        for name in ENTITIES
        for side, label in enumerate(("valid", "quarantine"))
    },
    "rule_counts": Query(
        rule_counts,
        oracle(
            _union_all(
                f"""SELECT '{n}' AS entity, count(*) AS evaluated,
  count(*) FILTER (WHERE {SILVER_SQL[n]}) AS valid,
  count(*) - count(*) FILTER (WHERE {SILVER_SQL[n]}) AS invalid FROM ({DEDUPED_SQL[n]}) d"""
                for n in ENTITIES
            )
        ),
    ),
    "violations": Query(
        violations,
        oracle(
            _union_all(
                f"""SELECT '{n}' AS entity, '{rule}' AS rule,
  count(*) FILTER (WHERE NOT coalesce({sql}, false)) AS violations FROM ({DEDUPED_SQL[n]}) d"""
                for n in ENTITIES
                for rule, sql in RULE_SQL[n].items()
            )
        ),
    ),
    "lost_keys": Query(
        orders_without_lines,
        oracle("SELECT trip_id FROM {v_trips} EXCEPT SELECT trip_id FROM {v_payments}"),
    ),
    "missing_rows": Query(
        missing_rows,
        oracle("""SELECT trip_id, status, city, fare_vnd FROM {v_trips}
WHERE trip_id IN (SELECT trip_id FROM {v_trips} EXCEPT SELECT trip_id FROM {v_payments})"""),
    ),
    "extra_keys": Query(
        extra_trip_keys,
        oracle(f"""SELECT trip_id FROM {{v_payments}} EXCEPT SELECT trip_id FROM {{v_trips}}
WHERE {RECON_SQL['trips']} AND status = 'completed'"""),
    ),
    "extra_rows": Query(
        extra_rows,
        oracle(f"""SELECT trip_id, payment_id, l_partkey FROM {{v_payments}} WHERE trip_id NOT IN (
  SELECT trip_id FROM {{v_trips}} WHERE {RECON_SQL['trips']} AND status = 'completed')"""),
    ),
    "orphan_payments": Query(
        orphan_payments,
        oracle("""SELECT payment_id, trip_id, l_partkey, l_suppkey FROM {v_payments} p
WHERE NOT EXISTS (SELECT 1 FROM {v_trips} t
  WHERE t.trip_id = p.trip_id AND t.status = 'completed')"""),
    ),
    "orphan_ratings": Query(
        orphan_ratings,
        oracle("""SELECT rating_id, coalesce(trip_id, 'null') AS trip_id FROM {v_ratings} r
WHERE NOT EXISTS (SELECT 1 FROM {v_trips} t
  WHERE t.trip_id = r.trip_id AND t.status = 'completed')"""),
    ),
    "dup_keys": Query(
        dup_keys,
        oracle("""SELECT payment_id, count(*) AS n_rows FROM {v_payments}
GROUP BY payment_id HAVING count(*) > 1"""),
    ),
    "key_projection": Query(
        key_projection, oracle("SELECT DISTINCT payment_id FROM {v_payments}")
    ),
    "cardinality": Query(
        cardinality,
        oracle("""SELECT trip_id, 'payment' AS what, count(*) AS n_rows FROM {v_payments}
GROUP BY trip_id HAVING count(*) > 1
UNION ALL
SELECT trip_id, rater_type, count(*) FROM {v_ratings} WHERE trip_id IS NOT NULL
GROUP BY trip_id, rater_type HAVING count(*) > 1"""),
    ),
    "metric_diff_km": Query(
        km_metric,
        oracle("""SELECT CAST(r AS DOUBLE) AS raw_total, CAST(s AS DOUBLE) AS stored_total, CAST(r - s AS DOUBLE) AS difference
FROM (SELECT sum(km) AS r, sum(km) FILTER (status = 'completed') AS s
  FROM (SELECT CAST(distance_km AS DECIMAL(38,9)) AS km, status FROM {v_trips}) t) u"""),
    ),
    "metric_diff_decimal": Query(
        decimal_metric,
        """WITH p AS (SELECT CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
  CAST(l_discount AS DECIMAL(4,2)) AS off FROM lineitem),
c AS (SELECT CAST(price AS DECIMAL(20,6)) AS price, CAST(round(CAST(price * 100 AS BIGINT) * CAST((1 - off) * 100 AS BIGINT)
  * 100.0::DECIMAL(18,1) / 3, 0) AS HUGEINT) AS micro FROM p)
SELECT CAST(CAST(sum(price) AS DECIMAL(38,6)) AS VARCHAR) AS raw_total,
  CAST(CAST(CAST(sum(micro) AS DECIMAL(38,0)) / 1000000 AS DECIMAL(38,6)) AS VARCHAR) AS stored_total,
  CAST(CAST(sum(price) AS DECIMAL(38,6)) - CAST(CAST(sum(micro) AS DECIMAL(38,0)) / 1000000 AS DECIMAL(38,6)) AS VARCHAR) AS difference FROM c""",
    ),
    "recon_digest": Query(
        recon_digest,
        oracle("""WITH o AS (SELECT ingest_date,
  CASE WHEN l_partkey % 997 = 1 THEN payment_id || 'x' ELSE payment_id END AS payment_id
  FROM {v_payments} WHERE l_partkey % 701 <> 0 OR l_suppkey % 5 = 0),
r AS (SELECT ingest_date, payment_id, count(*) AS n FROM {v_payments} GROUP BY ALL),
s AS (SELECT ingest_date, payment_id, count(*) AS n FROM o GROUP BY ALL)
SELECT ingest_date, payment_id, coalesce(r.n, 0) AS raw_rows, coalesce(s.n, 0) AS stored_rows
FROM r FULL JOIN s USING (ingest_date, payment_id) WHERE r.n IS NULL OR s.n IS NULL"""),
    ),
    "metric_diff": Query(
        fare_metric,
        oracle(f"""SELECT CAST(r AS BIGINT) AS raw_total, CAST(s AS BIGINT) AS stored_total,
  CAST(r - s AS BIGINT) AS difference
FROM (SELECT sum(fare_vnd) AS r FROM {{v_payments}}) a,
  (SELECT sum(fare_vnd) AS s FROM ({DEDUPED_SQL['payments']}) d) b"""),
    ),
    **{
        f"recon_counts_{name}": Query(_recon_days(name), _recon_days_sql(name, entity.key))
        for name, entity in ENTITIES.items()
    },
    "recon_rows": Query(
        recon_rows,
        oracle(f"""WITH ours AS (SELECT * FROM {{v_trips}} WHERE {RECON_SQL['trips']})
SELECT * FROM (SELECT 'lost' AS side, trip_id, fare_vnd FROM ours
  WHERE trip_id NOT IN (SELECT trip_id FROM {{v_payments}}) ORDER BY trip_id LIMIT 10) a
UNION ALL
SELECT * FROM (SELECT 'extra' AS side, trip_id, fare_vnd FROM {{v_payments}}
  WHERE trip_id NOT IN (SELECT trip_id FROM ours)
  ORDER BY trip_id, payment_id, rider_id, payment_time, payment_method, fare_vnd LIMIT 10) b"""),
    ),
    "recon_row_counts": Query(
        recon_row_counts,
        oracle(f"""WITH ours AS (SELECT trip_id FROM {{v_trips}} WHERE {RECON_SQL['trips']})
SELECT (SELECT count(*) FROM (SELECT trip_id FROM ours EXCEPT
    SELECT trip_id FROM {{v_payments}}) a) AS lost,
  (SELECT count(*) FROM (SELECT trip_id FROM {{v_payments}} EXCEPT
    SELECT trip_id FROM ours) b) AS extra"""),
    ),
    "volume_mismatch": Query(
        volume_mismatch,
        oracle("""WITH p AS (SELECT ingest_date, count(*) AS n FROM {v_payments} GROUP BY 1),
t AS (SELECT ingest_date, count(*) AS n FROM {v_trips} GROUP BY 1)
SELECT coalesce(p.ingest_date, t.ingest_date) AS ingest_date, coalesce(p.n, 0) AS raw_rows,
  coalesce(t.n, 0) AS stored_rows, coalesce(p.n, 0) - coalesce(t.n, 0) AS difference
FROM p FULL JOIN t ON p.ingest_date = t.ingest_date
WHERE coalesce(p.n, 0) <> coalesce(t.n, 0)"""),
    ),
    "haversine": Query(
        haversine,
        # By the chord between two points of the unit sphere, not by the text that the views use.
        oracle("""SELECT trip_id, round(1.2742e4 * asin(sqrt(
  power(cos(b1) * cos(l1) - cos(b2) * cos(l2), 2) + power(cos(b1) * sin(l1) - cos(b2) * sin(l2), 2)
  + power(sin(b1) - sin(b2), 2)) / 2e0), 6) AS direct_km
FROM (SELECT trip_id, radians(pickup_lat) AS b1, radians(pickup_lng) AS l1,
  radians(dropoff_lat) AS b2, radians(dropoff_lng) AS l2 FROM {v_trips}) r"""),
    ),
    "distance_audit": Query(
        distance_audit, oracle(audit_sql("{v_trips}", DISTANCE_SQL, "trip_id"))
    ),
    "lifecycle": Query(
        lifecycle, oracle(audit_sql("{v_trips}", LIFECYCLE_SQL, "trip_id, status"))
    ),
    "fare_band": Query(fare_band, oracle(audit_sql("{v_trips}", FARE_SQL, "trip_id, fare_vnd"))),
    "payment_arith": Query(
        payment_arith,
        oracle(audit_sql("{v_payments}", PAYMENT_SQL, "payment_id, l_partkey, l_suppkey")),
    ),
    "promo_lookup": Query(
        promo_lookup,
        oracle(f"""SELECT coalesce(promo_code, 'none') AS promo_code, {_RATE} AS rate,
  count(*) AS n, CAST(sum(trunc(fare_vnd * {_RATE})) AS BIGINT) AS discount_vnd
FROM {{v_payments}} GROUP BY 1, 2"""),
    ),
    "time_bounds": Query(time_bounds, oracle(TIME_SQL)),
    "tag_counts": Query(
        tag_counts,
        oracle("""SELECT tag, coalesce(CAST(stars >= 4 AS VARCHAR), '-') AS positive, count(*) AS n
FROM (SELECT unnest(string_split(tags, '|')) AS tag, stars FROM {v_ratings}) t GROUP BY 1, 2"""),
    ),
    "demand_15min": Query(
        demand_15min,
        oracle("""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w, '%Y%m%d_%H%M') AS batch_id, count(*) AS n
FROM (SELECT time_bucket(INTERVAL '15 minutes', ts) AS w FROM {events}) e GROUP BY 1, 2"""),
    ),
    "demand_trips": Query(
        demand_trips,
        oracle("""SELECT strftime(w, '%Y%m%d_%H%M') AS batch_id, city, status, count(*) AS n
FROM (SELECT time_bucket(INTERVAL '15 minutes', request_time) AS w, city, status
  FROM {v_trips}) t GROUP BY ALL"""),
    ),
    "supply_by_hour": Query(
        supply_by_hour,
        oracle("""SELECT city, CAST(h AS INT) AS hour, count(*) AS n_drivers
FROM {v_drivers}, (SELECT unnest(range(24)) AS h) hours
WHERE is_active AND (s_suppkey * 7 + h) % 24 < 13 GROUP BY 1, 2"""),
    ),
    "daily_volume": Query(
        daily_volume,
        oracle(
            _union_all(
                f"SELECT '{n}' AS entity, ingest_date, count(*) AS n FROM {{v_{n}}} "
                "GROUP BY ingest_date"
                for n in ENTITIES
            )
        ),
    ),
}
