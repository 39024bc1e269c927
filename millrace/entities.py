"""The three entities: schema, key and rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from millrace.functions.predicates import Rule, at_least, one_of, required, within

# The value domains of the data.
STATUSES = ("completed", "cancelled", "no_driver")
CITIES = ("HCMC", "HANOI")
PAYMENT_STATUSES = ("success", "refunded", "failed")
PAYMENT_METHODS = ("cash", "momo", "zalopay", "credit_card", "vnpay")
RATER_TYPES = ("rider", "driver")
DEFAULT_SOURCE = "simulator"
QUARANTINE_REASON = "Failed Data Quality Checks at Silver Layer"

TEXT, WHOLE, REAL, INSTANT = StringType(), IntegerType(), DoubleType(), TimestampType()


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


TRIPS_SCHEMA = _schema(
    trip_id=TEXT,
    driver_id=TEXT,
    rider_id=TEXT,
    request_time=INSTANT,
    pickup_time=INSTANT,
    dropoff_time=INSTANT,
    status=TEXT,
    city=TEXT,
    pickup_zone=TEXT,
    pickup_lat=REAL,
    pickup_lng=REAL,
    dropoff_zone=TEXT,
    dropoff_lat=REAL,
    dropoff_lng=REAL,
    distance_km=REAL,
    duration_min=WHOLE,
    fare_vnd=WHOLE,
)

PAYMENTS_SCHEMA = _schema(
    payment_id=TEXT,
    trip_id=TEXT,
    rider_id=TEXT,
    payment_time=INSTANT,
    payment_method=TEXT,
    fare_vnd=WHOLE,
    promo_code=TEXT,
    discount_vnd=WHOLE,
    final_amount_vnd=WHOLE,
    payment_status=TEXT,
    platform_fee_vnd=WHOLE,
    driver_earning_vnd=WHOLE,
)

RATINGS_SCHEMA = _schema(
    rating_id=TEXT,
    trip_id=TEXT,
    rater_id=TEXT,
    ratee_id=TEXT,
    rater_type=TEXT,
    ratee_type=TEXT,
    stars=WHOLE,
    tags=TEXT,
    rated_at=INSTANT,
)

AUDIT_SCHEMA = _schema(_ingested_at=INSTANT, _batch_id=TEXT, _source=TEXT, ingest_date=TEXT)
RUNS_SCHEMA = _schema(id=TEXT, run_at=INSTANT, target_date=TEXT, dag_id=TEXT, status=TEXT)


@dataclass(frozen=True)
class Entity:
    """What the generic jobs need to know about one entity.

    ``rules`` decide between Silver and quarantine; ``recon_rules`` is the looser set under
    which raw rows are compared with stored ones.
    """

    name: str
    key: str
    schema: StructType
    rules: tuple[Rule, ...]
    recon_rules: tuple[Rule, ...]
    newest: str | None = None  # of copies of a key, the row with the largest value stays

    @property
    def bronze_schema(self) -> StructType:
        return StructType(self.schema.fields + AUDIT_SCHEMA.fields)

    @property
    def silver_schema(self) -> StructType:
        return StructType(self.bronze_schema.fields + [StructField("_silver_at", INSTANT, True)])

    @property
    def quarantine_schema(self) -> StructType:
        return StructType(
            self.silver_schema.fields + [StructField("quarantine_reason", TEXT, True)]
        )


_TRIP_BASE = (
    required("trip_id"),
    required("rider_id"),
    one_of("status", STATUSES),
    one_of("city", CITIES),
)
_PAYMENT_BASE = (
    required("payment_id"),
    required("trip_id"),
    one_of("payment_status", PAYMENT_STATUSES),
)
_RATING_BASE = (required("rating_id"), required("trip_id"), within("stars", 1, 5))

TRIPS = Entity(
    name="trips",
    key="trip_id",
    schema=TRIPS_SCHEMA,
    rules=_TRIP_BASE + (at_least("fare_vnd", 0), at_least("distance_km", 0.0)),
    recon_rules=_TRIP_BASE,
    newest="request_time",
)
PAYMENTS = Entity(
    name="payments",
    key="payment_id",
    schema=PAYMENTS_SCHEMA,
    rules=_PAYMENT_BASE
    + (at_least("final_amount_vnd", 0), one_of("payment_method", PAYMENT_METHODS)),
    recon_rules=_PAYMENT_BASE,
    newest="payment_time",
)
RATINGS = Entity(
    name="ratings",
    key="rating_id",
    schema=RATINGS_SCHEMA,
    rules=_RATING_BASE + (one_of("rater_type", RATER_TYPES),),
    recon_rules=_RATING_BASE,
    newest="rated_at",
)
ENTITIES = {entity.name: entity for entity in (TRIPS, PAYMENTS, RATINGS)}
