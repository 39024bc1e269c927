"""Audits and metrics that follow from the business rules of the ride data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.entities import STATUSES
from millrace.functions.geo import haversine_km
from millrace.functions.predicates import Rule, one_of
from millrace.operators.integrity import join_reduced
from millrace.operators.quality import audit

# The business rules of the data.
DETOUR_FACTORS = (1.3, 1.5)
SHORTEST_TRIP_KM = 0.5
WAIT_SECONDS = {"completed": (90, 480), "cancelled": (30, 180)}
BASE_FARE, FARE_PER_KM, LOWEST_FARE, FARE_STEP = 12_000, 5_500, 15_000, 1_000
FARE_SPREAD = (0.9, 1.1)
SURGE_HOURS = (7, 8, 17, 18, 19)
SURGE_FACTOR = 1.3
PROMO_RATES = {"RIDE10": 0.10, "GRAB20": 0.20, "NEWUSER30": 0.30}
LOWEST_FINAL_AMOUNT = 10_000
PLATFORM_SHARE, DRIVER_SHARE = 0.20, 0.80
PAYMENT_DELAY_SECONDS = (2, 30)
RATING_DELAY_SECONDS = {"rider": (60, 1_800), "driver": (60, 3_600)}
GOOD_STARS = 4
WINDOW = "15 minutes"
BATCH_LABEL = "yyyyMMdd_HHmm"


def _seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def _no_less(value: Column, lowest: float) -> Column:
    """``value``, but never below ``lowest``. Unlike ``greatest``, null stays null."""
    return F.when(value < lowest, F.lit(lowest)).otherwise(value)


def _is(status: str) -> Column:
    return F.col("status") == status


def distance_rules(tolerance_km: float = 0.01) -> tuple[Rule, ...]:
    """The driven distance is the great circle times a detour factor, never below the shortest."""

    def plausible() -> Column:
        direct = haversine_km("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")
        low, high = (_no_less(direct * factor, SHORTEST_TRIP_KM) for factor in DETOUR_FACTORS)
        return F.col("distance_km").between(low - tolerance_km, high + tolerance_km)

    return (Rule("distance_plausible", plausible),)


def lifecycle_rules() -> tuple[Rule, ...]:
    """Which columns a status sets, and how long its steps take."""

    def set_exactly_when(column: str, expected: Column) -> Column:
        return F.col(column).isNotNull() == expected

    def wait_in_band() -> Column:
        wait = _seconds("request_time", "pickup_time")
        band = F.when(_is("no_driver"), F.lit(True))
        for status, (low, high) in WAIT_SECONDS.items():
            band = band.when(_is(status), wait.between(low, high))
        return band

    def ride_takes_duration() -> Column:
        ride = _seconds("pickup_time", "dropoff_time")
        return F.when(_is("completed"), ride == F.col("duration_min").cast("bigint") * 60).otherwise(True)

    return (
        one_of("status", STATUSES),
        Rule("driver_fits_status", lambda: set_exactly_when("driver_id", ~_is("no_driver"))),
        Rule("pickup_fits_status", lambda: set_exactly_when("pickup_time", ~_is("no_driver"))),
        Rule("dropoff_fits_status", lambda: set_exactly_when("dropoff_time", _is("completed"))),
        Rule("duration_fits_status", lambda: set_exactly_when("duration_min", _is("completed"))),
        Rule("wait_in_band", wait_in_band),
        Rule("ride_takes_duration", ride_takes_duration),
    )


def fare_rules() -> tuple[Rule, ...]:
    """The fare of a completed trip lies in its band, any other fare is zero."""

    def in_band() -> Column:
        surge = F.when(F.hour("request_time").isin(list(SURGE_HOURS)), SURGE_FACTOR).otherwise(1.0)
        middle = (BASE_FARE + F.col("distance_km") * FARE_PER_KM) * surge
        low, high = (
            _no_less(F.bround(middle * factor / FARE_STEP) * FARE_STEP, float(LOWEST_FARE))
            for factor in FARE_SPREAD
        )
        fare = F.col("fare_vnd")
        return F.when(_is("completed"), fare.between(low, high)).otherwise(fare == 0)

    return (Rule("fare_in_band", in_band),)


def discount_rate(
    promo_code: str = "promo_code", rates: Mapping[str, float] = PROMO_RATES
) -> Column:
    """The rate of a promo code, 0 without a known one. The few codes become a CASE, not a join."""
    rate = F.lit(None).cast("double")
    for code, value in rates.items():
        rate = F.when(F.col(promo_code) == code, F.lit(value)).otherwise(rate)
    return F.coalesce(rate, F.lit(0.0))


def payment_rules(rates: Mapping[str, float] = PROMO_RATES) -> tuple[Rule, ...]:
    """Discount, final amount and the two shares; fractions of a dong are cut off."""

    def cut(amount: Column) -> Column:
        return amount.cast("bigint")

    def discount() -> Column:
        return F.col("discount_vnd") == cut(F.col("fare_vnd") * discount_rate(rates=rates))

    def final() -> Column:
        due = _no_less(F.col("fare_vnd").cast("bigint") - F.col("discount_vnd"), LOWEST_FINAL_AMOUNT)
        amount = F.col("final_amount_vnd")
        return F.when(F.col("payment_status") == "success", amount == due).otherwise(amount == 0)

    def share(column: str, fraction: float) -> Column:
        return F.col(column) == cut(F.col("final_amount_vnd") * fraction)

    return (
        Rule("discount_follows_promo", discount),
        Rule("final_follows_fare", final),
        Rule("fee_is_share", lambda: share("platform_fee_vnd", PLATFORM_SHARE)),
        Rule("earning_is_share", lambda: share("driver_earning_vnd", DRIVER_SHARE)),
    )


def payment_time_rules() -> tuple[Rule, ...]:
    return (
        Rule(
            "paid_soon_after_dropoff",
            lambda: _seconds("dropoff_time", "payment_time").between(*PAYMENT_DELAY_SECONDS),
        ),
    )


def rating_time_rules() -> tuple[Rule, ...]:
    def in_time() -> Column:
        delay = _seconds("dropoff_time", "rated_at")
        band = F.lit(None).cast("boolean")
        for rater, (low, high) in RATING_DELAY_SECONDS.items():
            band = F.when(F.col("rater_type") == rater, delay.between(low, high)).otherwise(band)
        return band

    return (Rule("rated_soon_after_dropoff", in_time),)


def audit_against_trips(child: DataFrame, trips: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Audit payments or ratings whose rules need their trip's ``dropoff_time``.

    Rows without a finished trip are left to the orphan check. Trips are reduced to one row per
    id first, so repeated ids on both sides cannot multiply.
    """
    finished = trips.filter(F.col("trip_id").isNotNull() & F.col("dropoff_time").isNotNull())
    ends = finished.groupBy("trip_id").agg(F.min("dropoff_time").alias("dropoff_time"))
    return audit(join_reduced(child, ends, "trip_id", "inner"), rules)


def tag_counts(ratings: DataFrame) -> DataFrame:
    """How often each tag was given with good and with poor stars."""
    tags = ratings.select(
        F.explode(F.split("tags", r"\|")).alias("tag"),
        (F.col("stars") >= GOOD_STARS).alias("positive"),
    )
    return tags.groupBy("tag", "positive").agg(F.count(F.lit(1)).alias("n"))


def demand(
    df: DataFrame, time_column: str, by: Sequence[str] = ("city", "status")
) -> DataFrame:
    """Rows per 15-minute window and group, with the window's batch label."""
    counted = df.groupBy(F.window(time_column, WINDOW), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.date_format("window.start", BATCH_LABEL).alias("batch_id"),
        *by,
        "n",
    )


def supply_by_hour(drivers: DataFrame) -> DataFrame:
    """Active drivers online per city and hour, from the drivers' 24 hourly 0/1 flags."""
    hours = (
        drivers.filter("is_active")
        .select("city", F.posexplode("online_hours").alias("hour", "online"))
        .filter(F.col("online") == 1)
    )
    return hours.groupBy("city", "hour").agg(F.count(F.lit(1)).alias("n_drivers"))


def daily_volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per entity and ``ingest_date``."""
    counted = [
        df.groupBy("ingest_date")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("entity"), "ingest_date", "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
