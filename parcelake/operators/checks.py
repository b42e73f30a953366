"""Checks of the business rules that well-formed shipment data obeys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelake import domain
from parcelake.functions import by_code, stage_number
from parcelake.operators.keyed import hot_hashes, lookup


def lifecycle_report(events: DataFrame) -> DataFrame:
    """Does each shipment pass the seven stages in order, without skips or repeats?

    Count, first and last time of each stage are enough to tell, so this is a plain
    aggregation of fixed size per shipment; no event list of a shipment is ever put together.
    A stage is out of order when an earlier stage was still seen after it.
    """
    stage = stage_number("shipment_status")
    numbers = range(1, len(domain.LIFECYCLE) + 1)
    aggregates = [F.count("*").alias("events"), F.max(stage).alias("furthest_stage"),
                  F.count_if(F.coalesce(stage, F.lit(0)) == 0).alias("unknown_stages")]
    for n in numbers:
        time = F.when(stage == n, F.col("event_timestamp"))
        aggregates += [F.count(time).alias(f"_n{n}"), F.min(time).alias(f"_first{n}"),
                       F.max(time).alias(f"_last{n}")]
    distinct = sum((F.when(F.col(f"_n{n}") > 0, 1).otherwise(0) for n in numbers), F.lit(0))
    known = sum((F.col(f"_n{n}") for n in numbers), F.lit(0))
    backward = F.lit(False)
    for n in numbers[1:]:
        earlier = [F.col(f"_last{m}") for m in numbers if m < n]
        latest = F.greatest(*earlier) if len(earlier) > 1 else earlier[0]
        backward = backward | F.coalesce(latest > F.col(f"_first{n}"), F.lit(False))
    return (
        events.groupBy("shipment_id").agg(*aggregates)
        .select(
            "shipment_id", "events", "furthest_stage", "unknown_stages",
            (known - distinct).alias("repeated_stages"),
            (F.coalesce("furthest_stage", F.lit(0)) - distinct).alias("skipped_stages"),
            backward.alias("out_of_order"))
        .withColumn("conforms", (F.col("unknown_stages") == 0) & (F.col("repeated_stages") == 0)
                    & (F.col("skipped_stages") == 0) & ~F.col("out_of_order"))
    )


def stage_rule_violations(events: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Events whose facility type or vehicle class does not fit their stage.

    No facility (no vehicle) is right exactly for the stages that have none.
    """
    facility = by_code("shipment_status", domain.STAGE_FACILITY_TYPE)
    vehicle = by_code("shipment_status", domain.STAGE_VEHICLE_TYPE)
    typed = lookup(events, vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id",
                   spread_by="event_id")
    return (
        typed
        .select(
            "event_id", "shipment_id", "shipment_status", "facility_type", "vehicle_type",
            (~F.col("facility_type").eqNullSafe(facility)).alias("wrong_facility"),
            (~F.col("vehicle_type").eqNullSafe(vehicle)).alias("wrong_vehicle"))
        .where("wrong_facility OR wrong_vehicle")
    )


def promised_time(ordered_at: Column | str, delivery_type: Column | str) -> Column:
    """Order time plus the SLA hours of the delivery type; null for unknown types."""
    ordered_at = F.col(ordered_at) if isinstance(ordered_at, str) else ordered_at
    return F.timestamp_add("HOUR", by_code(delivery_type, domain.SLA_HOURS), ordered_at)


def expected_arrival(promised: Column | str, delay_minutes: Column | str) -> Column:
    """Promised time plus the delay."""
    promised = F.col(promised) if isinstance(promised, str) else promised
    delay = F.col(delay_minutes) if isinstance(delay_minutes, str) else delay_minutes
    return F.timestamp_add("MINUTE", F.coalesce(delay, F.lit(0)), promised)


def network_violations(orders: DataFrame, network: DataFrame) -> DataFrame:
    """Orders whose delivery station is not served by their fulfillment center.

    `network` has one row per served pair (fulfillment_center_id, delivery_station_id).
    """
    def pair() -> Column:
        return F.struct("fulfillment_center_id", "delivery_station_id")

    served = network.select(pair().alias("_pair"), F.lit(True).alias("_served")).distinct()
    return (
        lookup(orders.withColumn("_pair", pair()), served, "_pair", spread_by="order_id")
        .where(F.col("_served").isNull())
        .drop("_pair", "_served")
    )


# --- vehicle overlap ------------------------------------------------------------------

def assignments(events: DataFrame) -> DataFrame:
    """Last-mile legs: shipment, vehicle, first event, delivery time (null while under way)."""
    last_mile = events.where(
        F.col("vehicle_id").isNotNull()
        & F.col("shipment_status").isin(*domain.LAST_MILE_STAGES))
    delivered = F.when(F.col("shipment_status") == domain.DELIVERED, F.col("event_timestamp"))
    return last_mile.groupBy("vehicle_id", "shipment_id").agg(
        F.min("event_timestamp").alias("starts_at"), F.max(delivered).alias("ends_at"))


def vehicle_conflicts(legs: DataFrame) -> DataFrame:
    """Start times at which a vehicle takes a shipment while it still carries another one.

    Wanted is a running maximum of end times per vehicle, but one vehicle may hold a large part
    of all legs. So legs are first reduced to one row per (vehicle, start second), then the
    maximum runs inside each (vehicle, hour), which is at most 3600 rows, and over the
    hours of a vehicle, whose number is bounded by the calendar; the two are then combined.
    Legs that start in the same second count as conflicting with each other.
    """
    open_end = F.lit("9999-12-31 00:00:00").cast("timestamp")
    starts = (
        legs
        .withColumn("starts_at", F.date_trunc("second", "starts_at"))
        .groupBy("vehicle_id", "starts_at")
        .agg(F.count("*").alias("shipments"),
             F.max(F.coalesce("ends_at", open_end)).alias("_until"))
        .withColumn("_hour", F.date_trunc("hour", "starts_at"))
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    hours = (
        starts.groupBy("vehicle_id", "_hour").agg(F.max("_until").alias("_hour_until"))
        .withColumn("_carried", F.max("_hour_until").over(
            before.partitionBy("vehicle_id").orderBy("_hour")))
        .drop("_hour_until")
    )
    within = before.partitionBy("vehicle_id", "_hour").orderBy("starts_at")
    busy_until = F.greatest("_carried", "_inside")
    return (
        starts.withColumn("_inside", F.max("_until").over(within))
        .join(hours, ["vehicle_id", "_hour"])
        .withColumn("busy_until", busy_until)
        .where((F.col("busy_until") > F.col("starts_at")) | (F.col("shipments") > 1))
        .select("vehicle_id", "starts_at", "shipments",
                F.when(F.col("busy_until") < open_end, F.col("busy_until")).alias("busy_until"))
    )


def conflicting_shipments(legs: DataFrame) -> DataFrame:
    """The legs behind vehicle_conflicts."""
    at = vehicle_conflicts(legs).select("vehicle_id", F.col("starts_at").alias("_second"))
    return (
        legs.withColumn("_second", F.date_trunc("second", "starts_at"))
        .join(at, ["vehicle_id", "_second"], "left_semi")
        .drop("_second")
    )


# --- positions --------------------------------------------------------------------------

def off_site_events(events: DataFrame, places: DataFrame, stations_of: DataFrame,
                    tolerance: float = domain.GPS_TOLERANCE_DEGREES) -> DataFrame:
    """Events farther than `tolerance` degrees from where they should be, or that cannot be judged.

    `places`: facility_id, latitude, longitude. Events of the stages without a facility belong
    to the delivery station of the order; `stations_of` (shipment_id, delivery_station_id) has one
    row per shipment. The reason is "off site", "unknown place" or "no position".
    """
    # Only events without a facility have to look their station up.
    station = stations_of.select(
        F.col("shipment_id").alias("_carried"), F.col("delivery_station_id").alias("_station"))
    carried = F.when(F.col("facility_id").isNull(), F.col("shipment_id"))
    hot = hot_hashes(events, carried, "facility_id")
    sited = (
        lookup(events.withColumn("_carried", carried), station, "_carried", spread_by="event_id",
               hot=hot.where("_n = 0"))
        .withColumn("_place", F.coalesce("facility_id", "_station"))
    )
    located = lookup(
        sited,
        places.select(F.col("facility_id").alias("_place"), F.col("latitude").alias("_lat"),
                      F.col("longitude").alias("_lon")),
        "_place", spread_by="event_id", hot=hot.where("_n = 1"))
    off_lat = F.abs(F.col("latitude") - F.col("_lat"))
    off_lon = F.abs(F.col("longitude") - F.col("_lon"))
    reason = (
        F.when(F.col("_lat").isNull() | F.col("_lon").isNull(), "unknown place")
        .when(off_lat.isNull() | off_lon.isNull(), "no position")
        .when((off_lat > tolerance) | (off_lon > tolerance), "off site"))
    return located.withColumn("_reason", reason).where(F.col("_reason").isNotNull()).select(
        "event_id", "shipment_id", F.col("_place").alias("place_id"),
        off_lat.alias("off_latitude"), off_lon.alias("off_longitude"), F.col("_reason").alias("reason"))
