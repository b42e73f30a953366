"""Facility and vehicle names and KPI flags on shipment events (batch or stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.operators.keyed import hot_hashes, lookup
from parcelake.sizing import fits_broadcast


def facility_lookup(centers: DataFrame, stations: DataFrame) -> DataFrame:
    """Both kinds of facility as one table keyed by (type, id) in a single column."""
    def of(kind: str, df: DataFrame, prefix: str) -> DataFrame:
        other = "ds" if prefix == "fc" else "fc"
        entity = "fulfillment_center" if prefix == "fc" else "delivery_station"
        return df.select(
            F.struct(F.lit(kind).alias("type"), F.col(f"{entity}_id").alias("id")).alias("_at"),
            F.col(f"{entity}_name").alias(f"{prefix}_name"),
            F.col("region").alias(f"{prefix}_region"),
            F.lit(None).cast("string").alias(f"{other}_name"),
            F.lit(None).cast("string").alias(f"{other}_region"),
        )

    return of(domain.FC, centers, "fc").unionByName(of(domain.DS, stations, "ds"))


def _left(events: DataFrame, table: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    if events.isStreaming:
        # Stream-static left join; a table of unknown or large size is left to the planner.
        side = F.broadcast(table) if fits_broadcast(table) else table
        return events.join(side, key, "left")
    return lookup(events, table, key, spread_by="event_id", hot=hot)


def _at() -> Column:
    at = F.struct(F.col("facility_type").alias("type"), F.col("facility_id").alias("id"))
    return F.when(F.col("facility_id").isNotNull(), at)


def with_facilities(events: DataFrame, centers: DataFrame, stations: DataFrame,
                    hot: DataFrame | None = None) -> DataFrame:
    """Left-join the facility's name and region, into the columns of its type.

    An event is at one facility of one type, so both facility tables answer through one join.
    """
    rows = events.withColumn("_at", _at())
    return _left(rows, facility_lookup(centers, stations), "_at", hot).select(
        *events.columns, "fc_name", "fc_region", "ds_name", "ds_region")


def with_vehicle_type(events: DataFrame, vehicles: DataFrame,
                      hot: DataFrame | None = None) -> DataFrame:
    return _left(events, vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id", hot).select(
        *events.columns, "vehicle_type")


def enrich(events: DataFrame, centers: DataFrame, stations: DataFrame,
           vehicles: DataFrame) -> DataFrame:
    """Both lookups; their hot keys are counted in one pass over the events."""
    if events.isStreaming:
        return with_vehicle_type(with_facilities(events, centers, stations), vehicles)
    hot = hot_hashes(events, _at(), "vehicle_id")
    return with_vehicle_type(
        with_facilities(events, centers, stations, hot.where("_n = 0")), vehicles, hot.where("_n = 1"))


def add_flags(events: DataFrame) -> DataFrame:
    """`is_sla_at_risk` (null when unknown) and `is_priority`; times are already timestamps."""
    late = F.col("estimated_delivery_time") > F.col("promised_delivery_time")
    return events.withColumns({
        "is_sla_at_risk": late & (F.col("shipment_status") != domain.DELIVERED),
        "is_priority": F.col("customer_tier") == domain.PRIME,
    })
