"""Rule checks over silver, one table of findings per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelake import domain
from parcelake.layout import Layout
from parcelake.operators import checks
from parcelake.operators.keyed import latest_per_key
from parcelake.plans.gold import silver_of
from parcelake.sizing import shuffles_sized_for
from parcelake.sources.tables import Table


def places(spark: SparkSession, layout: Layout) -> DataFrame:
    """Positions of all facilities."""
    def of(topic: str, key: str) -> DataFrame:
        return silver_of(spark, layout, topic).select(
            F.col(key).alias("facility_id"), "latitude", "longitude")

    return of(domain.TOPIC_FULFILLMENT_CENTERS, "fulfillment_center_id").unionByName(
        of(domain.TOPIC_DELIVERY_STATIONS, "delivery_station_id"))


def run_checks(spark: SparkSession, layout: Layout, network: DataFrame) -> None:
    """`network`: the served pairs (fulfillment_center_id, delivery_station_id)."""
    events = silver_of(spark, layout, domain.TOPIC_SHIPMENT_EVENTS)
    orders = silver_of(spark, layout, domain.TOPIC_ORDERS)
    vehicles = silver_of(spark, layout, domain.TOPIC_VEHICLES)

    # Read several times by the overlap check, and far smaller than the events: written first.
    legs = Table(spark, layout.quality("assignments"))
    with shuffles_sized_for(spark, events):
        legs.overwrite(checks.assignments(events))
    # of several orders of a shipment the newest counts, as in the fact
    by_shipment = latest_per_key(
        orders.select("shipment_id", "event_timestamp", "order_id", "delivery_station_id"),
        ["shipment_id"], ["event_timestamp", "order_id"]).select("shipment_id", "delivery_station_id")
    findings = {
        "lifecycle": checks.lifecycle_report(events),
        "stage_rules": checks.stage_rule_violations(events, vehicles),
        "network": checks.network_violations(orders, network),
        "vehicle_conflicts": checks.vehicle_conflicts(legs.read()),
        "off_site_events": checks.off_site_events(events, places(spark, layout), by_shipment),
    }
    for name, df in findings.items():
        with shuffles_sized_for(spark, events):
            Table(spark, layout.quality(name)).overwrite(df)
