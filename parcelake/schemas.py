"""Payload schemas of the topics, the raw envelope, and the contracts of the served tables.

Column names and types are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from parcelake import domain


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def flat(text: str) -> T.StructType:
    """A flat schema from "name type, name type, ..."; needs no running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def empty(spark, schema: T.StructType):
    """A table without rows of that schema; unlike a collection its size is known to be zero."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                        for f in schema.fields)
    return spark.sql(f"SELECT {columns} WHERE false")


# --- payloads (JSON text of the topics) ---------------------------------------------
FULFILLMENT_CENTER = flat(
    "fulfillment_center_id string, fulfillment_center_name string, city string, region string, "
    "state string, daily_capacity int, latitude double, longitude double, "
    "updated_at string, batch_date string"
)
DELIVERY_STATION = flat(
    "delivery_station_id string, delivery_station_name string, city string, region string, "
    "state string, daily_capacity int, latitude double, longitude double, "
    "updated_at string, batch_date string"
)
VEHICLE = flat(
    "vehicle_id string, vehicle_type string, home_facility_id string, home_facility_type string, "
    "capacity int, status string, updated_at string, batch_date string"
)
SHIPMENT_EVENT = flat(
    "event_id string, event_timestamp string, shipment_id string, order_id string, "
    "event_type string, shipment_status string, facility_id string, facility_type string, "
    "vehicle_id string, estimated_delivery_time string, promised_delivery_time string, "
    "is_delayed boolean, delay_minutes int, customer_tier string, delivery_type string, "
    "latitude double, longitude double"
)
ORDER = flat(
    "order_id string, event_timestamp string, customer_id string, customer_tier string, "
    "delivery_type string, order_value double, fulfillment_center_id string, "
    "delivery_station_id string, promised_delivery_time string, shipment_id string, "
    "order_status string"
)

# --- raw layer -------------------------------------------------------------------------
# `ingested_at` is the partition column; it is declared so that reading never infers anything.
ENVELOPE = flat(
    "json_payload string, kafka_topic string, kafka_partition int, kafka_offset bigint, "
    "kafka_timestamp timestamp, ingested_at date"
)
LINEAGE = flat(
    "kafka_timestamp timestamp, kafka_offset bigint, kafka_partition int, ingested_at date, "
    "bronze_processed_at timestamp"
)
LINEAGE_COLUMNS = tuple(LINEAGE.fieldNames())

# --- served tables -----------------------------------------------------------------------
SHIPMENT_LIVE = flat(
    "shipment_id string, order_id string, shipment_status string, event_timestamp timestamp, "
    "customer_tier string, delivery_type string, is_delayed boolean, delay_minutes int, "
    "facility_id string, facility_type string, fc_name string, ds_name string, "
    "fc_region string, ds_region string, vehicle_id string, "
    "estimated_delivery_time timestamp, promised_delivery_time timestamp, "
    "is_sla_at_risk boolean, is_priority boolean, latitude double, longitude double, "
    "stage_entered_at timestamp, last_updated timestamp"
)
# What an alert is about, as far as its type has it.
ALERT_SUBJECT = flat(
    "shipment_status string, delivery_type string, estimated_delivery_time timestamp, "
    "promised_delivery_time timestamp, previous_estimated_time timestamp, stage_entered_at timestamp"
)
ALERT = T.StructType([
    *flat("alert_key string, alert_type string, subject_id string, detail string").fields,
    *ALERT_SUBJECT.fields, T.StructField("fired_at", T.TimestampType())])
# What suppression has to know.
ALERT_SENT = flat("alert_key string, alert_type string, fired_at timestamp")
BI_TABLES = {
    "bi_warehouse_performance": flat(
        "fc_id string, fc_name string, region string, shipment_volume int, "
        "avg_fc_time_min double, delayed_count int, delayed_pct double, refreshed_at timestamp"
    ),
    "bi_delivery_station_perf": flat(
        "ds_id string, ds_name string, region string, shipment_volume int, "
        "avg_ds_time_min double, delayed_count int, delayed_pct double, refreshed_at timestamp"
    ),
    "bi_logistics_kpis": flat(
        "total_shipments int, delivered_count int, on_time_count int, on_time_pct double, "
        "avg_delay_min double, sla_breach_count int, sla_breach_pct double, refreshed_at timestamp"
    ),
    "bi_monthly_trends": flat(
        "year int, month int, month_name string, shipment_volume int, delivered_count int, "
        "on_time_count int, on_time_pct double, avg_delay_min double, refreshed_at timestamp"
    ),
    "bi_cost_penalty": flat(
        "delivery_type string, total_shipments int, total_transport_cost double, "
        "total_sla_penalty double, total_refunds double, avg_order_value double, "
        "refreshed_at timestamp"
    ),
    "bi_lead_time": flat(
        "delivery_type string, shipment_count int, avg_lead_time_hrs double, "
        "min_lead_time_hrs double, max_lead_time_hrs double, refreshed_at timestamp"
    ),
}


@dataclass(frozen=True)
class Entity:
    """What the bronze and silver jobs need to know about one topic."""

    name: str
    kind: str                       # "master" or "events"
    payload: T.StructType
    key: str
    newest_by: str | None           # decides which copy of a key is kept; None keeps every row
    positive: tuple[str, ...] = ()  # columns that must be > 0
    allowed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    times: tuple[str, ...] = ()     # ISO text columns that become timestamps

    @property
    def bronze(self) -> T.StructType:
        """Payload, lineage, and what marks a row that did not parse."""
        marks = flat("json_payload string, quarantined boolean")
        return T.StructType([*self.payload.fields, *LINEAGE.fields, *marks.fields])

    @property
    def silver(self) -> T.StructType:
        """Payload with typed times, and the same mark. Lineage is gone."""
        typed = [
            T.StructField(f.name, T.TimestampType()) if f.name in self.times else f
            for f in self.payload.fields]
        return T.StructType([*typed, *flat(
            "quarantined boolean, silver_processed_at timestamp").fields])

    @property
    def append_only(self) -> bool:
        return self.newest_by is None


ENTITIES = {
    e.name: e
    for e in (
        Entity(domain.TOPIC_FULFILLMENT_CENTERS, "master", FULFILLMENT_CENTER,
               "fulfillment_center_id", "updated_at", positive=("daily_capacity",)),
        Entity(domain.TOPIC_DELIVERY_STATIONS, "master", DELIVERY_STATION,
               "delivery_station_id", "updated_at", positive=("daily_capacity",)),
        Entity(domain.TOPIC_VEHICLES, "master", VEHICLE, "vehicle_id", "updated_at",
               allowed=(("status", domain.VEHICLE_STATUSES),)),
        Entity(domain.TOPIC_ORDERS, "events", ORDER, "order_id", "event_timestamp",
               positive=("order_value",), times=("event_timestamp", "promised_delivery_time")),
        Entity(domain.TOPIC_SHIPMENT_EVENTS, "events", SHIPMENT_EVENT, "shipment_id", None,
               times=("event_timestamp", "estimated_delivery_time", "promised_delivery_time")),
    )
}
