"""The registered queries: each runs one operator of the library over the whole sample."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parcelake import domain, schemas
from parcelake.functions import band
from parcelake.operators import alerts, bi, checks, clean, live, panels, parse, scd2
from parcelake.operators.fact import (
    fact_shipment as fact_shipment_of, latest_state, shipment_states, stage_pivot, with_date_key)
from parcelake.operators.keyed import latest_per_key
from parcelake.plans import panel_sql
from parcelake.plans.gold import customers
from verification.sample import Sample, as_of

Query = Callable[[Sample], DataFrame]
REGISTRY: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTRY["q_" + query.__name__] = query
    return query


def _plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that two engines' time types compare by what they show."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("string").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


# The input definitions (lazy plans, no data) are built once per session and directory.
sample_of = lru_cache(maxsize=4)(Sample)


def runnable(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(query(sample_of(spark, sf_dir)))


# --- parse and clean ----------------------------------------------------------------------

PROPS = schemas.flat("k int")


@registered
def parse_json(s: Sample) -> DataFrame:
    rows = s.table("events").select("event_id", F.col("props").alias("json_payload"))
    return parse.parse_payload(rows, PROPS).where("NOT quarantined").select("event_id", "k")


@registered
def parse_quarantine(s: Sample) -> DataFrame:
    """Payloads spoiled by value: cut off, of a wrong type, empty, null, or whole."""
    value, text = F.col("value"), F.col("props")
    spoiled = (
        F.when(value > 200, F.substring(text, 1, 4))
        .when(value > 150, F.regexp_replace(text, "[0-9]+", '"x"'))
        .when(value > 120, F.lit(""))
        .when(value > 100, F.lit(None).cast("string"))
        .otherwise(text))
    rows = s.table("events").select("event_id", spoiled.alias("json_payload"))
    return parse.parse_payload(rows, PROPS).where("quarantined").select("event_id", "json_payload")


def _order_messages(s: Sample) -> DataFrame:
    """Line items as order messages in raw envelopes: several per order, some without a key,
    some without value, some with unreadable times."""
    time = F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.to_json(F.struct(
        F.when(F.col("l_quantity") > 2, F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")))
        .alias("order_id"),
        F.when(F.col("l_quantity") < 49, time).otherwise(F.lit("garbage"))
        .alias("event_timestamp"),
        F.concat(F.lit("CUST_"), F.col("l_suppkey").cast("string")).alias("customer_id"),
        (F.col("l_extendedprice") - F.lit(5000.0)).alias("order_value")))
    return s.table("lineitem").select(
        payload.alias("json_payload"),
        F.lit(domain.TOPIC_ORDERS).alias("kafka_topic"),
        F.col("l_linenumber").alias("kafka_partition"),
        F.col("l_partkey").alias("kafka_offset"),
        F.col("l_shipdate").cast("timestamp").alias("kafka_timestamp"),
        F.col("l_shipdate").cast("date").alias("ingested_at"))


@registered
def silver_orders(s: Sample) -> DataFrame:
    entity = schemas.ENTITIES[domain.TOPIC_ORDERS]
    bronze = parse.parse_payload(_order_messages(s), entity.payload).where("NOT quarantined").drop(
        "quarantined", "json_payload")
    return clean.to_silver(bronze, entity).select(
        "order_id", "event_timestamp", "customer_id", "order_value", "quarantined")


@registered
def enum_filter(s: Sample) -> DataFrame:
    entity = schemas.ENTITIES[domain.TOPIC_VEHICLES]
    return s.raw_vehicles().where(clean.valid_rows(entity)).select(
        "vehicle_id", "vehicle_type", "status")


@registered
def ts_cast(s: Sample) -> DataFrame:
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = s.table("events").select(
        "event_id", F.when(F.col("value") > 150, "garbage").otherwise(text)
        .alias("event_timestamp"))
    return parse.cast_times(rows, ["event_timestamp"])


@registered
def dedup_latest(s: Sample) -> DataFrame:
    return latest_per_key(s.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("l_shipdate"))


@registered
def sla_at_risk(s: Sample) -> DataFrame:
    return s.flagged.select("event_id", "shipment_id", "is_sla_at_risk", "is_priority")


@registered
def enrich_events(s: Sample) -> DataFrame:
    return s.enriched.select(
        "event_id", "facility_id", "vehicle_id", "fc_name", "fc_region", "ds_name", "ds_region",
        "vehicle_type")


# --- dimensions ---------------------------------------------------------------------------

@registered
def scd2_hash(s: Sample) -> DataFrame:
    return s.dim_ds.select("delivery_station_id", "row_hash", "surrogate_key")


@registered
def scd2_initial(s: Sample) -> DataFrame:
    return scd2.first_versions(customers(s.trade_orders), scd2.DIM_CUSTOMER, F.lit("1995-01-01"))


@registered
def scd2_changes(s: Sample) -> DataFrame:
    return scd2.changes(s.tiers_first, s.tiers_after, scd2.DIM_CUSTOMER, F.lit("1998-04-01"))


@registered
def scd2_merge(s: Sample) -> DataFrame:
    return s.tier_history


@registered
def scd2_current(s: Sample) -> DataFrame:
    return scd2.current(s.tier_history).select("customer_id", "customer_tier", "effective_from")


@registered
def scd2_asof(s: Sample) -> DataFrame:
    orders = s.trade_orders.select(
        "order_id", "customer_id", F.col("event_timestamp").cast("date").alias("order_date"))
    return scd2.as_of_version(
        orders, s.tier_history, "customer_id", "order_date", ["customer_tier", "row_hash"],
        spread_by="order_id")


@registered
def scd2_asof_sorted(s: Sample) -> DataFrame:
    """The same by the pass over days in order, which is for tables of any size."""
    orders = s.trade_orders.select(
        "order_id", "customer_id", F.col("event_timestamp").cast("date").alias("order_date"))
    return scd2.as_of_sorted(
        orders, s.tier_history, "customer_id", "order_date", ["customer_tier", "row_hash"],
        spread_by="order_id")


@registered
def dim_fc(s: Sample) -> DataFrame:
    return s.fc_history.drop("latitude", "longitude")


@registered
def dim_ds(s: Sample) -> DataFrame:
    return s.ds_history.drop("latitude", "longitude")


@registered
def dim_vehicle(s: Sample) -> DataFrame:
    return s.vehicle_history


@registered
def dim_customer(s: Sample) -> DataFrame:
    return s.first_load(scd2.DIM_CUSTOMER, customers(s.trade_orders))


@registered
def dim_date(s: Sample) -> DataFrame:
    """All days of the calendar, with the number of events of each."""
    per_day = s.events.groupBy(F.col("event_timestamp").cast("date").alias("full_date")).agg(
        F.count("*").alias("events"))
    return s.calendar.join(per_day, "full_date", "left").withColumn(
        "events", F.coalesce("events", F.lit(0)))


# --- fact -----------------------------------------------------------------------------------

@registered
def stage_pivots(s: Sample) -> DataFrame:
    return stage_pivot(s.events)


@registered
def latest_states(s: Sample) -> DataFrame:
    return latest_state(s.events).select(
        "shipment_id", "event_id", "event_timestamp", "shipment_status", "delay_minutes")


@registered
def fact_shipment(s: Sample) -> DataFrame:
    return s.fact


def _fact_over_histories(s: Sample, at_receipt: bool) -> DataFrame:
    return fact_shipment_of(
        shipment_states(s.events), s.orders, s.vehicles, s.fc_history, s.ds_history, s.vehicle_history,
        s.dim_customer, s.calendar, as_of(), at_receipt).select(
        "shipment_id", "date_key", "fc_sk", "ds_sk", "vehicle_sk", "customer_sk")


@registered
def fact_versions(s: Sample) -> DataFrame:
    """Keys of the current versions, over dimensions after two loads."""
    return _fact_over_histories(s, at_receipt=False)


@registered
def fact_asof(s: Sample) -> DataFrame:
    """Keys of the versions valid on the day of receipt, over dimensions after two loads."""
    return _fact_over_histories(s, at_receipt=True)


@registered
def fact_date_key(s: Sample) -> DataFrame:
    return with_date_key(stage_pivot(s.events), s.calendar, as_of()).select(
        "shipment_id", "fc_received_at", "date_key")


# --- BI -------------------------------------------------------------------------------------

@registered
def bi_warehouse(s: Sample) -> DataFrame:
    return s.bi["bi_warehouse_performance"]


@registered
def bi_delivery_station(s: Sample) -> DataFrame:
    return s.bi["bi_delivery_station_perf"]


@registered
def bi_kpis(s: Sample) -> DataFrame:
    return s.bi["bi_logistics_kpis"]


@registered
def bi_monthly(s: Sample) -> DataFrame:
    return s.bi["bi_monthly_trends"]


@registered
def bi_cost(s: Sample) -> DataFrame:
    return s.bi["bi_cost_penalty"]


@registered
def bi_lead_time(s: Sample) -> DataFrame:
    return s.bi["bi_lead_time"]


@registered
def panel_kpis(s: Sample) -> DataFrame:
    return panels.kpi_stats(s.bi["bi_logistics_kpis"])


@registered
def panel_warehouse(s: Sample) -> DataFrame:
    return panels.warehouse_table(s.bi["bi_warehouse_performance"])


@registered
def panel_station(s: Sample) -> DataFrame:
    return panels.station_table(s.bi["bi_delivery_station_perf"])


@registered
def panel_monthly(s: Sample) -> DataFrame:
    return panels.monthly_series(s.bi["bi_monthly_trends"])


@registered
def panel_cost(s: Sample) -> DataFrame:
    return panels.cost_table(s.bi["bi_cost_penalty"])


@registered
def panel_lead_time(s: Sample) -> DataFrame:
    return panels.lead_time_table(s.bi["bi_lead_time"])


@registered
def bands(s: Sample) -> DataFrame:
    """The colours of all panels over the values that the centers have."""
    values = s.bi["bi_warehouse_performance"].select("fc_id", *[
        F.col(c).cast("double").alias(c) for c in (
            "shipment_volume", "avg_fc_time_min", "delayed_count", "delayed_pct")])
    value = {
        "delayed_shipments": "delayed_count", "sla_at_risk": "delayed_count",
        "fc_backlog": "shipment_volume", "ds_backlog": "shipment_volume",
        "on_time_pct": 100 - F.col("delayed_pct"), "sla_breach_pct": "delayed_pct",
        "delayed_pct": "delayed_pct", "fc_hours_stuck": "delayed_count",
        "ds_hours_stuck": "delayed_count"}
    return values.select("fc_id", *[
        band(value.get(panel, "avg_fc_time_min"), panel).alias(f"{panel}_band")
        for panel in domain.PANEL_BANDS])


# --- panels as SQL ----------------------------------------------------------------------------

def _through_sql(s: Sample, dashboard: str, title: str) -> DataFrame:
    panel_sql.register(s.spark, s.live, s.bi)
    return panel_sql.panel(s.spark, dashboard, title, "2027-06-30 00:00:00")


@registered
def sql_warehouse(s: Sample) -> DataFrame:
    return _through_sql(s, panel_sql.BI, "Warehouse Performance")


@registered
def sql_delayed(s: Sample) -> DataFrame:
    return _through_sql(s, panel_sql.REALTIME, "Delayed Shipments")


@registered
def sql_stale_ds(s: Sample) -> DataFrame:
    return _through_sql(s, panel_sql.REALTIME, "Stale at Delivery Station")


# --- live table -------------------------------------------------------------------------------

@registered
def live_upsert(s: Sample) -> DataFrame:
    """Morning events of PRIME shipments and afternoon events of the others are stored; the
    other half of the day arrives later. So one part of the batch is newer, the other late."""
    stored_first = (F.hour("event_timestamp") < 12) == (F.col("customer_tier") == domain.PRIME)
    stored = s.live_of(s.events.where(stored_first))
    changed = live.changed_rows(s.live_rows(s.events.where(~stored_first)), stored)
    return live.after_changes(stored, changed).drop("latitude", "longitude")


@registered
def live_active(s: Sample) -> DataFrame:
    return live.active_shipments(s.live)


@registered
def live_delayed(s: Sample) -> DataFrame:
    return live.delayed_shipments(s.live)


@registered
def live_sla_risk(s: Sample) -> DataFrame:
    return live.sla_at_risk(s.live)


@registered
def live_avg_delay(s: Sample) -> DataFrame:
    return live.average_delay(s.live)


@registered
def live_by_status(s: Sample) -> DataFrame:
    return live.by_status(s.live)


@registered
def live_by_tier(s: Sample) -> DataFrame:
    return live.by_tier(s.live)


@registered
def fc_backlog(s: Sample) -> DataFrame:
    return live.fc_backlog(s.live)


@registered
def ds_backlog(s: Sample) -> DataFrame:
    return live.ds_backlog(s.live)


@registered
def stale_fc(s: Sample) -> DataFrame:
    return live.stale_fc(s.live, as_of())


@registered
def stale_ds(s: Sample) -> DataFrame:
    return live.stale_ds(s.live, as_of())


@registered
def live_feed(s: Sample) -> DataFrame:
    return live.live_feed(s.live)


# --- alerts -----------------------------------------------------------------------------------

@registered
def alert_prime_sla(s: Sample) -> DataFrame:
    return alerts.prime_sla(s.flagged)


@registered
def alert_delay(s: Sample) -> DataFrame:
    return alerts.delay(s.flagged)


@registered
def eta_change(s: Sample) -> DataFrame:
    """Morning events are stored, afternoon events are the batch."""
    morning = F.hour("event_timestamp") < 12
    return alerts.eta_change(s.events.where(~morning), s.live_of(s.events.where(morning)))


@registered
def fc_backlog_alert(s: Sample) -> DataFrame:
    return alerts.fc_backlog(s.live)


@registered
def ds_backlog_alert(s: Sample) -> DataFrame:
    return alerts.ds_backlog(s.live)


@registered
def alert_stale(s: Sample) -> DataFrame:
    return alerts.stale(s.live, as_of())


@registered
def alert_dedup(s: Sample) -> DataFrame:
    """Sent before: DELAY of PRIME shipments, and STALE of delayed ones at a time that grows
    with their delay, so some are inside the cooldown."""
    def sent(rows: DataFrame, kind: str, seconds) -> DataFrame:
        return rows.select(
            F.concat_ws(":", "shipment_id", F.lit(kind)).alias("alert_key"),
            F.lit(kind).alias("alert_type"),
            F.timestamp_add("SECOND", -seconds, as_of()).alias("fired_at"))

    log = sent(s.live.where("is_priority"), alerts.DELAY, F.lit(86400)).unionByName(
        sent(s.live.where("is_delayed"), alerts.STALE, F.col("delay_minutes") * 30))
    found = alerts.delay(s.flagged).unionByName(alerts.stale(s.live, as_of()))
    return alerts.unsent(found, log, as_of()).select("alert_key", "alert_type", "subject_id")


# --- rule checks --------------------------------------------------------------------------------

@registered
def lifecycle_check(s: Sample) -> DataFrame:
    return checks.lifecycle_report(s.events)


@registered
def stage_rules(s: Sample) -> DataFrame:
    return checks.stage_rule_violations(s.events, s.vehicles)


@registered
def promised_time(s: Sample) -> DataFrame:
    return s.trade_orders.select(
        "order_id", checks.promised_time("event_timestamp", "delivery_type")
        .alias("promised_delivery_time"),
        checks.expected_arrival(
            checks.promised_time("event_timestamp", "delivery_type"),
            F.floor(F.col("order_value") / 1000).cast("int")).alias("expected_arrival"))


@registered
def network_check(s: Sample) -> DataFrame:
    return checks.network_violations(s.orders, s.network).select(
        "order_id", "fulfillment_center_id", "delivery_station_id")


@registered
def vehicle_overlap(s: Sample) -> DataFrame:
    return checks.vehicle_conflicts(checks.assignments(s.events))


@registered
def vehicle_overlap_shipments(s: Sample) -> DataFrame:
    return checks.conflicting_shipments(checks.assignments(s.events))


@registered
def geofence(s: Sample) -> DataFrame:
    places = s.raw_centers().select(
        F.col("fulfillment_center_id").alias("facility_id"), "latitude", "longitude").unionByName(
        s.raw_stations().select(
            F.col("delivery_station_id").alias("facility_id"), "latitude", "longitude"))
    return checks.off_site_events(s.events, places, s.orders)


# names of the plan that differ from the function above
REGISTRY["q_stage_pivot"] = REGISTRY.pop("q_stage_pivots")
REGISTRY["q_latest_state"] = REGISTRY.pop("q_latest_states")
