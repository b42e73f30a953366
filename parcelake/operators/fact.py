"""fact_shipment: one row per shipment, built from silver events and orders.

Stage times and the newest state of a shipment come out of one aggregation, so the events
are shuffled once. Orders are reduced to one row per shipment with the same partitioning,
and the join of the two needs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.functions import by_code, elapsed, round_to, stage_number
from parcelake.operators.keyed import greatest_row, hot_hashes, latest_per_key, lookup
from parcelake.operators.scd2 import as_of_version, current

# output column: (first or last time the stage was seen, stage)
STAGE_TIMES = {
    "fc_received_at": (F.min, domain.ALLOCATED),
    "dispatched_from_fc_at": (F.max, domain.DISPATCHED),
    "received_at_ds_at": (F.min, domain.AT_STATION),
    "out_for_delivery_at": (F.max, domain.ON_ROUTE),
    "actual_delivery_time": (F.max, domain.DELIVERED),
}
STAGE_FACILITIES = {"fc_id": domain.FC, "ds_id": domain.DS}

STATE_COLUMNS = (
    "order_id", "shipment_status", "vehicle_id", "is_delayed", "delay_minutes",
    "customer_tier", "delivery_type", "promised_delivery_time",
)

FACT_COLUMNS = (
    "customer_id", "vehicle_id", "shipment_id", "order_id", "shipment_status", "is_delayed",
    "delay_minutes", "customer_tier", "delivery_type", "promised_delivery_time",
    "fc_received_at", "dispatched_from_fc_at", "received_at_ds_at", "out_for_delivery_at",
    "actual_delivery_time", "fc_id", "ds_id", "order_value", "vehicle_type",
    "lead_time_hours", "fc_time_minutes", "ds_time_minutes", "sla_breached",
    "transportation_cost", "sla_penalty_amount", "refund_amount",
    "fc_sk", "ds_sk", "vehicle_sk", "customer_sk", "date_key",
)


def _stage_aggregates() -> list[Column]:
    times = [
        pick(F.when(F.col("shipment_status") == stage, F.col("event_timestamp"))).alias(name)
        for name, (pick, stage) in STAGE_TIMES.items()
    ]
    facilities = [
        F.max(F.when(F.col("facility_type") == kind, F.col("facility_id"))).alias(name)
        for name, kind in STAGE_FACILITIES.items()
    ]
    return times + facilities


# Newest event: by time, then the later lifecycle stage (times have one-second resolution).
NEWEST_EVENT = ("event_timestamp", "_stage", "event_id")


def with_stage(events: DataFrame) -> DataFrame:
    return events.withColumn("_stage", stage_number("shipment_status"))


def stage_pivot(events: DataFrame) -> DataFrame:
    """Named stage times and facilities, one row per shipment."""
    return events.groupBy("shipment_id").agg(*_stage_aggregates())


def latest_state(events: DataFrame) -> DataFrame:
    """The newest event of each shipment, with all its columns."""
    return latest_per_key(with_stage(events), ["shipment_id"], NEWEST_EVENT).drop("_stage")


def shipment_states(events: DataFrame) -> DataFrame:
    """stage_pivot and the newest state together: one scan and one shuffle of the events.

    `newest` holds what ranks an event and the state columns. All columns are minima or maxima,
    so states of two sets of events can be merged (`merge_states`).
    """
    newest = greatest_row(NEWEST_EVENT, [*NEWEST_EVENT, *STATE_COLUMNS])
    return with_stage(events).groupBy("shipment_id").agg(
        newest.alias("newest"), *_stage_aggregates())


def merge_states(states: DataFrame, more: DataFrame) -> DataFrame:
    """States over the events of both. Events counted twice make no difference."""
    picks = [pick(name).alias(name) for name, (pick, _) in STAGE_TIMES.items()]
    picks += [F.max(name).alias(name) for name in STAGE_FACILITIES]
    return states.unionByName(more).groupBy("shipment_id").agg(
        F.max("newest").alias("newest"), *picks)


def _flat_states(states: DataFrame) -> DataFrame:
    return states.select(
        "shipment_id", *[f"newest.{c}" for c in STATE_COLUMNS], *STAGE_TIMES, *STAGE_FACILITIES)


def order_per_shipment(orders: DataFrame) -> DataFrame:
    """Orders are unique by order id only; keep the newest order of each shipment."""
    wanted = orders.where(F.col("shipment_id").isNotNull()).select(
        "shipment_id", "event_timestamp", "order_id", "customer_id", "order_value")
    return (
        latest_per_key(wanted, ["shipment_id"], ["event_timestamp", "order_id"])
        .select("shipment_id", "customer_id", "order_value")
    )


def with_measures(shipments: DataFrame) -> DataFrame:
    """Durations, SLA outcome and money, from columns already on the row."""
    def duration(start: str, end: str, unit: float, digits: int) -> Column:
        return round_to(elapsed(start, end, unit), digits)

    delivered = F.col("actual_delivery_time")
    breached = F.when(delivered.isNull(), F.lit(False)).otherwise(
        delivered > F.col("promised_delivery_time"))
    minutes = F.greatest(F.col("delay_minutes"), F.lit(0)).cast("double")
    return (
        shipments
        .withColumns({
            "lead_time_hours": duration("fc_received_at", "actual_delivery_time", 3600.0, 2),
            "fc_time_minutes": duration("fc_received_at", "dispatched_from_fc_at", 60.0, 1),
            "ds_time_minutes": duration("received_at_ds_at", "out_for_delivery_at", 60.0, 1),
            "sla_breached": breached,
            "transportation_cost": by_code("vehicle_type", domain.TRANSPORT_COST, 0.0),
            "sla_penalty_amount":
                minutes * by_code("delivery_type", domain.PENALTY_PER_MINUTE, 0.0),
        })
        .withColumn(
            "refund_amount",
            F.when(F.col("sla_breached") & F.col("delivery_type").isin(*domain.REFUND_SHARE),
                   F.col("order_value") * by_code("delivery_type", domain.REFUND_SHARE))
            .otherwise(F.lit(0.0)))
    )


# Partitions of shipments that have no date key of their own.
UNRECEIVED, OFF_CALENDAR = 0, -1


def receipt_part(received: Column | str = "fc_received_at") -> Column:
    """Partition of a shipment: the date key of its receipt at the center."""
    day = (F.col(received) if isinstance(received, str) else received).cast("date")
    known = day.between(F.lit(domain.CALENDAR_START).cast("date"), F.lit(domain.CALENDAR_END).cast("date"))
    return (
        F.when(day.isNull(), UNRECEIVED)
        .when(known, F.date_format(day, "yyyyMMdd").cast("int"))
        .otherwise(OFF_CALENDAR))


def _business_day(as_of: Column) -> Column:
    return F.coalesce(F.col("fc_received_at").cast("date"), as_of.cast("date"))


def with_date_key(shipments: DataFrame, calendar: DataFrame, as_of: Column) -> DataFrame:
    """date_key of the day the shipment reached its center, else of `as_of`; null off-calendar."""
    days = calendar.select(F.col("full_date").alias("_day"), "date_key")
    day = _business_day(as_of)
    # The calendar is a fixed 2557 rows, whatever the size of the data.
    return (
        shipments.withColumn("_day", day)
        .join(F.broadcast(days), "_day", "left")
        .drop("_day")
    )


def _surrogate(dim: DataFrame, natural: str, row_key: str, alias: str) -> DataFrame:
    return current(dim).select(F.col(natural).alias(row_key), F.col("surrogate_key").alias(alias))


def _versions(dim: DataFrame, natural: str, row_key: str, alias: str) -> DataFrame:
    return dim.select(F.col(natural).alias(row_key), F.col("surrogate_key").alias(alias),
                      "effective_from", "effective_to")


def fact_shipment(
    states: DataFrame,
    orders: DataFrame,
    vehicles: DataFrame,
    dim_fc: DataFrame,
    dim_ds: DataFrame,
    dim_vehicle: DataFrame,
    dim_customer: DataFrame,
    calendar: DataFrame,
    as_of: Column,
    at_receipt: bool = False,
) -> DataFrame:
    """The fact from `shipment_states`, with the keys of the current dimension versions.

    `at_receipt` takes the versions valid on the day of receipt at the center instead (without
    receipt: on `as_of`), null where there was none; later versions then leave old rows alone.

    A dimension that is too large to broadcast is looked up by shuffle; its hot keys are then
    counted on the states or the orders, so these should be tables, not unfinished plans.
    """
    flat = _flat_states(states)
    shipments = flat.join(order_per_shipment(orders), "shipment_id", "left")

    keys = ("vehicle_id", "fc_id", "ds_id")
    counted = hot_hashes(flat, *keys)
    hot = {key: counted.where(F.col("_n") == n) for n, key in enumerate(keys)}
    hot["customer_id"] = hot_hashes(orders, "customer_id")

    def add(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
        return lookup(rows, table, key, spread_by="shipment_id", hot=hot[key])

    shipments = add(shipments, vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
    shipments = with_measures(shipments)
    if at_receipt:
        shipments = shipments.withColumn("_on", _business_day(as_of))
        asked_of_states = flat.withColumn("_on", _business_day(as_of))
        asked = asked_of_states.join(order_per_shipment(orders), "shipment_id", "left")
    for dim, natural, key, sk in (
            (dim_fc, "fulfillment_center_id", "fc_id", "fc_sk"),
            (dim_ds, "delivery_station_id", "ds_id", "ds_sk"),
            (dim_vehicle, "vehicle_id", "vehicle_id", "vehicle_sk"),
            (dim_customer, "customer_id", "customer_id", "customer_sk")):
        if at_receipt:
            shipments = as_of_version(
                shipments, _versions(dim, natural, key, sk), key, "_on", [sk], spread_by="shipment_id",
                asked=asked if key == "customer_id" else asked_of_states)
        else:
            shipments = add(shipments, _surrogate(dim, natural, key, sk), key)
    return with_date_key(shipments, calendar, as_of).select(*FACT_COLUMNS)
