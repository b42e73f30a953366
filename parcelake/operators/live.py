"""The live shipment table: keyed upsert of a micro-batch, and the panels that read it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.functions import round_to, stage_number
from parcelake.operators.enrich import add_flags, with_facilities
from parcelake.operators.fact import latest_state
from parcelake.schemas import SHIPMENT_LIVE

# What an upsert has to know about the stored row.
STORED_COLUMNS = (
    "shipment_id", "shipment_status", "event_timestamp", "estimated_delivery_time",
    "stage_entered_at",
)


_ADDED = ("fc_name", "ds_name", "fc_region", "ds_region", "is_sla_at_risk", "is_priority",
          "stage_entered_at", "last_updated")


def to_live_rows(events: DataFrame, centers: DataFrame, stations: DataFrame) -> DataFrame:
    """Newest event per shipment in the columns of the live table, before the upsert.

    Names and flags are added to the newest events only, after the others are gone.
    """
    carried = [c for c in SHIPMENT_LIVE.fieldNames() if c not in _ADDED]
    return live_columns(latest_state(events.select("event_id", *carried)), centers, stations)


def live_columns(newest: DataFrame, centers: DataFrame, stations: DataFrame,
                 keep: Sequence[str] = ()) -> DataFrame:
    """The columns of the live table, for one event per shipment, and the columns in `keep`."""
    full = add_flags(with_facilities(newest, centers, stations))
    return full.select(*keep, *[
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in SHIPMENT_LIVE.fields if f.name in full.columns])


def later_or_same(new: str, old: str) -> Column:
    """True when the event in struct `new` is not older than the state in struct `old`."""
    def rank(side: str) -> Column:
        return F.struct(F.col(f"{side}.event_timestamp"), stage_number(f"{side}.shipment_status"))

    return F.col(old).isNull() | (rank(new) >= rank(old))


def stamped(new: str, old: str, now: Column | None) -> Column:
    """The live row for the event in `new` that replaces the state in `old`.

    `stage_entered_at` moves for a new shipment and when the status changes, and is kept
    otherwise; a status that is null before or after does not count as a change.
    """
    clock = F.col(f"{new}.event_timestamp") if now is None else now
    moved = F.col(old).isNull() | (
        F.col(f"{new}.shipment_status") != F.col(f"{old}.shipment_status"))
    stamps = {
        "stage_entered_at": F.when(moved, clock).otherwise(F.col(f"{old}.stage_entered_at")),
        "last_updated": clock,
    }
    return F.struct(*[
        stamps.get(c, F.col(f"{new}.{c}")).cast(SHIPMENT_LIVE[c].dataType).alias(c)
        for c in SHIPMENT_LIVE.fieldNames()])


def _as_struct(df: DataFrame, name: str) -> DataFrame:
    return df.select("shipment_id", F.struct(*df.columns).alias(name))


def changed_rows(incoming: DataFrame, stored: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows of the live table that `incoming` (one row per shipment) inserts or replaces.

    A late event that is older than the stored state changes nothing. `now` is the processing
    time; None stamps rows with their event time. `stored` needs STORED_COLUMNS only.
    """
    return (
        _as_struct(incoming, "new").join(_as_struct(stored, "old"), "shipment_id", "left")
        .where(later_or_same("new", "old"))
        .select(stamped("new", "old", now).alias("_row"))
        .select("_row.*")
    )


def after_changes(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """The live table after a batch: the changed rows, and the stored rows they do not replace."""
    return stored.join(changed.select("shipment_id"), "shipment_id", "left_anti").unionByName(changed)


# --- panels -----------------------------------------------------------------------------

def _active(live: DataFrame) -> DataFrame:
    return live.where(F.col("shipment_status") != domain.DELIVERED)


def active_shipments(live: DataFrame) -> DataFrame:
    return _active(live).agg(F.count("*").alias("value"))


def delayed_shipments(live: DataFrame) -> DataFrame:
    return active_shipments(live.where("is_delayed"))


def sla_at_risk(live: DataFrame) -> DataFrame:
    return active_shipments(live.where("is_sla_at_risk"))


def average_delay(live: DataFrame) -> DataFrame:
    """Mean delay of the delayed active shipments in whole minutes, 0 if there are none."""
    mean = round_to(F.avg("delay_minutes"), 0)
    return _active(live).where("is_delayed").agg(F.coalesce(mean, F.lit(0.0)).alias("value"))


def by_status(live: DataFrame) -> DataFrame:
    return live.groupBy("shipment_status").agg(F.count("*").alias("shipments")).orderBy(
        F.desc("shipments"))


def by_tier(live: DataFrame) -> DataFrame:
    return _active(live).groupBy("customer_tier").agg(F.count("*").alias("shipments")).orderBy(
        F.desc("shipments"))


def _backlog_panel(live: DataFrame, stages: tuple[str, ...], name: str) -> DataFrame:
    return (
        live.where(F.col("shipment_status").isin(*stages))
        .groupBy("facility_id", name).agg(F.count("*").alias("backlog"))
        .select(F.coalesce(name, "facility_id").alias("facility"), "backlog")
        .orderBy(F.desc("backlog"))
    )


def fc_backlog(live: DataFrame) -> DataFrame:
    return _backlog_panel(live, domain.FC_BACKLOG_STAGES, "fc_name")


def ds_backlog(live: DataFrame) -> DataFrame:
    return _backlog_panel(live, domain.DS_BACKLOG_STAGES, "ds_name")


def is_stale(kind: str, as_of: Column) -> Column:
    """Row is at a facility of `kind` and entered its stage too long before `as_of`."""
    hours, left = {
        domain.FC: (domain.FC_STALE_HOURS, domain.FC_LEFT_STAGES),
        domain.DS: (domain.DS_STALE_HOURS, domain.DS_LEFT_STAGES),
    }[kind]
    return (
        (F.col("facility_type") == kind)
        & (F.col("stage_entered_at") < as_of - F.make_interval(hours=F.lit(hours)))
        & ~F.col("shipment_status").isin(*left))


def _stale_panel(live: DataFrame, kind: str, name: str, as_of: Column) -> DataFrame:
    seconds = (F.unix_micros(as_of) - F.unix_micros("stage_entered_at")) / F.lit(1e6)
    return live.where(is_stale(kind, as_of)).select(
        "shipment_id", "shipment_status", F.coalesce(name, "facility_id").alias("facility"),
        "stage_entered_at", round_to(seconds / F.lit(3600.0), 1).alias("hours_stuck"),
    ).orderBy("stage_entered_at")


def stale_fc(live: DataFrame, as_of: Column) -> DataFrame:
    return _stale_panel(live, domain.FC, "fc_name", as_of)


def stale_ds(live: DataFrame, as_of: Column) -> DataFrame:
    return _stale_panel(live, domain.DS, "ds_name", as_of)


def live_feed(live: DataFrame, rows: int = 25) -> DataFrame:
    """The most recently updated shipments; equal times are ordered by shipment."""
    return live.orderBy(F.desc("last_updated"), "shipment_id").limit(rows).select(
        "shipment_id", "shipment_status", "customer_tier", "delivery_type", "is_delayed",
        "delay_minutes", "is_sla_at_risk",
        F.coalesce("fc_name", "ds_name", "facility_id").alias("facility"), "last_updated")
