"""Backlogs and stuck shipments as maintained views: each batch costs what it changed.

Both views start from the moves of a batch: one row per changed shipment (shipment_id, old, new) with
its live row before (`old`, null for a new shipment) and after, and when each of them becomes stale
(`with_due`). Counting the whole live table again would cost as much as there are shipments; these
views give the same alerts from the moves and from what they kept, and they keep when an alert was
last sent, so its suppression needs no other state.

* Backlog: a move takes one from the facility and kind of its old row and gives one to those of
  its new row. The sums of these signed counts are added to the kept counts.
* Stuck shipments: a row becomes stale at a known time (`due_at`). Entries due later wait in an index by the
  hour they are due; a move that ends a wait writes a cancelling entry into the same hour. A batch
  reads the hours between the clock of the batch before and its own. What is due stays in `overdue`
  until its shipment moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.operators import alerts
from parcelake.schemas import flat

BACKLOG = flat("facility_id string, kind string, backlog bigint, fired_at timestamp")
OVERDUE = flat("shipment_id string, due_at timestamp, shipment_status string, facility_id string, "
               "stage_entered_at timestamp, fired_at timestamp")
# `sign` is 1 for an entry and -1 for its end.
WAITING = flat("shipment_id string, due_at timestamp, shipment_status string, facility_id string, "
               "stage_entered_at timestamp, sign int, due_hour bigint")


def _silenced(now: Column, cooldown_seconds: int) -> Column:
    """An alert was sent that still keeps the next one back (never null)."""
    bound = now - F.make_interval(secs=F.lit(cooldown_seconds))
    return F.coalesce(F.col("fired_at") >= bound, F.lit(False))


# --- backlog -----------------------------------------------------------------------------

def _backlog_kind(status: Column) -> Column:
    return F.when(status.isin(*domain.FC_BACKLOG_STAGES), alerts.FC_BACKLOG).when(
        status.isin(*domain.DS_BACKLOG_STAGES), alerts.DS_BACKLOG)


def backlog_changes(moved: DataFrame) -> DataFrame:
    """facility_id, kind and the signed sum of the moves; nothing where they cancel out."""
    signed = F.explode(F.array(*[
        F.struct(F.col(f"{side}.facility_id").alias("facility_id"),
                 _backlog_kind(F.col(f"{side}.shipment_status")).alias("kind"), F.lit(sign).alias("sign"))
        for side, sign in (("old", -1), ("new", 1))]))
    return (moved.select(signed.alias("_s")).select("_s.*").where("kind IS NOT NULL")
            .groupBy("facility_id", "kind").agg(F.sum("sign").alias("change")).where("change <> 0"))


def next_backlog(kept: DataFrame, changes: DataFrame) -> DataFrame:
    """The counts after the moves. `kept` is empty before the first batch."""
    both = kept.select("facility_id", "kind", "backlog", "fired_at").unionByName(
        changes.select("facility_id", "kind", F.col("change").alias("backlog"),
                       F.lit(None).cast("timestamp").alias("fired_at")))
    return both.groupBy("facility_id", "kind").agg(
        F.sum("backlog").alias("backlog"), F.max("fired_at").alias("fired_at"))


def fire_backlogs(counts: DataFrame, now: Column,
                  cooldown_seconds: int = domain.ALERT_COOLDOWN_SECONDS) -> DataFrame:
    """The view to keep: `fired_at` is `now` where an alert is to be sent, and else when one was
    sent if that still counts."""
    over = F.col("backlog") > F.when(F.col("kind") == alerts.FC_BACKLOG, domain.FC_BACKLOG_LIMIT).otherwise(
        domain.DS_BACKLOG_LIMIT)
    silenced = _silenced(now, cooldown_seconds)
    kept = counts.withColumn("fired_at", F.when(over & ~silenced, now).when(silenced, F.col("fired_at")))
    return kept.where("backlog <> 0 OR fired_at IS NOT NULL").select(*BACKLOG.fieldNames())


def fired_now(backlog: DataFrame, overdue: DataFrame, now: Column) -> DataFrame:
    """The alerts of both views that are sent at `now`."""
    sent = F.col("fired_at") == now
    return alerts.backlog_alerts(backlog.where(sent)).unionByName(alerts.stale_alerts(overdue.where(sent)))


# --- stuck shipments ---------------------------------------------------------------------

def due_at(side: str) -> Column:
    """When the live row in struct `side` becomes stale; null if it never will."""
    def column(name: str) -> Column:
        return F.col(f"{side}.{name}")

    def after(hours: int) -> Column:
        return column("stage_entered_at") + F.make_interval(hours=F.lit(hours))

    status, kind = column("shipment_status"), column("facility_type")
    return (F.when((kind == domain.FC) & ~status.isin(domain.DELIVERED, *domain.FC_LEFT_STAGES),
                   after(domain.FC_STALE_HOURS))
            .when((kind == domain.DS) & ~status.isin(domain.DELIVERED, *domain.DS_LEFT_STAGES),
                  after(domain.DS_STALE_HOURS)))


def with_due(moved: DataFrame) -> DataFrame:
    """Adds old_due and new_due."""
    return moved.withColumns({f"{side}_due": due_at(side) for side in ("old", "new")})


def hour_of(time: Column) -> Column:
    """The hour of a time, numbered from 1970: the partition of the index it is in."""
    return F.floor(F.unix_micros(time) / F.lit(3_600_000_000)).cast("long")


def _entries(moved: DataFrame, side: str, sign: int) -> DataFrame:
    due = F.col(f"{side}_due")
    shown = [F.col(f"{side}.{c}").alias(c) for c in ("shipment_status", "facility_id", "stage_entered_at")]
    return moved.where(due.isNotNull()).select(
        "shipment_id", due.alias("due_at"), *shown, F.lit(sign).alias("sign"), hour_of(due).alias("due_hour"))


def waiting_entries(moved: DataFrame, before: Column | None, now: Column) -> DataFrame:
    """Rows for the index: waits that begin and become due at `now` or later, and ends of waits that
    were not yet due at `before`, the clock of the batch before (None: there was none)."""
    begun = _entries(moved, "new", 1).where(F.col("due_at") >= now)
    if before is None:
        return begun
    return begun.unionByName(_entries(moved, "old", -1).where(F.col("due_at") >= before))


def due_since(index: DataFrame, before: Column, now: Column) -> DataFrame:
    """Waits of the index that became due from `before` until `now`; only their hours are read."""
    due = F.col("due_at")
    open_ones = (
        index.where(F.col("due_hour").between(hour_of(before), hour_of(now)))
        .where((due >= before) & (due < now))
        .groupBy("shipment_id", "due_at").agg(
            F.sum("sign").alias("_open"),
            F.max(F.when(F.col("sign") > 0, F.struct("shipment_status", "facility_id", "stage_entered_at")))
            .alias("_shown"))
        .where("_open > 0"))
    return open_ones.select("shipment_id", "due_at", "_shown.*")


def next_overdue(kept: DataFrame, moved: DataFrame, became_due: DataFrame | None, now: Column) -> DataFrame:
    """What is due at `now`: kept and newly due rows whose shipment has not moved, and rows that
    are due as soon as they are written. A shipment that moved keeps when its alert was sent."""
    columns = [c for c in OVERDUE.fieldNames() if c != "fired_at"]
    unmoved = kept.select(*columns)
    if became_due is not None:
        unmoved = unmoved.unionByName(became_due.select(*columns))
    at_once = _entries(moved, "new", 1).where(F.col("due_at") < now).select(*columns)
    rows = unmoved.join(moved.select("shipment_id"), "shipment_id", "left_anti").where(
        "due_at IS NOT NULL").unionByName(at_once)
    sent = kept.where("fired_at IS NOT NULL").select("shipment_id", "fired_at")
    return rows.join(sent, "shipment_id", "full_outer").select(*OVERDUE.fieldNames())


def fire_stale(overdue: DataFrame, now: Column,
               cooldown_seconds: int = domain.ALERT_COOLDOWN_SECONDS) -> DataFrame:
    """The view to keep, with `fired_at` as in `fire_backlogs`."""
    due = F.coalesce(F.col("due_at") < now, F.lit(False))
    silenced = _silenced(now, cooldown_seconds)
    kept = overdue.withColumn("fired_at", F.when(due & ~silenced, now).when(silenced, F.col("fired_at")))
    return kept.where("due_at IS NOT NULL OR fired_at IS NOT NULL").select(*OVERDUE.fieldNames())
