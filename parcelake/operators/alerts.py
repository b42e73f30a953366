"""Alert rules as rows, and their suppression.

A row has alert_key, alert_type, subject_id, a short detail and the columns of ALERT_SUBJECT, which
are null where the type of alert has no such thing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.functions import by_code
from parcelake.operators.live import is_stale
from parcelake.schemas import ALERT_SUBJECT

PRIME_SLA, DELAY, ETA_CHANGE = "PRIME_SLA", "DELAY", "ETA_CHANGE"
FC_BACKLOG, DS_BACKLOG, STALE = "FC_BACKLOG", "DS_BACKLOG", "STALE"

# These fire again after the cooldown; the others fire once per shipment.
REPEATING = (FC_BACKLOG, DS_BACKLOG, STALE)


def _limit_minutes(table: Mapping[str, int]) -> Column:
    kind = F.coalesce(F.nullif("delivery_type", F.lit("")), F.lit(domain.STANDARD))
    return by_code(kind, table, domain.OTHER_TYPE_ALERT_MINUTES)


def _as_alerts(hits: DataFrame, alert_type: Column | str, subject: str, detail: Column,
               about: Sequence[str] = ()) -> DataFrame:
    """`about`: the columns of ALERT_SUBJECT that `hits` has."""
    kind = F.lit(alert_type)
    return hits.select(
        F.concat_ws(":", F.col(subject), kind).alias("alert_key"),
        kind.alias("alert_type"),
        F.col(subject).alias("subject_id"),
        detail.alias("detail"),
        *[(F.col(f.name) if f.name in about else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in ALERT_SUBJECT.fields],
    )


def _once_per_shipment(events: DataFrame, alert_type: str, detail: Column) -> DataFrame:
    """One alert per shipment, with the content of its newest matching event."""
    about = ("shipment_status", "delivery_type", "estimated_delivery_time", "promised_delivery_time")
    newest = F.max_by(F.struct(detail.alias("_detail"), *about), F.struct("event_timestamp", "event_id"))
    return _as_alerts(
        events.groupBy("shipment_id").agg(newest.alias("_newest")).select("shipment_id", "_newest.*"),
        alert_type, "shipment_id", F.col("_detail"), about)


def is_prime_sla() -> Column:
    """An event that calls for a PRIME_SLA alert."""
    return (F.col("customer_tier") == domain.PRIME) & F.col("is_sla_at_risk")


def is_delay() -> Column:
    """An event that calls for a DELAY alert."""
    minutes = F.coalesce("delay_minutes", F.lit(0))
    return F.col("is_delayed") & (minutes > _limit_minutes(domain.DELAY_ALERT_MINUTES))


def eta_change_limit() -> Column:
    """By how many minutes an event's ETA may move before an ETA_CHANGE alert."""
    return _limit_minutes(domain.ETA_CHANGE_ALERT_MINUTES)


ETA_CHANGE_LIMITS = tuple(sorted({*domain.ETA_CHANGE_ALERT_MINUTES.values(), domain.OTHER_TYPE_ALERT_MINUTES}))


def prime_sla(events: DataFrame) -> DataFrame:
    return _once_per_shipment(events.where(is_prime_sla()), PRIME_SLA, F.concat_ws(
        " ", F.col("shipment_status"), F.lit("delay"), F.col("delay_minutes").cast("string")))


def delay(events: DataFrame) -> DataFrame:
    return _once_per_shipment(events.where(is_delay()), DELAY, F.concat_ws(
        " ", F.col("shipment_status"), F.lit("delay"), F.col("delay_minutes").cast("string")))


def eta_change(events: DataFrame, stored: DataFrame) -> DataFrame:
    """ETA of a batch event later than the stored ETA by more than the limit of its type.

    The limit depends on the delivery type only, so the latest ETA per shipment and type
    decides; the batch is reduced to that before it meets the stored rows.
    """
    latest = (
        events.where(F.col("estimated_delivery_time").isNotNull())
        .groupBy("shipment_id", "delivery_type")
        .agg(F.max("estimated_delivery_time").alias("_eta"))
    )
    before = stored.select(
        "shipment_id", F.col("estimated_delivery_time").alias("_was"))
    minutes = (F.unix_micros("_eta") - F.unix_micros("_was")) / F.lit(60e6)
    worst = (
        latest.join(before, "shipment_id")
        .withColumn("_minutes", minutes)
        .where(F.col("_minutes") > eta_change_limit())
        .groupBy("shipment_id").agg(F.max(F.struct(
            "_minutes", "delivery_type", F.col("_eta").alias("estimated_delivery_time"),
            F.col("_was").alias("previous_estimated_time"))).alias("_worst"))
        .select("shipment_id", "_worst.*")
    )
    return _as_alerts(worst, ETA_CHANGE, "shipment_id", F.concat_ws(
        " ", F.lit("eta +"), F.round("_minutes").cast("long").cast("string")),
        ("delivery_type", "estimated_delivery_time", "previous_estimated_time"))


def backlogs(live: DataFrame) -> DataFrame:
    """Facilities over the limit, of both kinds, from one aggregation of the live table."""
    status = F.col("shipment_status")
    kinds = [(FC_BACKLOG, domain.FC_BACKLOG_STAGES, domain.FC_BACKLOG_LIMIT),
             (DS_BACKLOG, domain.DS_BACKLOG_STAGES, domain.DS_BACKLOG_LIMIT)]
    kind = F.when(status.isin(*kinds[0][1]), kinds[0][0]).when(
        status.isin(*kinds[1][1]), kinds[1][0])
    limit = by_code("kind", {name: limit for name, _, limit in kinds})
    over = (
        live.where(status.isin(*kinds[0][1], *kinds[1][1]))
        .groupBy("facility_id", kind.alias("kind")).agg(F.count("*").alias("backlog"))
        .where(F.col("backlog") > limit)
    )
    return backlog_alerts(over)


def backlog_alerts(over: DataFrame) -> DataFrame:
    """Alerts of the facilities in `over` (facility_id, kind, backlog)."""
    return _as_alerts(over, F.col("kind"), "facility_id", F.col("backlog").cast("string"))


def fc_backlog(live: DataFrame) -> DataFrame:
    return backlogs(live.where(F.col("shipment_status").isin(*domain.FC_BACKLOG_STAGES)))


def ds_backlog(live: DataFrame) -> DataFrame:
    return backlogs(live.where(F.col("shipment_status").isin(*domain.DS_BACKLOG_STAGES)))


def stale(live: DataFrame, as_of: Column) -> DataFrame:
    both = (
        live.where(F.col("shipment_status") != domain.DELIVERED)    # implied; prunes partitions
        .where(is_stale(domain.FC, as_of) | is_stale(domain.DS, as_of))
    )
    return stale_alerts(both)


def stale_alerts(stuck: DataFrame) -> DataFrame:
    return _as_alerts(stuck, STALE, "shipment_id", F.concat_ws(
        " ", F.col("facility_id"), F.col("shipment_status")), ("shipment_status", "stage_entered_at"))


def struct_of(alert_type: str, detail: Column, about: Mapping[str, Column]) -> Column:
    """An alert about the shipment of a row as a struct, for rows that may call for several."""
    return F.struct(
        F.concat_ws(":", F.col("shipment_id"), F.lit(alert_type)).alias("alert_key"),
        F.lit(alert_type).alias("alert_type"), F.col("shipment_id").alias("subject_id"),
        detail.alias("detail"),
        *[about.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ALERT_SUBJECT.fields])


def batch_alerts(events: DataFrame, stored: DataFrame) -> DataFrame:
    """Alerts of single events; `stored` holds the live rows from before the batch."""
    return prime_sla(events).unionByName(delay(events)).unionByName(eta_change(events, stored))


def table_alerts(live: DataFrame, as_of: Column) -> DataFrame:
    """Alerts of the whole live table."""
    return backlogs(live).unionByName(stale(live, as_of))


def blocks(now: Column, cooldown_seconds: int = domain.ALERT_COOLDOWN_SECONDS) -> Column:
    """Whether a sent alert keeps its key from being sent at `now` or later."""
    repeats = F.col("alert_type").isin(*REPEATING)
    return ~repeats | (F.col("fired_at") >= now - F.make_interval(secs=F.lit(cooldown_seconds)))


def unsent(found: DataFrame, log: DataFrame, now: Column,
           cooldown_seconds: int = domain.ALERT_COOLDOWN_SECONDS) -> DataFrame:
    """Alerts to send now: never sent before, or repeating and last sent over a cooldown ago."""
    blocking = log.where(blocks(now, cooldown_seconds)).select("alert_key")
    return found.join(blocking, "alert_key", "left_anti").select(
        *found.columns, now.alias("fired_at"))
