"""The live path: new shipment events -> live table -> alerts.

The state of a shipment is one row of a streaming aggregation in Spark's state store, and every
aggregate in it is a minimum or maximum, so a batch reads and writes the states of the shipments
it touches, however many others there are. What cannot be a maximum (when a shipment entered its
stage depends on the row before) is computed from the touched states in `foreachBatch`, written as
changed rows, and read back by the same query as its second input: the newest of them is a maximum
again. So the state of a touched shipment always holds its newest event and its live row from before.

The second input reads what earlier batches wrote. A query that fixes its input when it starts
(`availableNow`) would not see that; to catch up and stop, the query runs without pauses until nothing
is left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelake import domain
from parcelake.layout import Layout
from parcelake.operators import alerts, maintained
from parcelake.operators.enrich import add_flags
from parcelake.operators.fact import NEWEST_EVENT, with_stage
from parcelake.operators.live import later_or_same, live_columns, stamped
from parcelake.operators.parse import cast_times, parse_payload
from parcelake.plans.gold import silver_of
from parcelake.schemas import ENTITIES, SHIPMENT_LIVE
from parcelake.sources import fs
from parcelake.streaming.audit import BatchAudit, observed
from parcelake.streaming.state import (
    CHANGED, AlertLog, Batches, LiveTable, due_index, live_table, views)

EVENTS = ENTITIES[domain.TOPIC_SHIPMENT_EVENTS]

AUDIT = "live events"

Lookups = Callable[[], tuple[DataFrame, DataFrame]]


def wall_clock(batch_id: int) -> datetime:
    return datetime.now(timezone.utc)


def micros(at: datetime) -> int:
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def parse_events(log_rows: DataFrame) -> DataFrame:
    """Log rows -> typed events that have a shipment id and readable times.

    What is left out here is still in the raw layer, and bronze and silver quarantine it. As a
    stream, rows and left out rows are counted under the name AUDIT.
    """
    parsed = parse_payload(
        log_rows.select(F.col("value").cast("string").alias("json_payload")), EVENTS.payload)
    typed = cast_times(parsed.drop("json_payload"), EVENTS.times, "_bad")
    left_out = F.col("quarantined") | F.col(EVENTS.key).isNull() | F.col("_bad")
    if typed.isStreaming:
        typed = observed(typed, AUDIT, left_out)
    return typed.where(~left_out).drop("quarantined", "_bad")


def silver_lookups(spark: SparkSession, layout: Layout) -> Lookups:
    """Centers and stations of the newest silver version, looked up per batch."""
    return lambda: (
        silver_of(spark, layout, domain.TOPIC_FULFILLMENT_CENTERS),
        silver_of(spark, layout, domain.TOPIC_DELIVERY_STATIONS),
    )


# --- state -------------------------------------------------------------------------------

_EVENT = [*NEWEST_EVENT, *[f.name for f in EVENTS.payload.fields
                           if f.name not in (*NEWEST_EVENT, "shipment_id", "event_type")]]
_HIT = ["arrived", "event_timestamp", "event_id", "shipment_status", "customer_tier", "delivery_type",
        "is_delayed", "delay_minutes", "is_sla_at_risk", "estimated_delivery_time", "promised_delivery_time"]
_RULES = {"prime": alerts.is_prime_sla, "delay": alerts.is_delay}


def shipment_state(events: DataFrame, written: DataFrame, arrived: Column | None = None) -> DataFrame:
    """One row per shipment from its events and the changed rows that earlier batches wrote.

    event: the newest event; arrived: when the last one came; <rule>_first, <rule>_last: when an
    event first called for an alert, and the newest that did; eta_<limit>: the ETA that came last, the
    latest of its batch, of delivery types with that limit; row: the newest of the changed rows.
    All are minima or maxima. As a stream: the touched shipments.
    """
    flagged = with_stage(add_flags(events)).withColumn(
        "arrived", F.current_timestamp() if arrived is None else arrived)
    hits = [F.when(rule(), F.struct(*_HIT)).alias(f"{name}_hit") for name, rule in _RULES.items()]
    eta = F.struct("arrived", "estimated_delivery_time", "delivery_type")
    etas = [F.when(F.col("estimated_delivery_time").isNotNull() & (alerts.eta_change_limit() == limit), eta)
            .alias(f"eta_{limit}") for limit in alerts.ETA_CHANGE_LIMITS]
    incoming = flagged.select("shipment_id", F.struct(*_EVENT).alias("event"), "arrived", *hits, *etas,
                              F.lit(None).alias("row"))
    back = written.select("shipment_id", F.struct("batch_id", *[
        c for c in written.columns if c != "batch_id"]).alias("row"))
    both = incoming.unionByName(back, allowMissingColumns=True)
    rules = [pick(f"{name}_hit{part}").alias(f"{name}_{when}") for name in _RULES
             for pick, part, when in ((F.min, ".arrived", "first"), (F.max, "", "last"))]
    return both.groupBy("shipment_id").agg(
        F.max("event").alias("event"), F.max("arrived").alias("arrived"), *rules,
        *[F.max(f"eta_{limit}").alias(f"eta_{limit}") for limit in alerts.ETA_CHANGE_LIMITS],
        F.max("row").alias("row"))


def touched(states: DataFrame) -> DataFrame:
    """The states to which events have come since their row was written. (The others of a batch
    only took in the row that the batch before wrote.)"""
    return states.where("event IS NOT NULL AND (row IS NULL OR arrived > row.arrived)")


def event_alerts() -> Column:
    """The alerts that the last events of a state call for, as an array; each once per shipment."""
    def first_hit(name: str, kind: str) -> Column:
        hit = f"{name}_last"
        about = {c: F.col(f"{hit}.{c}") for c in (
            "shipment_status", "delivery_type", "estimated_delivery_time", "promised_delivery_time")}
        detail = F.concat_ws(" ", f"{hit}.shipment_status", F.lit("delay"),
                             F.col(f"{hit}.delay_minutes").cast("string"))
        return F.when(F.col(f"{name}_first") == F.col("arrived"), alerts.struct_of(kind, detail, about))

    def moved(limit: int) -> Column:
        eta, was = F.col(f"eta_{limit}.estimated_delivery_time"), F.col("row.estimated_delivery_time")
        minutes = (F.unix_micros(eta) - F.unix_micros(was)) / F.lit(60e6)
        return F.when(
            (F.col(f"eta_{limit}.arrived") == F.col("arrived")) & (minutes > limit),
            F.struct(minutes.alias("minutes"), F.col(f"eta_{limit}.delivery_type").alias("delivery_type"),
                     eta.alias("eta"), was.alias("was")))

    worst = F.array_max(F.array(*[moved(limit) for limit in alerts.ETA_CHANGE_LIMITS]))
    detail = F.concat_ws(" ", F.lit("eta +"), F.round(worst["minutes"]).cast("long").cast("string"))
    late = F.when(worst.isNotNull() & ~F.col("row.eta_alerted"), alerts.struct_of(
        alerts.ETA_CHANGE, detail, {
            "delivery_type": worst["delivery_type"], "estimated_delivery_time": worst["eta"],
            "previous_estimated_time": worst["was"]}))
    return F.array_compact(F.array(
        first_hit("prime", alerts.PRIME_SLA), first_hit("delay", alerts.DELAY), late))


def after_events(states: DataFrame, centers: DataFrame, stations: DataFrame, now: Column) -> DataFrame:
    """What becomes of the touched states: shipment_id, arrived, event_id, found (alerts), old (the
    row before, null for a new shipment), new (the row that replaces it, null if it stays), and when
    they become stale. No shuffle: a state holds all of it."""
    beside = ["arrived", "event_id", "found", "row"]
    newest = live_columns(
        states.withColumn("found", event_alerts()).select("shipment_id", "event.*", *[
            c for c in beside if c != "event_id"]), centers, stations, beside)
    live = [c for c in newest.columns if c not in beside]
    # Each struct is made once: without a generator between, every use of a field would copy
    # the expression of the whole struct into the plan.
    both = newest.select("shipment_id", *beside[:-1], F.col("row").alias("old"),
                         F.explode(F.array(F.struct(*live))).alias("came"))
    seen = ("event_timestamp", "shipment_status")
    news = F.col("event_id").eqNullSafe(F.col("old.event_id"))
    for column in seen:
        news = news & F.col(f"came.{column}").eqNullSafe(F.col(f"old.{column}"))
    replaces = F.col("old").isNull() | (~news & later_or_same("came", "old"))
    rows = both.select("shipment_id", *beside[:-1], "old",
                       F.explode(F.array(F.when(replaces, stamped("came", "old", now)))).alias("new"))
    return maintained.with_due(rows)


def written(results: DataFrame, batch_id: int) -> DataFrame:
    """Rows for the second input: the changed ones, and those that only note a sent ETA alert."""
    late = F.exists("found", lambda alert: alert["alert_type"] == alerts.ETA_CHANGE)
    changed = F.col("new").isNotNull()
    values = [F.when(changed, F.col(f"new.{f.name}")).otherwise(F.col(f"old.{f.name}")).alias(f.name)
              for f in SHIPMENT_LIVE.fields]
    return results.where(changed | late).select(
        F.lit(batch_id).cast("long").alias("batch_id"), "arrived",
        F.when(changed, F.col("event_id")).otherwise(F.col("old.event_id")).alias("event_id"),
        (late | F.coalesce("old.eta_alerted", F.lit(False))).alias("eta_alerted"), *values)


# --- a batch -----------------------------------------------------------------------------

@dataclass
class LiveBatch:
    """The micro-batch handler. All work is DataFrame work; no row comes to the driver.

    An error is not swallowed: it ends the query, and a restart runs the same batch again on
    the same state and replaces what the first attempt wrote, so no batch is lost and none
    counts twice.
    """

    spark: SparkSession
    layout: Layout
    lookups: Lookups
    clock: Callable[[int], datetime] = wall_clock
    changed: dict[int, int] = field(default_factory=dict)       # batch -> rows written, of the last few

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Used by the upsert, the views and the alerts. A lost cached piece is computed again.
        states = touched(batch).persist()
        try:
            if not states.isEmpty():
                self._apply(states, batch_id, self.clock(batch_id))
        finally:
            states.unpersist()

    def _apply(self, states: DataFrame, batch_id: int, at: datetime) -> None:
        now = F.lit(at).cast("timestamp")
        results = after_events(states, *self.lookups(), now).persist()
        try:
            seen = Observation("changed rows")
            live_table(self.spark, self.layout).write_changes(
                batch_id, written(results, batch_id).observe(seen, F.count(F.lit(1)).alias("rows")))
            self.changed[batch_id] = seen.get["rows"]
            self.changed.pop(batch_id - 100, None)
            kept = self._maintain(results.where("new IS NOT NULL"), batch_id, now)
            sent = results.select(F.explode("found").alias("_alert")).select("_alert.*").unionByName(
                maintained.fired_now(kept.read("backlog", batch_id), kept.read("overdue", batch_id), now))
            AlertLog(self.spark, self.layout.alerts()).write(
                batch_id, sent.withColumn("fired_at", now), at.astimezone(timezone.utc).date().isoformat())
            kept.finish(batch_id, micros(at))
            self._forget(batch_id)
        finally:
            results.unpersist()

    def _maintain(self, moved: DataFrame, batch_id: int, now: Column) -> Batches:
        """Bring both views up to this batch."""
        kept, index = views(self.spark, self.layout), due_index(self.spark, self.layout)
        kept.begin(batch_id)
        last = kept.last(before=batch_id)
        before = None if last is None else F.timestamp_micros(F.lit(kept.clock(last)))

        counts = maintained.next_backlog(kept.read("backlog", last), maintained.backlog_changes(moved))
        kept.write("backlog", batch_id, maintained.fire_backlogs(counts, now))

        index.write(batch_id, maintained.waiting_entries(moved, before, now))
        became_due = None if before is None else maintained.due_since(index.before(batch_id), before, now)
        overdue = maintained.next_overdue(kept.read("overdue", last), moved, became_due, now)
        kept.write("overdue", batch_id, maintained.fire_stale(overdue, now))
        return kept

    def _forget(self, batch_id: int) -> None:
        """Drop what no batch, also a repeated one, reads any more."""
        kept = views(self.spark, self.layout)
        last = kept.last(before=batch_id)
        if last is not None:
            due_index(self.spark, self.layout).forget(kept.clock(last) // 3_600_000_000)
        kept.forget(batch_id)
        live_table(self.spark, self.layout).forget(batch_id)


# --- query -------------------------------------------------------------------------------

def written_rows(spark: SparkSession, live: LiveTable) -> DataFrame:
    """The changed rows of all batches as a stream."""
    fs.make_dir(spark, live.changes_path)
    return (spark.readStream.schema(CHANGED).option("recursiveFileLookup", "true")
            .parquet(live.changes_path))


def start_live(spark: SparkSession, log, layout: Layout, *, since: str = "latest",
               trigger: dict | None = None, once: bool = False,
               clock: Callable[[int], datetime] = wall_clock,
               audit: BatchAudit | None = None) -> StreamingQuery:
    """Start the live query; with `once`, return when it has caught up and was stopped."""
    events = parse_events(log.stream(spark, domain.TOPIC_SHIPMENT_EVENTS, since))
    states = shipment_state(events, written_rows(spark, live_table(spark, layout)))
    handler = LiveBatch(spark, layout, silver_lookups(spark, layout), clock)
    if audit is not None:
        audit.written[AUDIT] = lambda batch_id: handler.changed.get(batch_id, 0)
    query = (
        states.writeStream.outputMode("update")
        .foreachBatch(handler)
        .option("checkpointLocation", layout.checkpoint("live"))
        .trigger(**({"processingTime": "0 seconds"} if once else trigger or {"processingTime": "10 seconds"}))
        .start()
    )
    if once:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return query

