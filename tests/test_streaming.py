"""Streams on replayed log files: same result as a batch, restart, repeated batch."""

import json
import random
import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from parcelake import domain
from parcelake.layout import Layout
from parcelake.operators.enrich import add_flags, enrich
from parcelake.operators.fact import latest_state
from parcelake.plans import layers
from parcelake.schemas import ENTITIES, SHIPMENT_LIVE
from parcelake.sources import raw
from parcelake.sources.log import ReplayLog
from parcelake.streaming.ingest import start_ingest
from parcelake.streaming.live import LiveBatch, parse_events, shipment_state, silver_lookups, start_live
from parcelake.streaming.state import AlertLog, due_index, live_table, views
from tests.replay import Replay, event_payload, order_payload

NOW = {"availableNow": True}
START = datetime(2026, 7, 1, 15, 0, tzinfo=timezone.utc)


def clock(batch_id):
    return START + timedelta(minutes=batch_id)


@pytest.fixture
def lake(spark, tmp_path):
    """Replay log, layout, and silver lookups already built."""
    replay, layout = Replay(tmp_path / "log"), Layout(str(tmp_path / "lake"))
    replay.add_master()
    log = ReplayLog(str(tmp_path / "log"), files_per_trigger=1)
    run_ts = F.lit("2026-07-01 00:00:00").cast("timestamp")
    for name in ("fulfillment_centers", "delivery_stations", "vehicles"):
        layers.ingest_batch(spark, log, ENTITIES[name], layout, run_ts)
        layers.bronze(spark, ENTITIES[name], layout, run_ts)
        layers.silver(spark, ENTITIES[name], layout, run_ts)
    return replay, layout, log


def run(spark, log, layout):
    start_live(spark, log, layout, since="earliest", once=True, clock=clock)


def state_of(spark, layout):
    return {r["shipment_id"]: r.asDict() for r in live_table(spark, layout).read().collect()}


def test_ingest_is_exactly_once_over_a_restart(spark, lake):
    replay, layout, log = lake
    for _ in range(2):
        replay.add("orders", [order_payload()])
        replay.add("shipment_events", [event_payload(1), "not json"])
        for query in start_ingest(spark, log, layout, trigger=NOW):
            query.awaitTermination()
    assert raw.read(spark, layout.raw("events", "orders")).count() == 2
    assert raw.read(spark, layout.raw("events", "shipment_events")).count() == 4
    run_ts = F.lit("2026-07-01 00:00:00").cast("timestamp")
    assert layers.bronze(spark, ENTITIES["shipment_events"], layout, run_ts) == {
        "rows": 4, "quarantined": 2}


def test_live_table_equals_the_latest_state_of_all_events(spark, lake):
    replay, layout, log = lake
    rng = random.Random(7)
    events = [event_payload(n, f"S{i}") for i in range(12) for n in range(1, rng.randrange(2, 8))]
    rng.shuffle(events)
    for start in range(0, len(events), 9):
        replay.add("shipment_events", events[start:start + 9])
    run(spark, log, layout)

    expected = {
        r["shipment_id"]: (r["shipment_status"], r["event_timestamp"], r["vehicle_id"])
        for r in latest_state(parse_events(log.scan(spark, "shipment_events"))).collect()}
    got = state_of(spark, layout)
    assert {s: (r["shipment_status"], r["event_timestamp"], r["vehicle_id"])
            for s, r in got.items()} == expected
    assert set(next(iter(got.values()))) == set(SHIPMENT_LIVE.fieldNames())

    before = state_of(spark, layout)
    run(spark, log, layout)                                     # restart, nothing new
    assert state_of(spark, layout) == before


def test_alerts_fire_once_over_batches_and_restarts(spark, lake):
    replay, layout, log = lake
    replay.add("shipment_events", [event_payload(1)])
    replay.add("shipment_events", [event_payload(2)])
    run(spark, log, layout)
    replay.add("shipment_events", [
        event_payload(3, estimated_delivery_time="2026-07-01 16:00:00"), "broken", "{}"])
    run(spark, log, layout)
    history = AlertLog(spark, layout.alerts()).history()
    assert sorted(r["alert_key"] for r in history.collect()) == [
        "S1:DELAY", "S1:ETA_CHANGE", "S1:PRIME_SLA"]
    eta = history.where("alert_type = 'ETA_CHANGE'").first()
    # batch 2 only took in the rows that batch 1 had written
    assert eta["detail"] == "eta + 75" and eta["fired_at"] == (START + timedelta(minutes=3)).replace(
        tzinfo=None)


class Batches:
    """Hands batches to the handler as the stream does, each with its own clock."""

    def __init__(self, spark, layout, make):
        self.spark, self.layout, self.make = spark, layout, make
        self.rows, self.times = [], {}
        self.handler = LiveBatch(spark, layout, silver_lookups(spark, layout), self.times.__getitem__)

    def states(self, batch_id):
        log = self.make("value string, at timestamp", *self.rows)
        events = None
        for at in sorted({r[1] for r in self.rows}):
            part = parse_events(log.where(F.col("at") == F.lit(at).cast("timestamp"))).withColumn(
                "at", F.lit(at).cast("timestamp"))
            events = part if events is None else events.unionByName(part)
        written = live_table(self.spark, self.layout).changes(before=batch_id)
        return shipment_state(events, written, F.col("at"))

    def add(self, batch_id, minutes, *payloads):
        self.times[batch_id] = START + timedelta(minutes=minutes)
        arrived = str((datetime(2026, 1, 1) + timedelta(seconds=batch_id)))
        self.rows += [(json.dumps(p), arrived) for p in payloads]
        self.again(batch_id)

    def again(self, batch_id):
        self.handler(self.states(batch_id), batch_id)

    def history(self, kind):
        rows = AlertLog(self.spark, self.layout.alerts()).history().where(F.col("alert_type").isin(*kind))
        return sorted((r["alert_key"], r["fired_at"]) for r in rows.collect())


def minute(m):
    return (START + timedelta(minutes=m)).replace(tzinfo=None)


def test_stale_alert_fires_again_after_the_cooldown(spark, lake, make):
    batches = Batches(spark, lake[1], make)
    for batch_id, minutes in enumerate((0, 250, 300, 311)):
        shipment = "S1" if batch_id == 0 else f"other{batch_id}"
        batches.add(batch_id, minutes, event_payload(1 if batch_id == 0 else 7, shipment))
    assert batches.history(["STALE"]) == [("S1:STALE", minute(250)), ("S1:STALE", minute(311))]


def test_late_older_events_lose(spark, lake, make):
    batches = Batches(spark, lake[1], make)
    batches.add(0, 0, event_payload(4))
    batches.add(1, 1, event_payload(2))
    batches.add(2, 2, event_payload(4, "S2"))
    state = state_of(spark, lake[1])
    assert state["S1"]["shipment_status"] == "RECEIVED_AT_DS"
    assert state["S1"]["last_updated"] == state["S1"]["stage_entered_at"] == minute(0)
    assert state["S2"]["last_updated"] == minute(2)


def recount(spark, layout, at):
    """The alerts of the whole live table, and the counts themselves, from scratch."""
    from parcelake.operators import alerts

    rows = live_table(spark, layout).read()
    now = F.lit(at).cast("timestamp")
    stale = sorted(r["alert_key"] + r["detail"] for r in alerts.stale(rows, now).collect())
    counts = {}
    for r in rows.select("facility_id", "shipment_status").collect():
        for kind, stages in (("FC_BACKLOG", domain.FC_BACKLOG_STAGES), ("DS_BACKLOG", domain.DS_BACKLOG_STAGES)):
            if r["shipment_status"] in stages:
                counts[r["facility_id"], kind] = counts.get((r["facility_id"], kind), 0) + 1
    return stale, counts


def maintained_now(spark, layout, batch_id, at):
    from parcelake.operators import alerts

    kept = views(spark, layout)
    due = kept.read("overdue", batch_id).where(F.col("due_at") < F.lit(at).cast("timestamp"))
    stale = sorted(r["alert_key"] + r["detail"] for r in alerts.stale_alerts(due).collect())
    counts = {(r["facility_id"], r["kind"]): r["backlog"]
              for r in kept.read("backlog", batch_id).collect() if r["backlog"]}
    return stale, counts


def test_maintained_views_equal_a_recount(spark, lake, make):
    """Random events, late and repeated ones too, over random clocks; some batches run twice."""
    rng = random.Random(2)
    layout, batches = lake[1], Batches(spark, lake[1], make)
    minutes, sent = 0, []
    for batch_id in range(6):
        minutes += rng.choice([1, 20, 61, 130, 241, 900])
        payloads = [
            event_payload(rng.randrange(1, 8), f"S{rng.randrange(9)}", facility_id=rng.choice(["FC_10", "X"]))
            for _ in range(rng.randrange(1, 6))]
        payloads += rng.sample(sent, min(len(sent), 2))
        sent += payloads
        batches.add(batch_id, minutes, *payloads)
        if rng.random() < .4:
            batches.again(batch_id)
        at = batches.times[batch_id]
        if views(spark, layout).last() == batch_id:
            assert maintained_now(spark, layout, batch_id, at) == recount(spark, layout, at)
    keys = batches.history(["PRIME_SLA", "DELAY", "ETA_CHANGE"])
    assert keys and len({k for k, _ in keys}) == len(keys)


def test_backlog_alert_of_a_maintained_count(spark, lake, make):
    batches = Batches(spark, lake[1], make)
    batches.add(0, 0, *[event_payload(1, f"S{i}") for i in range(10)])
    assert batches.history(["FC_BACKLOG"]) == []
    batches.add(1, 1, event_payload(2, "S10"))
    batches.add(2, 2, event_payload(2, "S11"))                                 # still silenced
    batches.add(3, 62, event_payload(3, "S0"), event_payload(3, "S1"))         # down to the limit
    batches.add(4, 63, event_payload(2, "S12"))
    facility = event_payload(1)["facility_id"]
    assert batches.history(["FC_BACKLOG"]) == [(f"{facility}:FC_BACKLOG", minute(m)) for m in (1, 63)]


def test_a_batch_reads_what_it_touches_not_the_history(spark, lake, make, tmp_path):
    """Rows that go through the handler's joins do not grow with delivered shipments."""
    read = []
    for delivered in (5, 50):
        layout = Layout(str(tmp_path / f"lake{delivered}"))
        for kind, name in (("master", "fulfillment_centers"), ("master", "delivery_stations")):
            shutil.copytree(lake[1].silver(kind, name), layout.silver(kind, name))
        log = ReplayLog(str(tmp_path / f"log{delivered}"), files_per_trigger=1)
        replay = Replay(tmp_path / f"log{delivered}")
        replay.add("shipment_events", [event_payload(7, f"D{i}") for i in range(delivered)])
        replay.add("shipment_events", [event_payload(2, "S1")])
        seen = []
        handler = LiveBatch.__call__

        def counting(self, batch, batch_id):
            seen.append((batch.count(), batch.where("event IS NOT NULL AND arrived > coalesce(row.arrived, "
                                                    "timestamp'1970-01-01')").count()))
            handler(self, batch, batch_id)

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(LiveBatch, "__call__", counting)
            run(spark, log, layout)
            replay.add("shipment_events", [event_payload(3, "S1"), event_payload(1, "S2")])
            run(spark, log, layout)
        read.append([touched for _, touched in seen][-2:])
        assert len(state_of(spark, layout)) == delivered + 2
    assert read[0] == read[1] == [2, 0]


def test_due_index_reads_only_due_hours(spark, lake, make):
    from parcelake.operators import maintained

    layout, batches = lake[1], Batches(spark, lake[1], make)
    for batch_id in range(3):
        batches.add(batch_id, 90 * batch_id, event_payload(1, f"S{batch_id}"))
    before, now = (F.lit(START + timedelta(minutes=m)).cast("timestamp") for m in (240, 241))
    found = maintained.due_since(due_index(spark, layout).before(3), before, now)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "due_hour" in filters and [r["shipment_id"] for r in found.collect()] == ["S0"]
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "due_hour" in scan


def test_a_batch_that_failed_is_run_again_without_duplicates(spark, lake, monkeypatch):
    replay, layout, log = lake
    replay.add("shipment_events", [event_payload(1), event_payload(1, "S2")])
    replay.add("shipment_events", [event_payload(2)])
    broken = {"left": 1}
    write = AlertLog.write

    def failing(self, batch_id, rows, day):
        if batch_id == 1 and broken["left"]:
            broken["left"] -= 1
            raise RuntimeError("store is down")
        write(self, batch_id, rows, day)

    monkeypatch.setattr(AlertLog, "write", failing)
    with pytest.raises(Exception, match="store is down"):
        run(spark, log, layout)
    run(spark, log, layout)
    state = state_of(spark, layout)
    assert state["S1"]["shipment_status"] == "PICKED_AND_PACKED" and set(state) == {"S1", "S2"}
    assert state["S1"]["stage_entered_at"] == (START + timedelta(minutes=1)).replace(tzinfo=None)
    keys = [r["alert_key"] for r in AlertLog(spark, layout.alerts()).history().collect()]
    assert len(keys) == len(set(keys)) == 4


def test_stream_static_enrichment_equals_batch(spark, lake, rows):
    replay, layout, log = lake
    replay.add("shipment_events", [event_payload(n) for n in range(1, 8)])
    tables = [layers.silver_rows(spark, ENTITIES[t], layout)
              for t in ("fulfillment_centers", "delivery_stations", "vehicles")]
    stream = add_flags(enrich(parse_events(log.stream(spark, "shipment_events")), *tables))
    query = (stream.writeStream.format("memory").queryName("enriched")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    batch = add_flags(enrich(parse_events(log.scan(spark, "shipment_events")), *tables))
    assert sorted(map(str, rows(spark.table("enriched")))) == sorted(map(str, rows(batch)))


def test_latest_skips_what_was_logged_before(spark, lake):
    replay, layout, log = lake
    replay.add("shipment_events", [event_payload(1)])
    start_live(spark, log, layout, once=True, clock=clock)     # since="latest"
    assert state_of(spark, layout) == {}
