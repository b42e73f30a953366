"""Counts that the batches of streams report."""

import time

import pytest

from parcelake.layout import Layout
from parcelake.schemas import ENTITIES
from parcelake.sources import fs, raw
from parcelake.sources.log import ReplayLog
from parcelake.streaming.audit import BatchAudit, batch_counts
from parcelake.streaming.ingest import start_ingest
from parcelake.streaming.live import AUDIT, start_live
from parcelake.streaming.state import live_table
from tests.replay import Replay, event_payload
from tests.test_streaming import clock, lake  # noqa: F401


@pytest.fixture
def audit(spark, lake):  # noqa: F811
    listener = BatchAudit(spark, lake[1])
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def totals(spark, layout, name):
    found = [r for r in batch_counts(spark, layout).collect() if r["audit"] == name]
    return len(found), *(sum(r[c] for r in found) for c in ("rows_in", "quarantined", "rows_written"))


def test_counts_of_batches_equal_a_recount(spark, lake, audit):  # noqa: F811
    replay, layout, log = lake
    assert batch_counts(spark, layout).count() == 0
    replay.add("shipment_events", [event_payload(1, f"S{i}") for i in range(5)] + ["broken"])
    replay.add("shipment_events", [event_payload(2, "S1"), event_payload(1, "S2"), "{}"])
    replay.add("shipment_events", [event_payload(3, "S1"), event_payload(1, None)])
    for query in start_ingest(spark, log, layout, ["shipment_events"], trigger={"availableNow": True}):
        query.awaitTermination()
        deadline = time.monotonic() + 30        # reported by the listener, behind the query's end
        while totals(spark, layout, "ingest shipment_events")[0] < 3 and time.monotonic() < deadline:
            time.sleep(0.2)
        audit.finish(query)
    rows = raw.read(spark, layout.raw(ENTITIES["shipment_events"].kind, "shipment_events")).count()
    assert totals(spark, layout, "ingest shipment_events") == (3, rows, 0, rows) == (3, 11, 0, 11)

    query = start_live(spark, log, layout, since="earliest", once=True, clock=clock, audit=audit)
    audit.finish(query)
    changed = live_table(spark, layout).changes().count()
    got = totals(spark, layout, AUDIT)
    assert got == (3, 11, 3, changed) and changed == 7
    for _ in range(2):                          # a batch that is reported again counts once
        audit.finish(query)
        assert totals(spark, layout, AUDIT) == got


def test_a_report_of_a_later_day_replaces_the_first(spark, tmp_path):
    layout = Layout(str(tmp_path))

    class Counts:
        def asDict(self):
            return {"rows_in": 4, "quarantined": 1}

    class Progress:
        id, batchId, timestamp = "q", 7, "2026-07-01T23:59:59.000Z"
        observedMetrics = {"ingest orders": Counts()}

    audit = BatchAudit(spark, layout)
    audit.record(Progress)
    Progress.timestamp = "2026-07-02T00:00:09.000Z"
    audit.record(Progress)
    Progress.batchId = 8
    audit.record(Progress)
    assert totals(spark, layout, "ingest orders") == (2, 8, 2, 6)
    assert batch_counts(spark, layout, "2026-07-03").count() == 0
    assert len(fs.child_names(spark, f"{layout.audit()}/day=2026-07-02")) >= 2
