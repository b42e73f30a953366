import pytest
from pyspark.sql import functions as F

from parcelake.functions import band
from parcelake.operators import alerts, live, panels
from parcelake.operators.enrich import add_flags, enrich
from parcelake.schemas import BI_TABLES, SHIPMENT_LIVE
from tests.fixtures import (
    CENTER_ROWS, CENTERS, DAY, EVENTS, STATION_ROWS, STATIONS, VEHICLE_ROWS, VEHICLES, event)


@pytest.fixture(scope="module")
def enriched(make):
    def build(*events):
        return add_flags(enrich(
            make(EVENTS, *events), make(CENTERS, *CENTER_ROWS), make(STATIONS, *STATION_ROWS),
            make(VEHICLES, *VEHICLE_ROWS)))
    return build


@pytest.fixture(scope="module")
def live_rows(make):
    def build(*events):
        return live.to_live_rows(
            make(EVENTS, *events), make(CENTERS, *CENTER_ROWS), make(STATIONS, *STATION_ROWS))
    return build


@pytest.fixture(scope="module")
def table(spark, live_rows):
    """Live table after applying batches of events in turn, each with its own clock."""
    def build(*batches, now=True):
        state = spark.createDataFrame([], SHIPMENT_LIVE)
        for hour, batch in batches:
            clock = F.lit(f"2026-07-02 {hour:02d}:00:00").cast("timestamp") if now else None
            state = live.after_changes(
                state, live.changed_rows(live_rows(*batch), state, clock))
        return state
    return build


def test_enrichment_is_by_facility_type(enriched, rows):
    out = rows(enriched(event(1), event(4), event(6), event(1, "x", facility_id="FC_NO"),
                        event(1, "y", facility_type="DELIVERY_STATION")), "event_id")
    assert out["S1-1"]["fc_name"] == "Delhi Fulfillment Center" and out["S1-1"]["ds_name"] is None
    assert out["S1-4"]["ds_region"] == "North" and out["S1-4"]["fc_region"] is None
    assert out["S1-4"]["vehicle_type"] == "TRUCK" and out["S1-6"]["vehicle_type"] == "BIKE"
    assert all(out[e]["fc_name"] is None for e in ("S1-6", "x-1", "y-1"))


def test_flags_are_three_valued(enriched, rows):
    out = rows(enriched(
        event(6, "risk"), event(7, "done"), event(6, "nulleta", estimated_delivery_time=None),
        event(7, "doneeta", estimated_delivery_time=None, customer_tier=None),
        event(6, "intime", estimated_delivery_time=f"{DAY} 14:00:00", customer_tier="STANDARD"),
    ), "shipment_id")
    assert [out[s]["is_sla_at_risk"] for s in ("risk", "done", "nulleta", "doneeta", "intime")] == [
        True, False, None, False, False]
    assert [out[s]["is_priority"] for s in ("risk", "doneeta", "intime")] == [True, None, False]


def test_upsert_inserts_replaces_and_keeps(table, rows):
    out = rows(table((1, [event(1, "a"), event(1, "b")]), (2, [event(2, "a")])), "shipment_id")
    assert set(out) == {"a", "b"}
    assert out["a"]["shipment_status"] == "PICKED_AND_PACKED"
    assert str(out["a"]["stage_entered_at"]) == "2026-07-02 02:00:00"
    assert str(out["b"]["last_updated"]) == "2026-07-02 01:00:00"


def test_late_older_event_changes_nothing(table, rows):
    (row,) = rows(table((1, [event(4)]), (2, [event(2)])))
    assert row["shipment_status"] == "RECEIVED_AT_DS" and str(row["last_updated"]).endswith("01:00:00")


@pytest.mark.parametrize("before, after", [
    ("PICKED_AND_PACKED", "PICKED_AND_PACKED"), (None, "PICKED_AND_PACKED"),
    ("PICKED_AND_PACKED", None)])
def test_stage_clock_is_kept_unless_the_status_changes(table, rows, before, after):
    (row,) = rows(table(
        (1, [event(1, shipment_status=before)]), (2, [event(2, shipment_status=after)])))
    assert row["shipment_status"] == after
    assert str(row["stage_entered_at"]).endswith("01:00:00")
    assert str(row["last_updated"]).endswith("02:00:00")


def test_changed_rows_need_only_the_stored_columns(table, live_rows, rows):
    stored = table((1, [event(1, "a"), event(5, "b")])).select(*live.STORED_COLUMNS)
    incoming = live_rows(event(2, "a"), event(2, "b"), event(1, "c"))
    out = rows(live.changed_rows(incoming, stored, None), "shipment_id")
    assert set(out) == {"a", "c"} and len(out["a"]) == len(SHIPMENT_LIVE.fields)


def hits(df):
    return sorted(r["alert_key"] for r in df.collect())


def test_delay_threshold_is_strict_and_by_type(enriched):
    events = enriched(*[
        event(1, name, delivery_type=kind, delay_minutes=minutes, is_delayed=flag)
        for name, kind, minutes, flag in [
            ("sd30", "SAME_DAY", 30, True), ("sd31", "SAME_DAY", 31, True),
            ("st120", "STANDARD", 120, True), ("st121", "STANDARD", 121, True),
            ("null31", None, 31, True), ("ex31", "EXPRESS", 31, True), ("ex30", "EXPRESS", 30, True),
            ("off", "SAME_DAY", 90, False), ("none", "SAME_DAY", None, True)]])
    assert hits(alerts.delay(events)) == ["ex31:DELAY", "sd31:DELAY", "st121:DELAY"]


def test_prime_sla_fires_once_per_shipment(enriched):
    events = enriched(event(1), event(2), event(1, "std", customer_tier="STANDARD"),
                      event(7, "done"))
    assert hits(alerts.prime_sla(events)) == ["S1:PRIME_SLA"]


def test_eta_change_against_the_stored_eta(enriched, table):
    stored = table((1, [event(1, s) for s in ("plus30", "plus31", "noeta")]))
    batch = enriched(
        event(2, "plus30", estimated_delivery_time=f"{DAY} 15:15:00"),
        event(2, "plus31", estimated_delivery_time=f"{DAY} 15:16:00"),
        event(3, "plus31", estimated_delivery_time=f"{DAY} 14:45:00"),   # any event of the batch
        event(2, "noeta", estimated_delivery_time=None),
        event(2, "new", estimated_delivery_time="2026-07-09 00:00:00"))
    assert hits(alerts.eta_change(batch, stored)) == ["plus31:ETA_CHANGE"]


def test_backlog_limits(table):
    batch = [event(1, f"f{i}", facility_id="FC_10") for i in range(10)]
    batch += [event(2, f"g{i}", facility_id="FC_11") for i in range(11)]
    batch += [event(4, f"h{i}", facility_id="DS_8") for i in range(8)]
    batch += [event(5, f"i{i}", facility_id="DS_9") for i in range(9)]
    state = table((1, batch))
    assert hits(alerts.fc_backlog(state)) == ["FC_11:FC_BACKLOG"]
    assert hits(alerts.ds_backlog(state)) == ["DS_9:DS_BACKLOG"]


def test_stale_by_facility_type(table):
    state = table((0, [event(1, "fc"), event(3, "left"), event(4, "ds"), event(6, "road")]))
    at = lambda time: F.lit(f"2026-07-02 {time}").cast("timestamp")
    assert hits(alerts.stale(state, at("01:00:00"))) == []
    assert hits(alerts.stale(state, at("01:00:01"))) == ["ds:STALE"]
    assert hits(alerts.stale(state, at("04:00:01"))) == ["ds:STALE", "fc:STALE"]


def test_once_and_cooldown(make):
    found = make("alert_key string, alert_type string, subject_id string, detail string",
                 *[(f"{s}:{t}", t, s, "") for s, t in [
                     ("s1", "DELAY"), ("s2", "DELAY"), ("f1", "FC_BACKLOG"), ("f2", "FC_BACKLOG"),
                     ("s3", "STALE")]])
    log = make("alert_key string, alert_type string, fired_at timestamp",
               ("s1:DELAY", "DELAY", "2020-01-01 00:00:00"),
               ("f1:FC_BACKLOG", "FC_BACKLOG", "2026-07-02 09:00:00"),     # 3600 s ago
               ("f2:FC_BACKLOG", "FC_BACKLOG", "2026-07-02 08:59:59"))     # 3601 s ago
    now = F.lit("2026-07-02 10:00:00").cast("timestamp")
    assert hits(alerts.unsent(found, log, now)) == ["f2:FC_BACKLOG", "s2:DELAY", "s3:STALE"]


def test_panels_on_an_empty_table(spark, rows):
    state = spark.createDataFrame([], SHIPMENT_LIVE)
    assert rows(live.active_shipments(state)) == [{"value": 0}]
    assert rows(live.average_delay(state)) == [{"value": 0.0}]
    assert rows(live.live_feed(state)) == []


def test_realtime_dashboard(table, rows):
    state = table((0, [event(1, "fc"), event(4, "ds"), event(7, "done")]))
    shown = panels.realtime(state, F.lit("2026-07-02 06:00:00").cast("timestamp"))
    assert len(shown) == 11
    assert rows(shown["Active Shipments"]) == [{"value": 2}]
    (stuck,) = rows(shown["Stale at Fulfillment Center"])
    assert stuck["FC"] == "Delhi Fulfillment Center" and stuck["Hours Stuck"] == 6.0
    assert rows(shown["DS Backlog by Facility"]) == [
        {"Facility": "North Delhi Delivery Station", "Backlog": 1}]
    assert shown["Live Shipment Feed"].columns[-1] == "Last Updated"


def test_bi_dashboard(make, rows):
    tables = {name: make(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in contract))
              for name, contract in BI_TABLES.items()}
    shown = panels.bi(tables)
    assert len(shown) == 11 and shown["SLA Breach %"].columns == ["value"]
    assert shown["Warehouse Performance"].columns == [
        "FC Name", "Region", "Volume", "Avg Dispatch (min)", "Delayed", "Delayed %"]
    assert "total_refunds_band" in panels.with_bands(tables["bi_cost_penalty"]).columns


def test_bands_at_their_bounds(make, rows):
    df = make("v double", (9.9,), (10.0,), (24.9,), (25.0,), (None,))
    out = [r["c"] for r in rows(df.select(band("v", "delayed_pct").alias("c")))]
    assert out == ["green", "yellow", "yellow", "red", None]
    df = make("v double", (84.9,), (85.0,), (95.0,))
    assert [r["c"] for r in rows(df.select(band("v", "on_time_pct").alias("c")))] == [
        "red", "yellow", "green"]
    df = make("v double", (7.9,), (8.0,))
    assert [r["c"] for r in rows(df.select(band("v", "fc_hours_stuck").alias("c")))] == [
        "yellow", "red"]
