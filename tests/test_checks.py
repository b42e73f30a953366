import random

import pytest

from parcelake.operators import checks
from tests.fixtures import EVENTS, STAGES, VEHICLE_ROWS, VEHICLES, event


def test_lifecycle(make, rows):
    def at(n, shipment, time):
        return event(n, shipment, event_timestamp=f"2026-07-01 {time}")

    out = rows(checks.lifecycle_report(make(
        EVENTS, *[event(n, "full") for n in range(1, 8)], *[event(n, "part") for n in range(1, 4)],
        event(1, "skip"), event(3, "skip"), event(1, "twice"), event(1, "twice"),
        at(1, "back", "10:00:00"), at(2, "back", "09:00:00"),
        at(1, "tie", "10:00:00"), at(2, "tie", "10:00:00"),
        event(2, "headless"), event(1, "odd", shipment_status="LOST"),
        event(1, "null", shipment_status=None))), "shipment_id")
    assert [s for s, r in out.items() if r["conforms"]] == sorted(
        ["full", "part", "tie"], key=list(out).index)
    assert out["skip"]["skipped_stages"] == 1 and out["headless"]["skipped_stages"] == 1
    assert out["twice"]["repeated_stages"] == 1 and out["back"]["out_of_order"]
    assert out["odd"]["unknown_stages"] == 1 and out["null"]["unknown_stages"] == 1


def test_stage_rules(make, rows):
    df = make(EVENTS, *[event(n, "ok") for n in range(1, 8)],
              event(1, "extra", vehicle_id="BIKE_1"), event(4, "bike", vehicle_id="BIKE_1"),
              event(6, "fac", facility_type="DELIVERY_STATION"), event(3, "gone", vehicle_id="X"))
    out = rows(checks.stage_rule_violations(df, make(VEHICLES, *VEHICLE_ROWS)), "shipment_id")
    assert {s: (r["wrong_facility"], r["wrong_vehicle"]) for s, r in out.items()} == {
        "extra": (False, True), "bike": (False, True), "fac": (True, False), "gone": (False, True)}


def test_promised_time_and_arrival(make, rows):
    df = make("t timestamp, k string, d int", ("2026-07-01 08:00:00", "SAME_DAY", 45),
              ("2026-07-01 08:00:00", "STANDARD", None), ("2026-07-01 08:00:00", "EXPRESS", 1))
    out = rows(df.select(checks.promised_time("t", "k").alias("p"), "d").withColumn(
        "e", checks.expected_arrival("p", "d")))
    assert [str(r["p"]) for r in out] == ["2026-07-01 14:00:00", "2026-07-03 08:00:00", "None"]
    assert str(out[0]["e"]) == "2026-07-01 14:45:00" and out[1]["e"] == out[1]["p"]


def test_network(make, rows):
    pairs = "fulfillment_center_id string, delivery_station_id string"
    orders = make("order_id string, " + pairs, ("ok", "F1", "D1"), ("cross", "F1", "D2"),
                  ("null", None, "D1"))
    network = make(pairs, ("F1", "D1"), ("F1", "D1"), ("F2", "D2"))
    assert [r["order_id"] for r in rows(checks.network_violations(orders, network))] == [
        "cross", "null"]


@pytest.mark.parametrize("seed", range(4))
def test_vehicle_overlap_equals_brute_force(make, rows, seed):
    rng = random.Random(seed)
    minute = lambda m: f"2026-07-{1 + m // 1440:02d} {m % 1440 // 60:02d}:{m % 60:02d}:00"
    legs = []
    for i in range(80):
        start = rng.randrange(4 * 1440)
        end = None if rng.random() < 0.02 else start + rng.randrange(0, 240)
        legs.append((rng.choice(["hot", "hot", "v1", "v2"]), f"s{i}", start, end))
    expected = set()
    for v, s, start, end in legs:
        for w, t, start2, end2 in legs:
            if v == w and s != t and (start2 == start or (
                    start2 < start and (end2 is None or end2 > start))):
                expected.add(s)
    df = make("vehicle_id string, shipment_id string, starts_at timestamp, ends_at timestamp",
              *[(v, s, minute(a), None if b is None else minute(b)) for v, s, a, b in legs])
    assert {r["shipment_id"] for r in rows(checks.conflicting_shipments(df))} == expected


def test_assignments_cover_the_last_mile(make, rows):
    df = make(EVENTS, *[event(n) for n in range(1, 8)], event(5, "open"))
    out = rows(checks.assignments(df), "shipment_id")
    assert str(out["S1"]["starts_at"]) == "2026-07-01 10:20:00"
    assert str(out["S1"]["ends_at"]) == "2026-07-01 14:45:00" and out["open"]["ends_at"] is None
    assert STAGES[4][1] == "ASSIGNED_TO_DRIVER"


def test_geofence_uses_the_station_when_there_is_no_facility(make, rows):
    places = make("facility_id string, latitude double, longitude double",
                  ("FC_DELHI", 28.6139, 77.2090), ("DS_DELHI_NORTH", 28.7041, 77.1025))
    orders = make("shipment_id string, delivery_station_id string", ("S1", "DS_DELHI_NORTH"))
    df = make(EVENTS, event(1), event(2, latitude=28.6240), event(3, longitude=77.1980),
              event(6, latitude=28.7041, longitude=77.1025), event(7),
              event(1, "other", facility_id="UNKNOWN"))
    out = rows(checks.off_site_events(df, places, orders), "event_id")
    assert {key: r["reason"] for key, r in out.items()} == {
        "S1-2": "off site", "S1-3": "off site", "S1-7": "off site", "other-1": "unknown place"}
    assert out["S1-7"]["place_id"] == "DS_DELHI_NORTH"
