"""Writes log rows as replay files."""

import json
import os
from pathlib import Path

from tests.fixtures import CENTER_ROWS, DAY, STATION_ROWS, VEHICLE_ROWS, event, order

FACILITY = ("_id", "_name", "city", "region", "state", "daily_capacity")
EVENT_FIELDS = (
    "event_id event_timestamp shipment_id order_id shipment_status facility_id facility_type "
    "vehicle_id estimated_delivery_time promised_delivery_time is_delayed delay_minutes "
    "customer_tier delivery_type latitude longitude").split()
ORDER_FIELDS = ("order_id event_timestamp customer_id customer_tier delivery_type order_value "
                "shipment_id").split()


def iso(value):
    if isinstance(value, str) and value.startswith("20") and " " in value:
        return value.replace(" ", "T") + "Z"
    return value


def event_payload(n, shipment="S1", **changes):
    row = dict(zip(EVENT_FIELDS, map(iso, event(n, shipment, **changes))))
    return {**row, "event_type": row["shipment_status"]}


def order_payload(shipment="S1", **changes):
    row = dict(zip(ORDER_FIELDS, map(iso, order(shipment, **changes))))
    return {**row, "promised_delivery_time": f"{DAY}T14:00:00Z", "order_status": "ALLOCATED_TO_FC"}


def facility_payloads(entity, rows, updated_at=f"{DAY}T00:00:00Z"):
    names = [f"{entity}{f}" if f.startswith("_") else f for f in FACILITY]
    return [{**dict(zip(names, r)), "updated_at": updated_at} for r in rows]


def vehicle_payloads():
    names = "vehicle_id vehicle_type home_facility_id home_facility_type capacity status".split()
    return [{**dict(zip(names, r)), "updated_at": f"{DAY}T00:00:00Z"} for r in VEHICLE_ROWS]


class Replay:
    """An append-only log on disk; each `add` is one file."""

    def __init__(self, path):
        self.path, self.offsets, self.files = Path(path), {}, 0
        for topic in ("fulfillment_centers", "delivery_stations", "vehicles", "orders",
                      "shipment_events"):
            (self.path / topic).mkdir(parents=True)

    def add(self, topic, payloads):
        lines = []
        for payload in payloads:
            offset = self.offsets[topic] = self.offsets.get(topic, -1) + 1
            value = payload if isinstance(payload, str) else json.dumps(payload)
            lines.append(json.dumps({
                "key": None, "value": value, "topic": topic, "partition": 0, "offset": offset,
                "timestamp": f"{DAY}T08:00:00.000Z"}))
        self.files += 1
        target = self.path / topic / f"part-{self.files:04d}.json"
        hidden = target.with_name("." + target.name)
        hidden.write_text("\n".join(lines) + "\n")
        written = 1_700_000_000 + self.files           # files are taken in order of their time
        os.utime(hidden, (written, written))
        hidden.rename(target)

    def add_master(self, **changes):
        centers = [dict(c, **changes) for c in facility_payloads("fulfillment_center", CENTER_ROWS)]
        self.add("fulfillment_centers", centers)
        self.add("delivery_stations", facility_payloads("delivery_station", STATION_ROWS))
        self.add("vehicles", vehicle_payloads())
