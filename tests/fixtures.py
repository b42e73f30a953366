"""Literal rows: seed master data and one complete shipment."""

CENTERS = "fulfillment_center_id string, fulfillment_center_name string, city string, " \
          "region string, state string, daily_capacity int"
CENTER_ROWS = [
    ("FC_DELHI", "Delhi Fulfillment Center", "Delhi", "North", "Delhi", 5000),
    ("FC_BENGALURU", "Bengaluru Fulfillment Center", "Bengaluru", "South", "Karnataka", 5000),
]
STATIONS = CENTERS.replace("fulfillment_center", "delivery_station")
STATION_ROWS = [
    ("DS_DELHI_NORTH", "North Delhi Delivery Station", "Delhi", "North", "Delhi", 2500),
    ("DS_BLR_SOUTH", "South Bengaluru Delivery Station", "Bengaluru", "South", "Karnataka", 2500),
]
VEHICLES = "vehicle_id string, vehicle_type string, home_facility_id string, " \
           "home_facility_type string, capacity int, status string"
VEHICLE_ROWS = [
    ("TRUCK_DELHI", "TRUCK", "FC_DELHI", "FULFILLMENT_CENTER", 200, "AVAILABLE"),
    ("BIKE_1", "BIKE", "DS_DELHI_NORTH", "DELIVERY_STATION", 10, "AVAILABLE"),
]

EVENTS = (
    "event_id string, event_timestamp timestamp, shipment_id string, order_id string, "
    "shipment_status string, facility_id string, facility_type string, vehicle_id string, "
    "estimated_delivery_time timestamp, promised_delivery_time timestamp, is_delayed boolean, "
    "delay_minutes int, customer_tier string, delivery_type string, latitude double, "
    "longitude double")

STAGES = [
    # time, stage, facility, facility type, vehicle
    ("08:00:00", "ORDER_ALLOCATED_TO_FC", "FC_DELHI", "FULFILLMENT_CENTER", None),
    ("08:30:00", "PICKED_AND_PACKED", "FC_DELHI", "FULFILLMENT_CENTER", None),
    ("09:00:00", "DISPATCHED_FROM_FC", "FC_DELHI", "FULFILLMENT_CENTER", "TRUCK_DELHI"),
    ("10:00:00", "RECEIVED_AT_DS", "DS_DELHI_NORTH", "DELIVERY_STATION", "TRUCK_DELHI"),
    ("10:20:00", "ASSIGNED_TO_DRIVER", "DS_DELHI_NORTH", "DELIVERY_STATION", "BIKE_1"),
    ("10:45:00", "OUT_FOR_DELIVERY", None, None, "BIKE_1"),
    ("14:45:00", "DELIVERED", None, None, "BIKE_1"),
]
DAY = "2026-07-01"


def event(n: int, shipment: str = "S1", **changes):
    """The n-th (1..7) event of the shipment, SAME_DAY and PRIME, 45 minutes late."""
    time, stage, facility, kind, vehicle = STAGES[n - 1]
    row = dict(
        event_id=f"{shipment}-{n}", event_timestamp=f"{DAY} {time}", shipment_id=shipment,
        order_id=f"O-{shipment}", shipment_status=stage, facility_id=facility,
        facility_type=kind, vehicle_id=vehicle,
        estimated_delivery_time=f"{DAY} 14:45:00", promised_delivery_time=f"{DAY} 14:00:00",
        is_delayed=True, delay_minutes=45, customer_tier="PRIME", delivery_type="SAME_DAY",
        latitude=28.6139, longitude=77.2090)
    row.update(changes)
    return tuple(row.values())


ORDERS = ("order_id string, event_timestamp timestamp, customer_id string, customer_tier string, "
          "delivery_type string, order_value double, shipment_id string")


def order(shipment: str = "S1", **changes):
    row = dict(order_id=f"O-{shipment}", event_timestamp=f"{DAY} 08:00:00", customer_id="C1",
               customer_tier="PRIME", delivery_type="SAME_DAY", order_value=1000.0,
               shipment_id=shipment)
    row.update(changes)
    return tuple(row.values())
