"""Names and numbers of the logistics domain.

Everything in this file is a fixed value: results only agree with the platform
this engine serves if these agree, so they are stated literally and kept together.
"""

# --- topics of the message log -------------------------------------------------
TOPIC_FULFILLMENT_CENTERS = "fulfillment_centers"
TOPIC_DELIVERY_STATIONS = "delivery_stations"
TOPIC_VEHICLES = "vehicles"
TOPIC_ORDERS = "orders"
TOPIC_SHIPMENT_EVENTS = "shipment_events"

MASTER_TOPICS = (TOPIC_FULFILLMENT_CENTERS, TOPIC_DELIVERY_STATIONS, TOPIC_VEHICLES)
EVENT_TOPICS = (TOPIC_ORDERS, TOPIC_SHIPMENT_EVENTS)

# --- shipment lifecycle, in order -----------------------------------------------
ALLOCATED = "ORDER_ALLOCATED_TO_FC"
PACKED = "PICKED_AND_PACKED"
DISPATCHED = "DISPATCHED_FROM_FC"
AT_STATION = "RECEIVED_AT_DS"
ASSIGNED = "ASSIGNED_TO_DRIVER"
ON_ROUTE = "OUT_FOR_DELIVERY"
DELIVERED = "DELIVERED"

LIFECYCLE = (ALLOCATED, PACKED, DISPATCHED, AT_STATION, ASSIGNED, ON_ROUTE, DELIVERED)

FC = "FULFILLMENT_CENTER"
DS = "DELIVERY_STATION"

STAGE_FACILITY_TYPE = {ALLOCATED: FC, PACKED: FC, DISPATCHED: FC, AT_STATION: DS, ASSIGNED: DS}
STAGE_VEHICLE_TYPE = {
    DISPATCHED: "TRUCK", AT_STATION: "TRUCK",
    ASSIGNED: "BIKE", ON_ROUTE: "BIKE", DELIVERED: "BIKE",
}
LAST_MILE_STAGES = (ASSIGNED, ON_ROUTE, DELIVERED)

FC_BACKLOG_STAGES = (ALLOCATED, PACKED)
DS_BACKLOG_STAGES = (AT_STATION, ASSIGNED)
FC_LEFT_STAGES = (DISPATCHED, DELIVERED)
DS_LEFT_STAGES = (ON_ROUTE, DELIVERED)

# --- customers and promises -----------------------------------------------------
PRIME = "PRIME"
STANDARD = "STANDARD"
SAME_DAY = "SAME_DAY"
SLA_HOURS = {SAME_DAY: 6, STANDARD: 48}

# --- vehicles ---------------------------------------------------------------------
VEHICLE_STATUSES = ("AVAILABLE", "IN_USE", "MAINTENANCE")

# --- money ------------------------------------------------------------------------
TRANSPORT_COST = {"TRUCK": 100.0, "VAN": 50.0, "BIKE": 20.0}
PENALTY_PER_MINUTE = {SAME_DAY: 2.0, STANDARD: 0.5}
REFUND_SHARE = {SAME_DAY: 0.15, STANDARD: 0.05}

# --- alert thresholds (all strict ">") ----------------------------------------------
DELAY_ALERT_MINUTES = {SAME_DAY: 30, STANDARD: 120}
ETA_CHANGE_ALERT_MINUTES = {SAME_DAY: 30, STANDARD: 120}
OTHER_TYPE_ALERT_MINUTES = 30
FC_BACKLOG_LIMIT = 10
DS_BACKLOG_LIMIT = 8
FC_STALE_HOURS = 4
DS_STALE_HOURS = 1
ALERT_COOLDOWN_SECONDS = 3600

# --- positions --------------------------------------------------------------------
GPS_TOLERANCE_DEGREES = 0.01

# --- calendar ---------------------------------------------------------------------
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2030-12-31"
OPEN_END = "9999-12-31"

# --- panel bands: (first bound, second bound, colours from low to high) --------------
RISING = ("green", "yellow", "red")
FALLING = ("red", "yellow", "green")
PANEL_BANDS = {
    "delayed_shipments": (10, 30, RISING),
    "sla_at_risk": (5, 15, RISING),
    "avg_delay_min": (30, 60, RISING),
    "fc_backlog": (7, 10, RISING),
    "ds_backlog": (5, 8, RISING),
    "on_time_pct": (85, 95, FALLING),
    "sla_breach_pct": (5, 15, RISING),
    "delayed_pct": (10, 25, RISING),
    "avg_fc_time_min": (60, 120, RISING),
    "avg_ds_time_min": (30, 60, RISING),
    "total_sla_penalty": (1000, 5000, RISING),
    "total_refunds": (500, 2000, RISING),
    "avg_lead_time_hrs": (24, 48, RISING),
    # the two stuck-shipment tables have one bound only: yellow below it, red from it on
    "fc_hours_stuck": (8, None, ("yellow", "red")),
    "ds_hours_stuck": (3, None, ("yellow", "red")),
}
