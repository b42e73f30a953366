"""What the two dashboards show: panels with their columns, captions and order.

The captions are fixed values: dashboards and exports refer to them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.functions import band
from parcelake.operators import live as live_table


def _captioned(df: DataFrame, captions: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(column).alias(caption) for column, caption in captions.items()])


def kpi_stats(kpis: DataFrame) -> DataFrame:
    """The four single-value panels, in one row."""
    return kpis.select("total_shipments", "on_time_pct", "avg_delay_min", "sla_breach_pct")


def warehouse_table(performance: DataFrame) -> DataFrame:
    return _captioned(performance.orderBy(F.desc("shipment_volume")), {
        "fc_name": "FC Name", "region": "Region", "shipment_volume": "Volume",
        "avg_fc_time_min": "Avg Dispatch (min)", "delayed_count": "Delayed",
        "delayed_pct": "Delayed %"})


def station_table(performance: DataFrame) -> DataFrame:
    return _captioned(performance.orderBy(F.desc("shipment_volume")), {
        "ds_name": "DS Name", "region": "Region", "shipment_volume": "Volume",
        "avg_ds_time_min": "Avg Process (min)", "delayed_count": "Delayed",
        "delayed_pct": "Delayed %"})


def monthly_series(trends: DataFrame) -> DataFrame:
    """The three monthly panels (volume, on-time share, mean delay) side by side."""
    return _captioned(trends.orderBy("year", "month"), {
        "month_name": "Month", "shipment_volume": "Shipments", "on_time_pct": "On-Time %",
        "avg_delay_min": "Avg Delay (min)"})


def cost_table(costs: DataFrame) -> DataFrame:
    return _captioned(costs.orderBy(F.desc("total_shipments")), {
        "delivery_type": "Delivery Type", "total_shipments": "Shipments",
        "total_transport_cost": "Transport Cost ($)", "total_sla_penalty": "SLA Penalty ($)",
        "total_refunds": "Refunds ($)", "avg_order_value": "Avg Order ($)"})


def lead_time_table(lead_times: DataFrame) -> DataFrame:
    return _captioned(lead_times, {
        "delivery_type": "Delivery Type", "shipment_count": "Shipments",
        "avg_lead_time_hrs": "Avg (hrs)", "min_lead_time_hrs": "Min (hrs)",
        "max_lead_time_hrs": "Max (hrs)"})


def bi(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eleven panels of the BI dashboard, from the served tables by name."""
    def value(column: str) -> DataFrame:
        return tables["bi_logistics_kpis"].select(F.col(column).alias("value"))

    months = monthly_series(tables["bi_monthly_trends"])
    return {
        "Total Shipments": value("total_shipments"),
        "On-Time Delivery %": value("on_time_pct"),
        "Avg Delay (min)": value("avg_delay_min"),
        "SLA Breach %": value("sla_breach_pct"),
        "Warehouse Performance": warehouse_table(tables["bi_warehouse_performance"]),
        "Delivery Station Performance": station_table(tables["bi_delivery_station_perf"]),
        "Monthly Shipment Volume": months.select("Month", "Shipments"),
        "Monthly On-Time Delivery %": months.select("Month", "On-Time %"),
        "Monthly Avg Delay (min)": months.select("Month", "Avg Delay (min)"),
        "Cost & Penalty Summary": cost_table(tables["bi_cost_penalty"]),
        "Delivery Lead Time": lead_time_table(tables["bi_lead_time"]),
    }


def realtime(live: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The eleven panels of the realtime dashboard, from the live table."""
    def stale(df: DataFrame, place: str) -> DataFrame:
        return _captioned(df, {
            "shipment_id": "Shipment", "shipment_status": "Status", "facility": place,
            "stage_entered_at": "Stuck Since", "hours_stuck": "Hours Stuck"})

    backlog = {"facility": "Facility", "backlog": "Backlog"}
    return {
        "Active Shipments": live_table.active_shipments(live),
        "Delayed Shipments": live_table.delayed_shipments(live),
        "SLA At Risk": live_table.sla_at_risk(live),
        "Avg Delay (min)": live_table.average_delay(live),
        "Shipments by Status": _captioned(
            live_table.by_status(live), {"shipment_status": "Status", "shipments": "Count"}),
        "Shipments by Customer Tier": _captioned(
            live_table.by_tier(live), {"customer_tier": "Tier", "shipments": "Count"}),
        "FC Backlog by Facility": _captioned(live_table.fc_backlog(live), backlog),
        "DS Backlog by Facility": _captioned(live_table.ds_backlog(live), backlog),
        "Stale at Fulfillment Center": stale(live_table.stale_fc(live, as_of), "FC"),
        "Stale at Delivery Station": stale(live_table.stale_ds(live, as_of), "DS"),
        "Live Shipment Feed": _captioned(live_table.live_feed(live), {
            "shipment_id": "Shipment", "shipment_status": "Status", "customer_tier": "Tier",
            "delivery_type": "Delivery Type", "is_delayed": "Delayed",
            "delay_minutes": "Delay (min)", "is_sla_at_risk": "SLA Risk",
            "facility": "Facility", "last_updated": "Last Updated"}),
    }


#: panel title -> its captions that have colours, and whose bounds they take
BANDED = {
    "Delayed Shipments": {"value": "delayed_shipments"},
    "SLA At Risk": {"value": "sla_at_risk"},
    "Avg Delay (min)": {"value": "avg_delay_min"},
    "FC Backlog by Facility": {"Backlog": "fc_backlog"},
    "DS Backlog by Facility": {"Backlog": "ds_backlog"},
    "Stale at Fulfillment Center": {"Hours Stuck": "fc_hours_stuck"},
    "Stale at Delivery Station": {"Hours Stuck": "ds_hours_stuck"},
    "On-Time Delivery %": {"value": "on_time_pct"},
    "SLA Breach %": {"value": "sla_breach_pct"},
    "Warehouse Performance": {"Delayed %": "delayed_pct", "Avg Dispatch (min)": "avg_fc_time_min"},
    "Delivery Station Performance": {"Delayed %": "delayed_pct", "Avg Process (min)": "avg_ds_time_min"},
    "Cost & Penalty Summary": {"SLA Penalty ($)": "total_sla_penalty", "Refunds ($)": "total_refunds"},
    "Delivery Lead Time": {"Avg (hrs)": "avg_lead_time_hrs"},
}


def banded(title: str, df: DataFrame) -> DataFrame:
    """A panel with a column "<caption> Band" after the others for each caption with colours."""
    return df.withColumns({
        f"{caption} Band": band(F.col(f"`{caption}`"), bounds)
        for caption, bounds in BANDED.get(title, {}).items()})


def table_name(dashboard: str, title: str) -> str:
    """Name of the table a panel is served as."""
    return f"panel_{dashboard}_" + "_".join(re.findall("[a-z0-9]+", title.lower().replace("%", "pct")))


def with_bands(df: DataFrame) -> DataFrame:
    """Add `<column>_band`, the colour of its panel, for every column that has bands."""
    return df.withColumns({
        f"{c}_band": band(c, c) for c in df.columns if c in domain.PANEL_BANDS})
