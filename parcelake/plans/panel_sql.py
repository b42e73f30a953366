"""The panels of both dashboards as SQL texts, for tools that speak SQL to Spark.

The texts read the views `shipment_live` and `bi_...` and call two SQL functions; `register` makes
them known to a session. `:as_of` is a parameter of the texts that need a clock. Each text gives what
the panel of the same name in `operators.panels` gives, with the colours of its bands.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from parcelake import domain
from parcelake.layout import Layout
from parcelake.operators.panels import BANDED
from parcelake.plans.serve import bi_tables
from parcelake.streaming.state import live_table

REALTIME, BI = "realtime", "bi"


def _listed(codes) -> str:
    return ", ".join(f"'{code}'" for code in codes)


def _band_function() -> str:
    """Colour of a panel value; a bound belongs to the band above it, null has no colour."""
    panels = []
    for panel, (first, second, colours) in domain.PANEL_BANDS.items():
        between = "" if second is None else f" WHEN value < {second} THEN '{colours[1]}'"
        panels.append(
            f"WHEN '{panel}' THEN CASE WHEN value < {first} THEN '{colours[0]}'{between} "
            f"WHEN value IS NOT NULL THEN '{colours[-1]}' END")
    return ("CREATE OR REPLACE TEMPORARY FUNCTION band(value DOUBLE, panel STRING) RETURNS STRING "
            f"RETURN CASE panel {' '.join(panels)} END")


FUNCTIONS = (
    _band_function(),
    """CREATE OR REPLACE TEMPORARY FUNCTION hours_between(earlier TIMESTAMP, later TIMESTAMP)
       RETURNS DOUBLE RETURN CAST(round(CAST(
         (unix_micros(later) - unix_micros(earlier)) / 1000000D / 3600D AS DECIMAL(38, 10)), 1) AS DOUBLE)""",
)

_ACTIVE = f"FROM shipment_live WHERE shipment_status <> '{domain.DELIVERED}'"


def _backlog(stages, name: str) -> str:
    return f"""
        SELECT coalesce({name}, facility_id) AS `Facility`, count(*) AS `Backlog` FROM shipment_live
        WHERE shipment_status IN ({_listed(stages)})
        GROUP BY facility_id, {name} ORDER BY `Backlog` DESC"""


def _stale(kind: str, name: str, caption: str, hours: int, left) -> str:
    return f"""
        SELECT shipment_id AS `Shipment`, shipment_status AS `Status`,
          coalesce({name}, facility_id) AS `{caption}`, stage_entered_at AS `Stuck Since`,
          hours_between(stage_entered_at, CAST(:as_of AS TIMESTAMP)) AS `Hours Stuck`
        FROM shipment_live
        WHERE facility_type = '{kind}' AND shipment_status NOT IN ({_listed(left)})
          AND stage_entered_at < CAST(:as_of AS TIMESTAMP) - INTERVAL {hours} HOURS
        ORDER BY `Stuck Since`"""


def _facility(table: str, name: str, caption: str, time: str, time_caption: str) -> str:
    return f"""
        SELECT {name} AS `{caption}`, region AS `Region`, shipment_volume AS `Volume`,
          {time} AS `{time_caption}`, delayed_count AS `Delayed`, delayed_pct AS `Delayed %`
        FROM {table} ORDER BY shipment_volume DESC"""


def _kpi(column: str) -> str:
    return f"SELECT {column} AS value FROM bi_logistics_kpis"


def _by_month(column: str, caption: str) -> str:
    return f"SELECT month_name AS `Month`, {column} AS `{caption}` FROM bi_monthly_trends ORDER BY year, month"


_PANELS = {
    (REALTIME, "Active Shipments"): f"SELECT count(*) AS value {_ACTIVE}",
    (REALTIME, "Delayed Shipments"): f"SELECT count(*) AS value {_ACTIVE} AND is_delayed",
    (REALTIME, "SLA At Risk"): f"SELECT count(*) AS value {_ACTIVE} AND is_sla_at_risk",
    (REALTIME, "Avg Delay (min)"): f"""
        SELECT coalesce(CAST(round(CAST(avg(delay_minutes) AS DECIMAL(38, 10)), 0) AS DOUBLE), 0D) AS value
        {_ACTIVE} AND is_delayed""",
    (REALTIME, "Shipments by Status"): """
        SELECT shipment_status AS `Status`, count(*) AS `Count` FROM shipment_live
        GROUP BY shipment_status ORDER BY `Count` DESC""",
    (REALTIME, "Shipments by Customer Tier"): f"""
        SELECT customer_tier AS `Tier`, count(*) AS `Count` {_ACTIVE}
        GROUP BY customer_tier ORDER BY `Count` DESC""",
    (REALTIME, "FC Backlog by Facility"): _backlog(domain.FC_BACKLOG_STAGES, "fc_name"),
    (REALTIME, "DS Backlog by Facility"): _backlog(domain.DS_BACKLOG_STAGES, "ds_name"),
    (REALTIME, "Stale at Fulfillment Center"): _stale(
        domain.FC, "fc_name", "FC", domain.FC_STALE_HOURS, domain.FC_LEFT_STAGES),
    (REALTIME, "Stale at Delivery Station"): _stale(
        domain.DS, "ds_name", "DS", domain.DS_STALE_HOURS, domain.DS_LEFT_STAGES),
    (REALTIME, "Live Shipment Feed"): """
        SELECT shipment_id AS `Shipment`, shipment_status AS `Status`, customer_tier AS `Tier`,
          delivery_type AS `Delivery Type`, is_delayed AS `Delayed`, delay_minutes AS `Delay (min)`,
          is_sla_at_risk AS `SLA Risk`, coalesce(fc_name, ds_name, facility_id) AS `Facility`,
          last_updated AS `Last Updated`
        FROM shipment_live ORDER BY last_updated DESC, shipment_id LIMIT 25""",
    (BI, "Total Shipments"): _kpi("total_shipments"),
    (BI, "On-Time Delivery %"): _kpi("on_time_pct"),
    (BI, "Avg Delay (min)"): _kpi("avg_delay_min"),
    (BI, "SLA Breach %"): _kpi("sla_breach_pct"),
    (BI, "Warehouse Performance"): _facility(
        "bi_warehouse_performance", "fc_name", "FC Name", "avg_fc_time_min", "Avg Dispatch (min)"),
    (BI, "Delivery Station Performance"): _facility(
        "bi_delivery_station_perf", "ds_name", "DS Name", "avg_ds_time_min", "Avg Process (min)"),
    (BI, "Monthly Shipment Volume"): _by_month("shipment_volume", "Shipments"),
    (BI, "Monthly On-Time Delivery %"): _by_month("on_time_pct", "On-Time %"),
    (BI, "Monthly Avg Delay (min)"): _by_month("avg_delay_min", "Avg Delay (min)"),
    (BI, "Cost & Penalty Summary"): """
        SELECT delivery_type AS `Delivery Type`, total_shipments AS `Shipments`,
          total_transport_cost AS `Transport Cost ($)`, total_sla_penalty AS `SLA Penalty ($)`,
          total_refunds AS `Refunds ($)`, avg_order_value AS `Avg Order ($)`
        FROM bi_cost_penalty ORDER BY total_shipments DESC""",
    (BI, "Delivery Lead Time"): """
        SELECT delivery_type AS `Delivery Type`, shipment_count AS `Shipments`,
          avg_lead_time_hrs AS `Avg (hrs)`, min_lead_time_hrs AS `Min (hrs)`,
          max_lead_time_hrs AS `Max (hrs)` FROM bi_lead_time""",
}


def _coloured(title: str, text: str) -> str:
    bands = BANDED.get(title, {})
    if not bands:
        return text
    added = ", ".join(
        f"band(CAST(`{caption}` AS DOUBLE), '{panel}') AS `{caption} Band`"
        for caption, panel in bands.items())
    return f"SELECT *, {added} FROM ({text})"


#: (dashboard, panel title) -> SQL text
TEXTS = {key: _coloured(key[1], text) for key, text in _PANELS.items()}


def register(spark: SparkSession, live: DataFrame, tables: Mapping[str, DataFrame]) -> None:
    """Views and functions of the texts, for this session. Views of before are replaced."""
    live.createOrReplaceTempView("shipment_live")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for function in FUNCTIONS:
        spark.sql(function)


def register_lake(spark: SparkSession, layout: Layout) -> None:
    """The same over the tables of a lake as they are now."""
    register(spark, live_table(spark, layout).read(), bi_tables(spark, layout))


def panel(spark: SparkSession, dashboard: str, title: str,
          as_of: datetime | str | None = None) -> DataFrame:
    """One panel through `spark.sql`; `as_of` is the clock of the panels of stuck shipments."""
    text = TEXTS[dashboard, title]
    if ":as_of" not in text:
        return spark.sql(text)
    if as_of is None:
        raise ValueError(f"panel {title} needs as_of")
    return spark.sql(text, args={"as_of": as_of})
