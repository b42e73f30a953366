"""Outbound-logistics analytics on Spark: lake layers, star schema, live table, alerts, BI summaries."""
