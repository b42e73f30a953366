"""BI refresh: one roll-up of the fact, six served tables. Panels of both dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from parcelake.layout import Layout
from parcelake.operators import bi, panels
from parcelake.operators.scd2 import current
from parcelake.schemas import BI_TABLES
from parcelake.sizing import shuffles_sized_for
from parcelake.sources.serving import to_contract
from parcelake.sources.tables import Table
from parcelake.streaming.state import live_table


def bi_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The six BI tables from the stored roll-up."""
    return bi.bi_tables(
        Table(spark, layout.gold("shipment_rollup")).read(),
        current(Table(spark, layout.gold("dim_fulfillment_center")).read()),
        current(Table(spark, layout.gold("dim_delivery_station")).read()),
        Table(spark, layout.gold("dim_date")).read())


def refresh_panels(spark: SparkSession, layout: Layout, serving, as_of: Column) -> None:
    """The 22 panels with the colours of their bands, each as a table panel_<dashboard>_<name>."""
    shown = {
        "realtime": panels.realtime(live_table(spark, layout).read(), as_of),
        "bi": panels.bi(bi_tables(spark, layout))}
    serving.refresh_all({
        panels.table_name(dashboard, title): panels.banded(title, df)
        for dashboard, tables in shown.items() for title, df in tables.items()})


def refresh_bi(spark: SparkSession, layout: Layout, serving, run_ts: Column) -> None:
    """The six small tables from the roll-up that the gold job keeps beside the fact."""
    with shuffles_sized_for(spark, Table(spark, layout.gold("shipment_rollup")).read()):
        serving.refresh_all({
            name: to_contract(df.withColumn("refreshed_at", run_ts), BI_TABLES[name])
            for name, df in bi_tables(spark, layout).items()})
