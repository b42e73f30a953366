"""BI summaries of the fact table.

Every summary is made of counts, sums, minima and maxima, so all six can be rolled up from one
pre-aggregation of the fact (`rollup`). A single summary pre-aggregates by its own keys; the
refresh job pre-aggregates once by all keys and reads the fact once. Dimension names are joined
to the few pre-aggregated rows, never to fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelake import domain
from parcelake.functions import percent, round_to
from parcelake.sizing import fits_broadcast

ALL_KEYS = ("fc_id", "fc_sk", "ds_id", "ds_sk", "delivery_type", "date_key")

_COUNTS = {
    "shipments": "shipment_id IS NOT NULL",
    "delivered": f"shipment_status = '{domain.DELIVERED}'",
    "on_time": f"shipment_status = '{domain.DELIVERED}' AND NOT sla_breached",
    "breached": "sla_breached",
    "delayed": "is_delayed",
}
_AVERAGED = {
    "delay": "delay_minutes", "fc_time": "fc_time_minutes", "ds_time": "ds_time_minutes",
    "lead": "lead_time_hours", "value": "order_value",
}
_SUMMED = {
    "cost": "transportation_cost", "penalty": "sla_penalty_amount", "refund": "refund_amount",
}


def rollup(fact: DataFrame, keys: Sequence[str] = ALL_KEYS) -> DataFrame:
    """Additive measures of the fact per combination of keys."""
    measures: list[Column] = [
        F.count_if(F.expr(rule)).alias(name) for name, rule in _COUNTS.items()]
    for name, column in _AVERAGED.items():
        measures += [F.sum(F.col(column).cast("double")).alias(f"{name}_sum"),
                     F.count(column).alias(f"{name}_n")]
    measures += [F.sum(column).alias(f"{name}_sum") for name, column in _SUMMED.items()]
    measures += [F.min("lead_time_hours").alias("lead_min"),
                 F.max("lead_time_hours").alias("lead_max")]
    return fact.groupBy(*keys).agg(*measures)


def _total(name: str, alias: str) -> Column:
    # A sum over no rows at all is null, a count is 0.
    return F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(alias)


def _mean(name: str, digits: int, alias: str) -> Column:
    mean = F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n").cast("double"))
    return round_to(mean, digits).alias(alias)


def _named(rolled: DataFrame, dim: DataFrame, sk: str, name: str, alias: str) -> DataFrame:
    names = dim.select(F.col("surrogate_key").alias(sk), F.col(name).alias(alias), "region")
    names = F.broadcast(names) if fits_broadcast(names) else names
    return rolled.where(F.col(sk).isNotNull()).join(names, sk, "left")


def _facility(rolled: DataFrame, facility: str, name: str, time: str, alias: str) -> DataFrame:
    return (
        rolled.groupBy(facility, name, "region")
        .agg(_total("shipments", "shipment_volume"), _mean(time, 1, alias),
             _total("delayed", "delayed_count"))
        .withColumn("delayed_pct", percent(F.col("delayed_count"), F.col("shipment_volume")))
    )


def warehouse_from(rolled: DataFrame, dim_fc: DataFrame) -> DataFrame:
    named = _named(rolled, dim_fc, "fc_sk", "fulfillment_center_name", "fc_name")
    return _facility(named, "fc_id", "fc_name", "fc_time", "avg_fc_time_min")


def station_from(rolled: DataFrame, dim_ds: DataFrame) -> DataFrame:
    named = _named(rolled, dim_ds, "ds_sk", "delivery_station_name", "ds_name")
    return _facility(named, "ds_id", "ds_name", "ds_time", "avg_ds_time_min")


def _delivery_outcome(rolled_groups) -> DataFrame:
    return rolled_groups.agg(
        _total("shipments", "shipments"), _total("delivered", "delivered_count"),
        _total("on_time", "on_time_count"), _mean("delay", 1, "avg_delay_min"),
        _total("breached", "sla_breach_count"),
    ).withColumn("on_time_pct", percent(F.col("on_time_count"), F.col("delivered_count")))


def kpis_from(rolled: DataFrame) -> DataFrame:
    return (
        _delivery_outcome(rolled.groupBy())
        .withColumnRenamed("shipments", "total_shipments")
        .withColumn("sla_breach_pct",
                    percent(F.col("sla_breach_count"), F.col("delivered_count")))
        .select("total_shipments", "delivered_count", "on_time_count", "on_time_pct",
                "avg_delay_min", "sla_breach_count", "sla_breach_pct")
    )


def monthly_from(rolled: DataFrame, calendar: DataFrame) -> DataFrame:
    # The calendar is a fixed 2557 rows. Shipments off the calendar form a null month.
    months = F.broadcast(calendar.select("date_key", "year", "month", "month_name"))
    return (
        _delivery_outcome(
            rolled.join(months, "date_key", "left").groupBy("year", "month", "month_name"))
        .withColumnRenamed("shipments", "shipment_volume")
        .select("year", "month", "month_name", "shipment_volume", "delivered_count",
                "on_time_count", "on_time_pct", "avg_delay_min")
        .orderBy("year", "month")
    )


def cost_from(rolled: DataFrame) -> DataFrame:
    def money(name: str, alias: str) -> Column:
        return round_to(F.sum(name), 2).alias(alias)

    return rolled.groupBy("delivery_type").agg(
        _total("shipments", "total_shipments"),
        money("cost_sum", "total_transport_cost"), money("penalty_sum", "total_sla_penalty"),
        money("refund_sum", "total_refunds"), _mean("value", 2, "avg_order_value"))


def lead_time_from(rolled: DataFrame) -> DataFrame:
    return (
        rolled.where("lead_n > 0").groupBy("delivery_type")
        .agg(_total("lead_n", "shipment_count"), _mean("lead", 2, "avg_lead_time_hrs"),
             round_to(F.min("lead_min"), 2).alias("min_lead_time_hrs"),
             round_to(F.max("lead_max"), 2).alias("max_lead_time_hrs"))
    )


# --- one summary straight from the fact ----------------------------------------------

def warehouse_performance(fact: DataFrame, dim_fc: DataFrame) -> DataFrame:
    """Per fulfillment center with a known version: volume, mean dispatch time, delayed share."""
    return warehouse_from(rollup(fact, ["fc_id", "fc_sk"]), dim_fc)


def delivery_station_performance(fact: DataFrame, dim_ds: DataFrame) -> DataFrame:
    """The same per delivery station."""
    return station_from(rollup(fact, ["ds_id", "ds_sk"]), dim_ds)


def logistics_kpis(fact: DataFrame) -> DataFrame:
    """One row. Mean delay is over all shipments, the two shares over delivered ones."""
    return kpis_from(rollup(fact, []))


def monthly_trends(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    return monthly_from(rollup(fact, ["date_key"]), calendar)


def cost_penalty(fact: DataFrame) -> DataFrame:
    return cost_from(rollup(fact, ["delivery_type"]))


def lead_time(fact: DataFrame) -> DataFrame:
    """Per delivery type, over shipments with a complete journey."""
    return lead_time_from(rollup(fact, ["delivery_type"]))


def bi_tables(rolled: DataFrame, dim_fc: DataFrame, dim_ds: DataFrame,
              calendar: DataFrame) -> dict[str, DataFrame]:
    """All six served tables from one roll-up."""
    return {
        "bi_warehouse_performance": warehouse_from(rolled, dim_fc),
        "bi_delivery_station_perf": station_from(rolled, dim_ds),
        "bi_logistics_kpis": kpis_from(rolled),
        "bi_monthly_trends": monthly_from(rolled, calendar),
        "bi_cost_penalty": cost_from(rolled),
        "bi_lead_time": lead_time_from(rolled),
    }
