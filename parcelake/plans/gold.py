"""Gold jobs: dimensions and the shipment fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from parcelake import domain
from parcelake.layout import Layout
from parcelake.operators import scd2
from parcelake.operators.bi import ALL_KEYS, rollup
from parcelake.operators.calendar import dim_date
from parcelake.operators.fact import (
    UNRECEIVED, fact_shipment, merge_states, receipt_part, shipment_states)
from parcelake.operators.keyed import latest_per_key
from parcelake.plans.layers import bronze_rows, row_count, silver_rows
from parcelake.schemas import ENTITIES
from parcelake.sizing import fits_broadcast, shuffles_sized_for
from parcelake.sources import fs
from parcelake.sources.tables import Table

#: dimension -> columns of the fact with its natural key and its surrogate key
FACT_DIMENSIONS = {
    scd2.DIM_FULFILLMENT_CENTER: ("fc_id", "fc_sk"), scd2.DIM_DELIVERY_STATION: ("ds_id", "ds_sk"),
    scd2.DIM_VEHICLE: ("vehicle_id", "vehicle_sk"), scd2.DIM_CUSTOMER: ("customer_id", "customer_sk"),
}


def silver_of(spark: SparkSession, layout: Layout, topic: str,
              since: str | None = None) -> DataFrame:
    return silver_rows(spark, ENTITIES[topic], layout, since)


def customers(orders: DataFrame) -> DataFrame:
    """Each customer with the tier of the newest order."""
    known = orders.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "event_timestamp", "order_id", "customer_tier")
    return latest_per_key(known, ["customer_id"], ["event_timestamp", "order_id"]).select(
        "customer_id", "customer_tier")


def build_dimension(spark: SparkSession, layout: Layout, dim: scd2.Dimension,
                    incoming: DataFrame, as_of: Column) -> dict:
    """First run: every row becomes a version. Later runs: merge. A run dated before the newest
    version would make versions overlap, so it is refused before anything is written."""
    table = Table(spark, layout.gold(dim.name))
    if table.exists():
        newest, day = table.read().agg(F.max("effective_from"), F.first(as_of.cast("date"))).first()
        if newest is not None and day < newest:
            raise ValueError(f"{dim.name} has versions from {newest}; as_of {day} is earlier")
    rows = (
        scd2.merge(table.read(), incoming, dim, as_of) if table.exists()
        else scd2.first_versions(incoming, dim, as_of)
    )
    seen = Observation(f"gold {dim.name}")
    rows = rows.observe(
        seen, row_count(), F.count_if("is_current").alias("current"),
        F.count_if(F.col("effective_from") == as_of.cast("date")).alias("opened"))
    with shuffles_sized_for(spark, incoming):
        table.overwrite(rows)
    return seen.get


def build_dimensions(spark: SparkSession, layout: Layout, as_of: Column) -> dict[str, dict]:
    incoming = {
        scd2.DIM_FULFILLMENT_CENTER: silver_of(spark, layout, domain.TOPIC_FULFILLMENT_CENTERS),
        scd2.DIM_DELIVERY_STATION: silver_of(spark, layout, domain.TOPIC_DELIVERY_STATIONS),
        scd2.DIM_VEHICLE: silver_of(spark, layout, domain.TOPIC_VEHICLES),
        scd2.DIM_CUSTOMER: customers(silver_of(spark, layout, domain.TOPIC_ORDERS)),
    }
    return {dim.name: build_dimension(spark, layout, dim, rows, as_of)
            for dim, rows in incoming.items()}


def build_calendar(spark: SparkSession, layout: Layout) -> None:
    Table(spark, layout.gold("dim_date")).overwrite(dim_date(spark))


def _by_part(rows: DataFrame) -> DataFrame:
    """Dealt out for a write by partition: few files each, large partitions over several tasks."""
    return rows.hint("rebalance", "part")


def _parts(*found: DataFrame) -> list[int]:
    """Distinct partitions; at most the days of the calendar and two."""
    every = reduce(DataFrame.unionByName, [df.select("part") for df in found])
    return sorted(row["part"] for row in every.distinct().collect())


def _only(rows: DataFrame, parts: list[int] | None) -> DataFrame:
    return rows if parts is None else rows.where(F.col("part").isin(parts))


def _holding(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of `table` whose `key` is among `keys`; of the table only what is used is read."""
    keys = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return table.join(F.broadcast(keys) if fits_broadcast(keys) else keys, key, "left_semi")


def build_states(spark: SparkSession, layout: Layout, since: str | None = None) -> DataFrame | None:
    """Stage times and newest state per shipment, a table partitioned by the day of receipt.

    With `since`, only events ingested from that date on are read. Their states are merged into
    the partitions that hold these shipments, or will (an earlier receipt moves a shipment); the
    others are not read beyond the shipment id and not written. Merging a day again changes
    nothing. Returns the states of the new events; None if all were built anew.
    """
    table = Table(spark, layout.gold("shipment_states"))
    partly = since is not None and table.exists()
    events = silver_of(spark, layout, domain.TOPIC_SHIPMENT_EVENTS, since if partly else None)
    states = shipment_states(events)
    if not partly:
        with shuffles_sized_for(spark, events):
            table.overwrite(_by_part(states.withColumn("part", receipt_part())), ["part"])
        return None
    arrived = Table(spark, layout.gold("shipment_states_new"))
    with shuffles_sized_for(spark, events):
        arrived.overwrite(states)
    new, stored = arrived.read(), table.read()
    received = new.select("shipment_id", F.col("fc_received_at").alias("_new"))
    known = stored.select("shipment_id", "part", "fc_received_at").join(
        F.broadcast(received) if fits_broadcast(received) else received, "shipment_id")
    earliest = receipt_part(F.least("fc_received_at", "_new"))
    with shuffles_sized_for(spark, stored, new):
        parts = _parts(known.select(F.explode(F.array("part", earliest)).alias("part")),
                       new.select(receipt_part().alias("part")))
        merged = merge_states(_only(stored, parts).drop("part"), new)
        table.replace(_by_part(merged.withColumn("part", receipt_part())), "part", parts)
    return new


def _changed_shipments(spark: SparkSession, layout: Layout, since: str) -> DataFrame:
    """Shipments whose newest order may be another since `since`: all that any copy of an order
    which came since then has ever named."""
    copies = bronze_rows(spark, ENTITIES[domain.TOPIC_ORDERS], layout).select(
        "order_id", "shipment_id", "ingested_at")
    came = copies.where(F.col("ingested_at") >= F.lit(since).cast("date"))
    return _holding(copies, came, "order_id").select("shipment_id")


def touched_parts(spark: SparkSession, layout: Layout, states: DataFrame, fact: DataFrame,
                  new: DataFrame, since: str, last_as_of: object) -> list[int]:
    """Partitions of the fact in which something may differ from a full rebuild.

    These are the partitions, by the states as they are now and by the fact as it was, of the
    shipments with new events or with changed orders, those with keys that got a new dimension
    version since the last run (the fact points to current versions), and the one of shipments
    without receipt, which are dated by the run. A run that failed midway is repeated with the
    same `since` and finds the same again.
    """
    shipments = new.select("shipment_id").unionByName(_changed_shipments(spark, layout, since))
    found = [_holding(table.select("shipment_id", "part"), shipments, "shipment_id")
             for table in (states, fact)]
    for dim, (key, sk) in FACT_DIMENSIONS.items():
        # The last run saw a part of the versions of its day.
        opened = scd2.current(Table(spark, layout.gold(dim.name)).read()).where(
            F.col("effective_from") >= F.lit(last_as_of)).select(
            F.col(dim.key).alias(key), F.col("surrogate_key").alias("_opened"))
        if not opened.isEmpty():
            opened = F.broadcast(opened) if fits_broadcast(opened) else opened
            found.append(fact.select(key, sk, "part").join(opened, key).where(
                ~F.col(sk).eqNullSafe(F.col("_opened"))))
    return sorted({UNRECEIVED, *_parts(*found)})


def build_fact(spark: SparkSession, layout: Layout, as_of: Column, run_ts: Column,
               since: str | None = None) -> dict:
    """Write the fact and its roll-up from shipment states, orders and dimensions.

    Both are partitioned as the states are. With `since`, the partitions in which something may
    have changed are made anew from the same partitions of the states, the others stay as they are
    (also their `gold_processed_at`); a partition of the roll-up is the roll-up of a partition of the
    fact, so nothing is added to or taken from sums. The result equals a full rebuild.
    """
    def gold(name: str) -> Table:
        return Table(spark, layout.gold(name))

    fact, rolled, runs = gold("fact_shipment"), gold("shipment_rollup"), gold("fact_runs")
    if since is None or not runs.exists():
        since = None            # states, fact and roll-up were never finished together
        fs.remove(spark, runs.path)
    new = build_states(spark, layout, since)
    states = gold("shipment_states").read()
    orders = silver_of(spark, layout, domain.TOPIC_ORDERS)
    parts = None
    if new is not None:
        last = runs.read().first()["as_of"]
        with shuffles_sized_for(spark, states, orders):
            parts = touched_parts(spark, layout, states, fact.read(), new, since, last)
        states = _only(states, parts)
        orders = _holding(orders, states, "shipment_id")
    rows = fact_shipment(
        states, orders,
        silver_of(spark, layout, domain.TOPIC_VEHICLES),
        gold("dim_fulfillment_center").read(), gold("dim_delivery_station").read(),
        gold("dim_vehicle").read(), gold("dim_customer").read(), gold("dim_date").read(), as_of)
    seen = Observation("gold fact_shipment")
    rows = rows.withColumn("gold_processed_at", run_ts).withColumn("part", receipt_part())
    rows = _by_part(rows.observe(seen, row_count()))
    with shuffles_sized_for(spark, states, orders):
        _write(fact, rows, parts)
        _write(rolled, _by_part(rollup(_only(fact.read(), parts), [*ALL_KEYS, "part"])), parts)
    runs.overwrite(spark.range(1).select(as_of.cast("date").alias("as_of")))
    return seen.get | ({} if parts is None else {"partitions": len(parts)})


def _write(table: Table, rows: DataFrame, parts: list[int] | None) -> None:
    if parts is None:
        table.overwrite(rows, ["part"])
    else:
        table.replace(rows, "part", parts)
