"""The fact and its roll-up by touched partitions equal a full rebuild."""

import os
import random

import pytest
from pyspark.sql import functions as F

from parcelake.layout import Layout
from parcelake.operators.bi import ALL_KEYS, rollup
from parcelake.plans import gold
from parcelake.plans.layers import LOG_POSITION
from parcelake.schemas import ENTITIES
from parcelake.sources.tables import Table
from tests.fixtures import (
    CENTER_ROWS, CENTERS, EVENTS, ORDERS, STATION_ROWS, STATIONS, VEHICLE_ROWS, VEHICLES, event, order)

def run_ts():
    return F.lit("2026-07-09 01:00:00").cast("timestamp")


def shaped(df, schema, **values):
    """`df` in the columns of `schema`; what it lacks is null or taken from `values`."""
    return df.select(*[
        (F.lit(values[f.name]) if f.name in values else F.col(f.name) if f.name in df.columns
         else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


class Lake:
    """Silver written directly, gold by the jobs."""

    def __init__(self, spark, make, root):
        self.spark, self.make, self.layout = spark, make, Layout(str(root))
        self.orders, self.log = {}, 0
        gold.build_calendar(spark, self.layout)

    def master(self, centers=CENTER_ROWS):
        for topic, columns, rows in (("fulfillment_centers", CENTERS, centers),
                                     ("delivery_stations", STATIONS, STATION_ROWS),
                                     ("vehicles", VEHICLES, VEHICLE_ROWS)):
            entity = ENTITIES[topic]
            Table(self.spark, self.layout.silver(entity.kind, topic)).overwrite(
                shaped(self.make(columns, *rows), entity.silver, quarantined=False))

    def day(self, day, events=(), orders=()):
        entity = ENTITIES["shipment_events"]
        if events:
            rows = shaped(self.make(EVENTS, *events), entity.silver, quarantined=False)
            rows.withColumn("ingested_at", F.lit(day).cast("date")).write.mode("append").partitionBy(
                "ingested_at").parquet(self.layout.silver(entity.kind, entity.name))
        entity = ENTITIES["orders"]
        if orders:
            copies = self.make(ORDERS, *orders)
            shaped(copies, entity.bronze, quarantined=False, ingested_at=day).write.mode(
                "append").partitionBy("ingested_at").parquet(self.layout.bronze(entity.kind, entity.name))
            self.orders |= {row[0]: row for row in orders}
        rows = shaped(self.make(ORDERS, *self.orders.values()), entity.silver, quarantined=False)
        for column in LOG_POSITION:
            rows = rows.withColumn(column, F.lit(0).cast("long"))
        Table(self.spark, self.layout.silver(entity.kind, entity.name)).overwrite(rows)

    def build(self, as_of, since=None):
        gold.build_dimensions(self.spark, self.layout, F.lit(as_of))
        return gold.build_fact(self.spark, self.layout, F.lit(as_of), run_ts(), since)

    def rebuilt(self, as_of):
        return gold.build_fact(self.spark, self.layout, F.lit(as_of), run_ts())

    def table(self, name):
        return Table(self.spark, self.layout.gold(name)).read()

    def content(self):
        return [sorted(map(str, self.table(name).select(sorted(self.table(name).columns)).collect()))
                for name in ("shipment_states", "fact_shipment", "shipment_rollup")]

    def files(self, name):
        table = Table(self.spark, self.layout.gold(name))
        root = f"{table.path}/v={table.versions()[-1]}"
        return {part: sorted(f for f in os.listdir(f"{root}/{part}") if f.endswith(".parquet"))
                for part in os.listdir(root) if part.startswith("part=")}


@pytest.fixture
def lake(spark, make, tmp_path):
    lake = Lake(spark, make, tmp_path / "lake")
    lake.master()
    return lake


def received(day, shipment, **changes):
    return event(1, shipment, event_timestamp=f"{day} 08:00:00", **changes)


def test_only_touched_partitions_are_written(lake):
    lake.day("2026-07-01", [received("2026-07-01", "a"), received("2026-07-02", "b"),
                            received("2026-07-03", "c"), event(2, "open"),
                            received("2021-07-03", "old")],
             [order(s) for s in "abc"])
    assert lake.build("2026-07-04") == {"rows": 5}
    before = {name: lake.files(name) for name in ("shipment_states", "fact_shipment", "shipment_rollup")}
    assert set(before["fact_shipment"]) == {
        "part=20260701", "part=20260702", "part=20260703", "part=0", "part=-1"}

    # b gets an event; c turns out to have been received a day earlier, which empties its partition.
    lake.day("2026-07-05", [event(3, "b", event_timestamp="2026-07-05 09:00:00"),
                            received("2026-07-02", "c", event_id="c-late")])
    assert lake.build("2026-07-05", since="2026-07-05") == {"rows": 3, "partitions": 3}
    for name, files in before.items():
        now = lake.files(name)
        assert set(now) == set(files) - {"part=20260703"}, name
        assert now["part=20260701"] == files["part=20260701"], name
        assert now["part=20260702"] != files["part=20260702"], name
    partly = lake.content()
    open_row = lake.table("fact_shipment").where("shipment_id = 'open'").first()
    assert open_row["date_key"] == 20260705

    lake.build("2026-07-05", since="2026-07-05")        # repeated
    assert lake.content() == partly
    lake.rebuilt("2026-07-05")
    assert lake.content() == partly
    # a day without anything new; the plan reads no other partition of the states
    lake.day("2026-07-06")
    assert lake.build("2026-07-06", since="2026-07-06") == {"rows": 1, "partitions": 1}


def test_changed_orders_and_dimensions_reach_old_partitions(lake):
    lake.day("2026-07-01", [received("2026-07-01", "a"), received("2026-07-02", "b"),
                            received("2026-07-03", "c", facility_id="FC_BENGALURU")],
             [order("a", customer_id="A"), order("b", customer_id="B")])
    lake.build("2026-07-04")
    # the order of b was a mistake: it belongs to c
    lake.day("2026-07-05", (), [order("b", customer_id="B", shipment_id="c")])
    assert lake.build("2026-07-05", since="2026-07-05")["partitions"] == 3
    partly = lake.content()
    values = {r["shipment_id"]: r["order_value"] for r in lake.table("fact_shipment").collect()}
    assert values == {"a": 1000.0, "b": None, "c": 1000.0}
    lake.rebuilt("2026-07-05")
    assert lake.content() == partly
    # a center changes: its shipments point to the new version, whenever they were
    lake.master([CENTER_ROWS[0], (*CENTER_ROWS[1][:-1], 9000)])
    lake.day("2026-07-06")
    assert lake.build("2026-07-06", since="2026-07-06")["partitions"] == 2
    partly = lake.content()
    lake.rebuilt("2026-07-06")
    assert lake.content() == partly


@pytest.mark.parametrize("seed", [1, 2])
def test_random_days_in_any_order_equal_a_rebuild(lake, seed):
    rng = random.Random(seed)
    days = [f"2026-07-0{n}" for n in range(1, 6)]
    batches = []
    for batch in range(4):
        events = [event(rng.randrange(1, 8), f"s{rng.randrange(8)}", event_id=f"{batch}-{i}",
                        event_timestamp=f"{rng.choice(days)} {rng.randrange(24):02d}:00:00")
                  for i in range(8)]
        orders = [order(f"s{rng.randrange(8)}", order_id=f"o{rng.randrange(5)}",
                        customer_id=f"c{rng.randrange(3)}", order_value=float(rng.randrange(100)),
                        customer_tier=rng.choice(["PRIME", "STANDARD"])) for _ in range(2)]
        batches.append((events, list({row[0]: row for row in orders}.values())))
    lake.day("2026-07-10", *batches[0])
    lake.build("2026-07-10")
    ingest = ["2026-07-12", "2026-07-11", "2026-07-13"]     # one day comes in late
    for n, (day, batch) in enumerate(zip(ingest, batches[1:])):
        lake.day(day, *batch)
        lake.build(f"2026-07-1{n + 1}", since=day)
    partly = lake.content()
    lake.rebuilt("2026-07-13")
    assert lake.content() == partly
    whole = sorted(map(str, rollup(lake.table("fact_shipment"), [*ALL_KEYS, "part"]).select(
        sorted(lake.table("shipment_rollup").columns)).collect()))
    assert whole == partly[2]


def test_a_run_that_failed_after_the_states_is_made_good(lake, monkeypatch):
    lake.day("2026-07-01", [received("2026-07-02", "a"), received("2026-07-03", "b")], [order("a")])
    lake.build("2026-07-04")
    lake.day("2026-07-05", [received("2026-07-01", "a", event_id="late")])
    with monkeypatch.context() as broken:
        broken.setattr(gold, "fact_shipment", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.build("2026-07-05", since="2026-07-05")
    lake.build("2026-07-05", since="2026-07-05")
    assert sorted(r["part"] for r in lake.table("fact_shipment").collect()) == [20260701, 20260703]
