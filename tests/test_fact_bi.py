import random

import pytest
from pyspark.sql import functions as F

from parcelake.operators import bi, scd2
from parcelake.operators.calendar import dim_date
from parcelake.operators.fact import (
    FACT_COLUMNS, fact_shipment, latest_state, merge_states, shipment_states)
from parcelake.plans.gold import customers
from parcelake.schemas import BI_TABLES
from parcelake.sources.serving import to_contract
from verification.sample import Sample
from tests.fixtures import (
    CENTER_ROWS, CENTERS, EVENTS, ORDERS, STATION_ROWS, STATIONS, VEHICLE_ROWS, VEHICLES, event,
    order)


@pytest.fixture(scope="module")
def star(spark, make):
    first = lambda dim, df: scd2.first_versions(df, dim, F.lit("2026-06-01"))
    vehicles = make(VEHICLES, *VEHICLE_ROWS)
    fc = first(scd2.DIM_FULFILLMENT_CENTER, make(CENTERS, *CENTER_ROWS))
    ds = first(scd2.DIM_DELIVERY_STATION, make(STATIONS, *STATION_ROWS))
    veh = first(scd2.DIM_VEHICLE, vehicles)

    def build(events, orders, as_of="2026-07-02"):
        orders = make(ORDERS, *orders)
        cust = first(scd2.DIM_CUSTOMER, customers(orders))
        return fact_shipment(shipment_states(make(EVENTS, *events)), orders, vehicles, fc, ds, veh, cust,
                             dim_date(spark), F.lit(as_of))

    build.fc, build.ds = fc, ds
    return build


def test_complete_lifecycle(star, rows):
    fact = star([event(n) for n in range(1, 8)], [order()])
    assert tuple(fact.columns) == FACT_COLUMNS
    (row,) = rows(fact)
    assert (row["lead_time_hours"], row["fc_time_minutes"], row["ds_time_minutes"]) == (
        6.75, 60.0, 45.0)
    assert row["sla_breached"] is True and row["vehicle_type"] == "BIKE"
    assert (row["transportation_cost"], row["sla_penalty_amount"], row["refund_amount"]) == (
        20.0, 90.0, 150.0)
    assert row["date_key"] == 20260701 and row["fc_id"] == "FC_DELHI"
    assert None not in (row["fc_sk"], row["ds_sk"], row["vehicle_sk"], row["customer_sk"])


def test_open_and_odd_shipments(star, rows):
    fact = rows(star(
        [event(1, "open"), event(2, "open"),
         event(7, "nopromise", promised_delivery_time=None),
         event(7, "express", delivery_type="EXPRESS"),
         event(7, "notype", delivery_type=None),
         event(7, "noorder"),
         event(1, "early", event_timestamp="2023-12-31 10:00:00"),
         event(3, "nofc", vehicle_id=None, delay_minutes=None)],
        [order(s) for s in ("open", "nopromise", "express", "notype", "early", "nofc")]),
        "shipment_id")
    assert fact["open"]["sla_breached"] is False and fact["open"]["lead_time_hours"] is None
    assert fact["open"]["sla_penalty_amount"] == 90.0      # accrues before any breach
    assert fact["open"]["transportation_cost"] == 0.0
    assert fact["nopromise"]["sla_breached"] is None and fact["nopromise"]["refund_amount"] == 0.0
    for odd in ("express", "notype"):
        assert fact[odd]["sla_penalty_amount"] == 0.0 and fact[odd]["refund_amount"] == 0.0
    assert fact["noorder"]["refund_amount"] is None and fact["noorder"]["customer_sk"] is None
    assert fact["noorder"]["date_key"] == 20260702         # no receipt: the as-of date
    assert fact["early"]["date_key"] is None
    assert fact["nofc"]["sla_penalty_amount"] == 0.0


def test_one_row_per_shipment_with_several_orders(star, rows):
    (row,) = rows(star([event(1)], [
        order(order_value=1.0), order(order_id="O-2", order_value=2.0,
                                      event_timestamp="2026-07-01 09:00:00")]))
    assert row["order_value"] == 2.0


def test_equal_times_are_settled_by_lifecycle_stage(make, rows):
    same = "2026-07-01 10:00:00"
    df = make(EVENTS, event(5, event_timestamp=same, event_id="a"),
              event(4, event_timestamp=same, event_id="z"))
    assert rows(latest_state(df))[0]["shipment_status"] == "ASSIGNED_TO_DRIVER"


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_parts_merge_to_the_states_of_the_whole(make, rows, seed):
    rng = random.Random(seed)
    events = [event(n, s, event_timestamp=f"2026-07-01 {rng.randrange(8, 12):02d}:00:00",
                    event_id=f"{s}{n}{i}")
              for s in ("a", "b", "c") for n in range(1, 8) for i in range(2)]
    rng.shuffle(events)
    part = lambda e: shipment_states(make(EVENTS, *e))
    merged = merge_states(merge_states(part(events[:20]), part(events[20:])), part(events[10:30]))
    assert sorted(map(str, rows(merged))) == sorted(map(str, rows(part(events))))


def test_events_and_orders_are_shuffled_once_each(spark):
    """On tables of known size: no other shuffle by shipment, no cross join, small sides broadcast."""
    fact = Sample(spark, "/root/testdata/sf0.001").fact
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(shipment_id") == 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Window" not in plan


def test_roll_up_gives_the_same_tables_as_the_fact(spark, star, rows):
    fact = star(
        [event(n, s) for s in ("a", "b", "c") for n in range(1, 8)]
        + [event(1, "d", is_delayed=False, delay_minutes=0), event(2, "d", delivery_type="STANDARD"),
           event(1, "e", facility_id="FC_UNKNOWN"), event(1, "f", event_timestamp="2023-01-01 00:00:00")],
        [order(s, order_value=v) for s, v in zip("abcdef", (10.0, 20.5, 33.33, 1.0, 2.0, 3.0))])
    calendar = dim_date(spark)
    direct = {
        "bi_warehouse_performance": bi.warehouse_performance(fact, star.fc),
        "bi_delivery_station_perf": bi.delivery_station_performance(fact, star.ds),
        "bi_logistics_kpis": bi.logistics_kpis(fact),
        "bi_monthly_trends": bi.monthly_trends(fact, calendar),
        "bi_cost_penalty": bi.cost_penalty(fact),
        "bi_lead_time": bi.lead_time(fact),
    }
    rolled = bi.bi_tables(bi.rollup(fact), star.fc, star.ds, calendar)
    assert set(direct) == set(rolled) == set(BI_TABLES)
    for name in direct:
        assert sorted(map(str, rows(rolled[name]))) == sorted(map(str, rows(direct[name]))), name
    (kpis,) = rows(direct["bi_logistics_kpis"])
    assert kpis["on_time_count"] <= kpis["delivered_count"] <= kpis["total_shipments"] == 6
    assert kpis["delivered_count"] == 3 and kpis["sla_breach_pct"] == 100.0
    months = rows(direct["bi_monthly_trends"])
    assert [m["month_name"] for m in months] == [None, "July"]
    warehouses = rows(direct["bi_warehouse_performance"], "fc_id")
    assert set(warehouses) == {"FC_DELHI"} and warehouses["FC_DELHI"]["avg_fc_time_min"] == 60.0


def test_empty_fact_gives_zero_percentages(spark, star, rows):
    fact = star([event(1)], [order()]).where("shipment_id = 'none'")
    (kpis,) = rows(bi.logistics_kpis(fact))
    assert kpis["on_time_pct"] == kpis["sla_breach_pct"] == 0.0
    assert kpis["total_shipments"] == 0 and kpis["avg_delay_min"] is None


def test_contracts_narrow_counts_and_reject_missing_columns(star, rows):
    kpis = bi.logistics_kpis(star([event(1)], [order()]))
    served = to_contract(kpis.withColumn("refreshed_at", F.current_timestamp()),
                         BI_TABLES["bi_logistics_kpis"])
    assert [(f.name, f.dataType) for f in served.schema] == [
        (f.name, f.dataType) for f in BI_TABLES["bi_logistics_kpis"]]
    with pytest.raises(ValueError, match="refreshed_at"):
        to_contract(kpis, BI_TABLES["bi_logistics_kpis"])


def test_calendar_span(spark, rows):
    df = dim_date(spark)
    assert df.count() == 2557 and df.select("date_key").distinct().count() == 2557
    days = rows(df.where("date_key IN (20240101, 20301231, 20260704)"), "date_key")
    assert days[20260704]["is_weekend"] and days[20260704]["day_name"] == "Saturday"
    assert not days[20240101]["is_weekend"] and days[20301231]["quarter"] == 4
