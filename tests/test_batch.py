"""Raw to BI on replayed log files."""

import pytest
from pyspark.sql import functions as F

from parcelake.layout import Layout
from parcelake.plans import gold, layers, quality
from parcelake.plans.batch import run_batch
from parcelake.schemas import BI_TABLES, ENTITIES
from parcelake.sources.log import ReplayLog
from parcelake.sources.serving import ParquetServing
from parcelake.sources.tables import Table
from tests.replay import Replay, event_payload, order_payload


def at(text):
    return F.lit(text).cast("timestamp")


def ingest_all(spark, log, layout, day):
    return {name: layers.ingest_batch(spark, log, e, layout, at(f"{day} 00:00:00"))
            for name, e in ENTITIES.items()}


def test_batch_from_log_to_bi(spark, rows, tmp_path):
    replay, layout = Replay(tmp_path / "log"), Layout(str(tmp_path / "lake"))
    log = ReplayLog(str(tmp_path / "log"))
    serving = ParquetServing(spark, str(tmp_path / "serving"))
    replay.add_master()
    replay.add("orders", [order_payload(), order_payload(order_value=0.0), "not json",
                          order_payload("S2", order_id=None),
                          order_payload("S3", event_timestamp="garbage")])
    replay.add("shipment_events", [event_payload(n) for n in range(1, 8)]
               + ['{"is_delayed":"x"}', "", event_payload(1, "S2")])
    seen = ingest_all(spark, log, layout, "2026-07-01")
    assert seen["shipment_events"] == {"rows": 10}

    audit = run_batch(spark, layout, serving, F.lit("2026-07-02"), at("2026-07-02 01:00:00"))
    assert audit["bronze orders"] == {"rows": 5, "quarantined": 1}
    assert audit["silver orders"] == {"rows": 2, "quarantined": 1}
    assert audit["bronze shipment_events"] == {"rows": 10, "quarantined": 2}
    assert audit["gold dimensions"]["dim_fulfillment_center"] == {
        "rows": 2, "current": 2, "opened": 2}
    assert audit["gold fact_shipment"] == {"rows": 2}

    bad = layers.quarantined(layers.bronze_rows(spark, ENTITIES["orders"], layout))
    assert [r["json_payload"] for r in rows(bad)] == ["not json"]
    fact = rows(Table(spark, layout.gold("fact_shipment")).read(), "shipment_id")
    assert fact["S1"]["refund_amount"] == 150.0 and fact["S2"]["order_value"] is None
    assert str(fact["S1"]["gold_processed_at"]) == "2026-07-02 01:00:00"
    for name, contract in BI_TABLES.items():
        served = serving.read(name)
        assert served.columns == contract.fieldNames() and served.count() >= 1, name
    (kpis,) = rows(serving.read("bi_logistics_kpis"))
    assert (kpis["total_shipments"], kpis["delivered_count"], kpis["sla_breach_pct"]) == (2, 1, 100.0)

    network = spark.createDataFrame(
        [("FC_DELHI", "DS_DELHI_NORTH")], "fulfillment_center_id string, delivery_station_id string")
    quality.run_checks(spark, layout, network)
    report = rows(Table(spark, layout.quality("lifecycle")).read(), "shipment_id")
    assert report["S1"]["conforms"] and report["S2"]["events"] == 1
    assert rows(Table(spark, layout.quality("vehicle_conflicts")).read()) == []
    assert [r["order_id"] for r in rows(Table(spark, layout.quality("network")).read())] == ["O-S1"]

    # The whole log again (a repeated ingest), then the same day again: nothing changes.
    ingest_all(spark, log, layout, "2026-07-02")
    again = run_batch(spark, layout, serving, F.lit("2026-07-02"), at("2026-07-02 02:00:00"))
    assert again["bronze orders"]["rows"] == 10 and again["silver orders"]["rows"] == 2
    dim = Table(spark, layout.gold("dim_fulfillment_center"))
    assert dim.read().count() == 2

    # A changed center on a later day gets a second version; the fact points to the new one.
    replay.add_master(daily_capacity=6000, updated_at="2026-07-05T00:00:00Z")
    ingest_all(spark, log, layout, "2026-07-05")
    run_batch(spark, layout, serving, F.lit("2026-07-05"), at("2026-07-05 01:00:00"))
    versions = rows(dim.read().where("fulfillment_center_id = 'FC_DELHI'"))
    assert sorted((v["daily_capacity"], v["is_current"]) for v in versions) == [
        (5000, False), (6000, True)]
    fact = rows(Table(spark, layout.gold("fact_shipment")).read(), "shipment_id")
    current = [v["surrogate_key"] for v in versions if v["is_current"]]
    assert [fact["S1"]["fc_sk"]] == current
    assert rows(serving.read("bi_warehouse_performance"))[0]["fc_id"] == "FC_DELHI"


def test_bronze_of_one_day_replaces_that_day_only(spark, rows, tmp_path):
    replay, layout = Replay(tmp_path / "log"), Layout(str(tmp_path / "lake"))
    log, entity = ReplayLog(str(tmp_path / "log")), ENTITIES["orders"]
    replay.add("orders", [order_payload()])
    for day in ("2026-07-01", "2026-07-02"):
        layers.ingest_batch(spark, log, entity, layout, at(f"{day} 00:00:00"))
        layers.bronze(spark, entity, layout, at(f"{day} 01:00:00"), since=day)
    layers.bronze(spark, entity, layout, at("2026-07-03 01:00:00"), since="2026-07-02")
    df = layers.bronze_rows(spark, entity, layout)
    assert sorted((str(r["ingested_at"]), str(r["bronze_processed_at"])) for r in rows(df)) == [
        ("2026-07-01", "2026-07-01 01:00:00"), ("2026-07-02", "2026-07-03 01:00:00")]


def test_a_run_of_new_dates_equals_a_full_run(spark, rows, tmp_path):
    replay, layout = Replay(tmp_path / "log"), Layout(str(tmp_path / "lake"))
    serving = ParquetServing(spark, str(tmp_path / "serving"))
    replay.add_master()
    replay.add("orders", [order_payload(s) for s in ("S1", "S2")])
    ingest_all(spark, ReplayLog(str(tmp_path / "log")), layout, "2026-07-01")

    def events_of(day, *payloads):
        part = Replay(tmp_path / f"log-{day}")
        part.add("shipment_events", payloads)
        layers.ingest_batch(spark, ReplayLog(str(part.path)), ENTITIES["shipment_events"], layout,
                            at(f"{day} 00:00:00"))

    def fact():
        table = Table(spark, layout.gold("fact_shipment")).read().drop("gold_processed_at")
        return sorted(map(str, rows(table)))

    def run(day, since=None):
        run_batch(spark, layout, serving, F.lit("2026-07-05"), at(f"{day} 01:00:00"), since)

    events_of("2026-07-01", *[event_payload(n) for n in (1, 2, 4)], event_payload(3, "S2"))
    run("2026-07-01")
    events_of("2026-07-02", event_payload(3), event_payload(7), event_payload(1, "S2"), "broken")
    run("2026-07-02", since="2026-07-02")
    partly = fact()
    run("2026-07-02", since="2026-07-02")
    assert fact() == partly
    run("2026-07-03")
    assert fact() == partly and len(partly) == 2
    events = layers.silver_rows(spark, ENTITIES["shipment_events"], layout)
    assert events.count() == 7 and "ingested_at" not in events.columns


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1, 1), (1, 2, 2, 0)])
def test_orders_merged_by_day_equal_a_full_rebuild(spark, rows, tmp_path, order):
    entity, days = ENTITIES["orders"], ["2026-07-01", "2026-07-02", "2026-07-03"]
    logs = []
    for n, payloads in enumerate([
            [order_payload("S1"), order_payload("S2"), "broken"],
            [order_payload("S1", order_value=7.0, event_timestamp="2026-07-02T08:00:00Z"),
             order_payload("S3", event_timestamp="no time")],
            [order_payload("S1", order_value=9.0, event_timestamp="2026-07-01T01:00:00Z"),
             order_payload("S2", order_value=5.0, event_timestamp="2026-07-03T08:00:00Z")]]):
        replay = Replay(tmp_path / f"log{n}")
        replay.add("orders", payloads)
        logs.append(ReplayLog(str(replay.path)))

    def silver_of(layout):
        table = Table(spark, layout.silver(entity.kind, entity.name)).read()
        return sorted(map(str, rows(table.drop("silver_processed_at"))))

    merged, full = Layout(str(tmp_path / "merged")), Layout(str(tmp_path / "full"))
    for layout in (merged, full):
        for log, day in zip(logs, days):
            layers.ingest_batch(spark, log, entity, layout, at(f"{day} 00:00:00"))
        layers.bronze(spark, entity, layout, at("2026-07-04 00:00:00"))
    layers.silver(spark, entity, full, at("2026-07-04 00:00:00"))
    for n in order:     # `since` takes a day and those after it, so earlier days come in later
        layers.silver(spark, entity, merged, at("2026-07-04 00:00:00"), since=days[n])
    layers.silver(spark, entity, merged, at("2026-07-04 00:00:00"), since=days[0])
    assert silver_of(merged) == silver_of(full)
    assert {r["order_value"] for r in rows(layers.silver_rows(spark, entity, merged))
            if r["order_id"].endswith(("S1", "S2"))} == {7.0, 5.0}


def test_empty_layers_run(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    entity = ENTITIES["orders"]
    assert layers.bronze(spark, entity, layout, at("2026-07-02 01:00:00"))["rows"] == 0
    assert layers.silver(spark, entity, layout, at("2026-07-02 01:00:00"))["rows"] == 0


def test_customer_tier_comes_from_the_newest_order(make, rows):
    orders = make("order_id string, customer_id string, event_timestamp timestamp, "
                  "customer_tier string",
                  ("O1", "C1", "2026-07-01 08:00:00", "STANDARD"),
                  ("O2", "C1", "2026-07-02 08:00:00", "PRIME"),
                  ("O3", None, "2026-07-02 08:00:00", "PRIME"))
    assert rows(gold.customers(orders)) == [{"customer_id": "C1", "customer_tier": "PRIME"}]


@pytest.mark.parametrize("kind", ["bronze", "silver", "gold"])
def test_layout_paths(kind):
    layout = Layout("s3a://lake/")
    path = layout.gold("dim") if kind == "gold" else getattr(layout, kind)("master", "x")
    assert path.startswith(f"s3a://lake/{kind}/") and "//" not in path[6:]
