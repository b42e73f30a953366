import pytest
from pyspark.sql import functions as F

from parcelake import domain, schemas
from parcelake.operators.clean import drop_lineage, to_silver, valid_rows
from parcelake.operators.parse import cast_times, parse_payload, to_envelope

ENVELOPE = "json_payload string, kafka_partition int, kafka_offset bigint"
BRONZE_EXTRA = ("kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, "
                "ingested_at date, bronze_processed_at timestamp")


@pytest.mark.parametrize("text", ["not json", "[]", "", None, '{"order_value":"x"}', '{"order_id":'])
def test_malformed_payload_is_quarantined_with_its_text(make, rows, text):
    df = parse_payload(make(ENVELOPE, (text, 0, 1)), schemas.ORDER)
    (row,) = rows(df)
    assert row["quarantined"] and row["json_payload"] == text


def test_good_payload_is_typed_and_loses_its_text(make, rows):
    text = '{"order_id":"O1","order_value":12.5,"unknown":1}'
    (row,) = rows(parse_payload(make(ENVELOPE, (text, 0, 1)), schemas.ORDER))
    assert (row["order_id"], row["order_value"]) == ("O1", 12.5)
    assert not row["quarantined"] and row["json_payload"] is None and row["kafka_offset"] == 1


def test_envelope_has_the_raw_columns(make):
    log = make("key string, value string, topic string, partition int, offset bigint, "
               "timestamp timestamp", ("k", "{}", "orders", 0, 7, "2026-07-01 08:00:00"))
    df = to_envelope(log, F.lit("2026-07-02"))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schemas.ENVELOPE]
    assert str(df.first()["ingested_at"]) == "2026-07-02"


def test_times_are_utc_whatever_the_session_zone(spark, make, rows):
    df = make("t string", ("2026-07-01T08:00:00Z",), ("garbage",), (None,))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        out = rows(cast_times(df, ["t"]).select(F.unix_timestamp("t").alias("t"), "bad_time"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out == [{"t": 1782892800, "bad_time": False}, {"t": None, "bad_time": True},
                   {"t": None, "bad_time": False}]


def test_capacity_and_status_rules(make):
    centers = schemas.ENTITIES[domain.TOPIC_FULFILLMENT_CENTERS]
    df = make("fulfillment_center_id string, daily_capacity int",
              ("A", 1), ("B", 0), ("C", -1), ("D", None), (None, 5))
    assert [r[0] for r in df.where(valid_rows(centers)).collect()] == ["A"]
    vehicles = schemas.ENTITIES[domain.TOPIC_VEHICLES]
    df = make("vehicle_id string, status string", ("A", "IN_USE"), ("B", "RETIRED"), ("C", None),
              (None, "AVAILABLE"), ("E", "MAINTENANCE"))
    assert [r[0] for r in df.where(valid_rows(vehicles)).collect()] == ["A", "E"]


def _bronze_orders(make, *rows_):
    columns = "order_id string, event_timestamp string, promised_delivery_time string, " \
              "order_value double, " + BRONZE_EXTRA
    return make(columns, *[(*r, None, None, None) for r in rows_])


def test_silver_orders_keep_the_newest_valid_copy(make, rows):
    t = "2026-07-01T0{}:00:00Z".format
    bronze = _bronze_orders(
        make,
        ("O1", t(8), None, 10.0, 0, 1), ("O1", t(9), None, 20.0, 0, 2),
        ("O1", t(9), None, 30.0, 0, 3),          # same time: higher offset wins
        ("O1", "garbage", None, 99.0, 0, 4),     # unreadable: set aside, does not win
        ("O2", t(8), None, 10.0, 0, 5), ("O2", t(9), None, 0.0, 0, 6),   # invalid copy ignored
        (None, t(8), None, 10.0, 0, 7), ("O3", t(8), None, -1.0, 0, 8))
    df = to_silver(bronze, schemas.ENTITIES[domain.TOPIC_ORDERS])
    assert not set(schemas.LINEAGE_COLUMNS) & set(drop_lineage(df).columns)
    good = rows(df.where("NOT quarantined"), "order_id")
    assert {k: v["order_value"] for k, v in good.items()} == {"O1": 30.0, "O2": 10.0}
    assert [r["order_value"] for r in rows(df.where("quarantined"))] == [99.0]


def test_silver_of_repeated_ingest_is_the_same(make, rows):
    t = "2026-07-01T08:00:00Z"
    one = _bronze_orders(make, ("O1", t, None, 10.0, 0, 1), ("O2", "bad", None, 9.0, 0, 2))
    entity = schemas.ENTITIES[domain.TOPIC_ORDERS]
    once, twice = to_silver(one, entity), to_silver(one.unionByName(one), entity)
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(twice)))


def test_shipment_events_are_not_deduplicated(make):
    columns = "event_id string, shipment_id string, event_timestamp string, " \
              "estimated_delivery_time string, promised_delivery_time string, " + BRONZE_EXTRA
    row = ("E1", "S1", "2026-07-01T08:00:00Z", None, None, 0, 1, None, None, None)
    bronze = make(columns, row, row, ("E2", None, None, None, None, 0, 2, None, None, None))
    assert to_silver(bronze, schemas.ENTITIES[domain.TOPIC_SHIPMENT_EVENTS]).count() == 2
