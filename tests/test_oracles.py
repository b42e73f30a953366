"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as entry
from parcelake import sizing
from verification.compare import compare, oracle_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = {name: query for name, query in entry.queries().items() if name.startswith("q_")}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", [
    "q_fact_shipment", "q_enrich_events", "q_scd2_asof", "q_network_check", "q_geofence",
    "q_stage_rules", "q_bi_warehouse"])
def test_query_equals_sql_when_nothing_may_be_broadcast(spark, con, name, monkeypatch):
    """Every lookup takes the way for tables of any size: hot keys apart, the rest by shuffle."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["fc_id", "fc_name", "region"]
    assert df.count() > 0
