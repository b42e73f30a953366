"""Properties of the physical plans of all registered queries."""

import re

import pytest

import __spark_entry__ as entry
from parcelake import sizing

SF_DIR = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry.queries().items() if name.startswith("q_")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin",
                 "SinglePartition, REPARTITION"):
        assert node not in plan, node
    assert plan.count("FileScan") >= 1


@pytest.mark.parametrize("name, table, columns", [
    ("q_dim_customer", "orders", {"o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"}),
    ("q_stage_pivot", "events", {"ts", "user_id", "event_type", "value"}),
    ("q_lifecycle_check", "events", {"ts", "user_id", "event_type", "value"}),
    ("q_dim_date", "events", {"ts", "user_id"}),    # event times depend on both
    ("q_parse_json", "events", {"event_id", "props"}),
])
def test_scans_read_only_what_is_used(spark, name, table, columns):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    read = [set(re.findall(r"(\w+):", schema)) for path, schema in re.findall(
        r"file:\S+/(\w+)\.parquet\], .*?ReadSchema: struct<(.*?)>", plan) if path == table]
    assert read and all(r <= columns for r in read)


def test_value_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(o_orderdate), " in plan_of(
        QUERIES["q_scd2_changes"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["q_bi_cost", "q_bi_kpis", "q_fc_backlog", "q_alert_delay"])
def test_aggregations_are_partial_before_the_shuffle(spark, name):
    assert "partial_" in plan_of(QUERIES[name](spark, SF_DIR))


def test_top_rows_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["q_live_feed"](spark, SF_DIR))


def test_json_is_parsed_once_per_row(spark):
    plan = plan_of(QUERIES["q_silver_orders"](spark, SF_DIR))
    assert len(re.findall(r"Generate explode\(array\(from_json", plan)) == 1
    assert not re.search(r"Filter .*from_json", plan)


@pytest.mark.parametrize("name, most", [
    ("q_enrich_events", 2), ("q_stage_rules", 2), ("q_geofence", 3), ("q_fact_shipment", 4)])
def test_lookups_read_their_input_at_most_once_more(spark, monkeypatch, name, most):
    """With broadcasting of tables ruled out: one scan of the events for the rows, one for the hot
    keys of the whole chain (the sample's orders are made of events too)."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert 1 <= final.count("/events.parquet") <= most


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_are_known_to_be_empty(spark, name):
    assert "ExistingRDD" not in plan_of(QUERIES[name](spark, SF_DIR))
