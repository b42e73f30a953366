import random

import pytest
from pyspark.sql import functions as F

from parcelake import sizing
from parcelake.operators.keyed import hot_hashes, hot_share, latest_per_key, lookup
from parcelake.sizing import fits_broadcast, shuffles_sized_for


def test_latest_per_key_breaks_ties_by_all_columns(make, rows):
    df = make("k string, t int, a string, b int",
              ("x", 1, "z", 9), ("x", 2, "a", 1), ("x", 2, "b", 0), ("y", None, "n", 1),
              ("y", 0, "m", 1))
    out = rows(latest_per_key(df, ["k"], ["t"]), "k")
    assert out["x"]["a"] == "b" and out["y"]["a"] == "m"


def test_latest_per_key_reduces_before_the_shuffle(make):
    df = make("k string, t int", ("x", 1))
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange") == 1 and "Window" not in plan


def test_hot_keys_are_found_and_bounded(spark, rows):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    hot = spark.range(1).select(F.xxhash64(F.lit("hot")).alias("h")).first()["h"]
    assert [(r["_n"], r["_hash"]) for r in rows(hot_hashes(df, "k"))] == [(0, hot)]
    both = rows(hot_hashes(df, F.when(F.lit(False), F.lit("x")), "k", share=0.5 / 30_000))
    assert len(both) == 20_001 and {r["_n"] for r in both} == {1}


def test_hot_means_more_than_a_partition_within_a_bounded_broadcast(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        for partitions, keys in ((4, 4), (50_000, 50_000), (2_000_000, 65_536)):
            spark.conf.set(key, partitions)
            assert hot_share(spark) == 1 / keys
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shuffled_lookup_equals_a_plain_left_join(spark, make, rows, seed):
    rng = random.Random(seed)
    keys = ["hot"] * 300 + [None] * 300 + [f"k{rng.randrange(40)}" for _ in range(300)]
    facts = make("id int, k string", *enumerate(keys))
    table = make("k string, name string, n int",
                 ("hot", "H", 1), *[(f"k{i}", None if i % 5 == 0 else f"N{i}", i)
                                    for i in range(0, 40, 2)])
    expected = sorted(map(str, rows(facts.join(table, "k", "left").select("id", "k", "name", "n"))))
    for limit in (0, 1 << 30):
        got = lookup(facts, table, "k", spread_by="id", limit=limit)
        assert got.columns == ["id", "k", "name", "n"]
        assert sorted(map(str, rows(got))) == expected


def test_hot_and_null_keys_do_not_meet_in_one_task(spark):
    """A third of the rows under one key, a third under null: the shuffle spreads both."""
    n = 60000
    facts = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    table = facts.where("k IS NOT NULL").select("k").distinct().withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(facts, table, "k", spread_by="id", limit=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(sizes) == n and max(sizes) < 1.5 * n / 4


def test_the_shuffle_of_a_lookup_goes_by_key_and_deal(spark):
    """Null keys are dealt over all tasks; the table is no aggregate, so the optimiser keeps the join."""
    facts = spark.range(60000).select(
        "id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id"))).alias("k"))
    table = spark.range(60000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(facts, table, "k", spread_by="id", limit=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        found = out.where("v IS NOT NULL").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == 6000 and sum(sizes) == 60000
    assert max(sizes) < 1.5 * 60000 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_broadcast_is_decided_by_size(spark):
    assert fits_broadcast(spark.range(10))
    assert not fits_broadcast(spark.range(10_000_000_000))


def test_shuffle_partitions_follow_the_input_size(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    df = spark.range(10)
    for size, expected in [(100, int(before)), (100 << 40, 1_638_400), (640 << 20, 10)]:
        monkeypatch.setattr(sizing, "scanned_bytes", lambda _, size=size: size)
        with shuffles_sized_for(spark, df) as partitions:
            assert partitions == expected == int(spark.conf.get(key))
        assert spark.conf.get(key) == before


def test_unknown_input_size_is_an_error(spark, make):
    unknown = make("a int", (1,))
    if sizing.estimated_bytes(unknown) >= sizing.UNKNOWN_BYTES:
        with pytest.raises(ValueError, match="unknown"):
            sizing.scanned_bytes(unknown)
    assert sizing.scanned_bytes(spark.range(10)) == 80
