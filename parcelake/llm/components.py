"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelake.llm import tables


def stars(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) for every node but the roots, from a, b.

    Each round connects nodes to the smallest neighbour, so a component's depth about halves. A
    round is written to the shared folder. Self-edges and null nodes are ignored.
    """
    now = tables.materialise(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                         .alias("e")).select("e.*")
                 .filter(F.col("a") != F.col("b")).distinct())
        now = tables.materialise(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
