from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelake.llm import hard_negatives, queries, tables
from tests.llm.conftest import SF

EMBEDDING = "vec_id long, embedding array<float>, label int, score long, v string, anchor_key int, rank string"


def brute(rows, positives=5, negatives=5, low=80, high=100):
    """All inner products, in Python's own integers."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or not all(
                x is not None and math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable.append((vec_id, label, [math.floor(256 * float(x)) for x in vector]))
    out = []
    for a, a_label, q in usable:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), n, label) for n, label, v in usable if n != a)
        for p_score, p, _ in [s for s in scored if s[2] == a_label][:positives]:
            hard = [(n, -s) for s, n, label in scored
                    if label != a_label and low * -p_score <= 100 * -s <= high * -p_score]
            out += [(a, p, i + 1, n, -p_score, s) for i, (n, s) in enumerate(hard[:negatives])]
    return sorted(out)


def found(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], EMBEDDING)
    got = hard_negatives.mine(hard_negatives.whole_numbers(hard_negatives.relabelled(table)),
                              F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def test_given_vectors(spark):
    rows = [tuple(r) for r in tables.read(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, queries.op11_hard_negatives(spark, SF).collect()))
    assert got == brute(rows) and got


@pytest.mark.parametrize("kind", ["clusters", "ties", "lengths", "negative"])
def test_by_brute_force(spark, kind):
    rng = np.random.default_rng(len(kind))
    n = 1200
    centers = rng.normal(size=(12, 16))
    vectors = centers[rng.integers(0, 12, n)] + rng.normal(scale=.2, size=(n, 16))
    if kind == "ties":
        vectors = np.round(vectors)
        vectors[rng.random(n) < .35] = vectors[0]
    if kind == "lengths":
        vectors *= np.exp(rng.normal(scale=2, size=(n, 1)))
    if kind == "negative":
        vectors = -np.abs(vectors) * np.where(rng.random((n, 1)) < .5, 1, -1)
    labels = np.where(rng.random(n) < .4, 3, rng.integers(0, 10, n))
    rows = [(i, v.tolist(), int(label)) for i, (v, label) in
            enumerate(zip(vectors.astype(np.float32), labels))]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.5], 2), (3, [1.0, nan], 2), (4, [inf, 1.0], 2),
            (5, [None, 1.0], 2), (6, None, 2), (8, [1.0, 2.0], None), (None, [1.0, 2.0], 2), (9, [], 2),
            (10, [1.0, 1.6, 3.0], 2), (11, [2.0], 2), (100, [], 1), (200, [0.0, 0.0], 2), (12, [1.0, 1.5], 2),
            (13, [-1.0, -1.0], 1), (300, [1.0, 1.6, 3.0], 5)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []          # no anchor


def test_repeated_rows_are_rows(spark):
    rows = [(0, [1.0], 0), (0, [1.0], 0), (1, [1.0], 1), (2, [0.9], 2), (2, [0.9], 2)]
    # two equal anchors, each with one positive and the same negative twice
    assert found(spark, rows) == [(0, 1, 1, 2, 65536, 58880)] * 2 + [(0, 1, 2, 2, 65536, 58880)] * 2


def test_huge_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1.0, 2.0, 3.0]) * 2.0 ** 20 for _ in range(4)], i % 3) for i in range(230)]
    assert found(spark, rows) == brute(rows)


def test_blocks_of_anchors_and_small_buckets_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(5, 8))
    vectors = (centers[rng.integers(0, 5, 900)] + rng.normal(scale=.1, size=(900, 8))).astype(np.float32)
    rows = [(i, v.tolist(), i % 4) for i, v in enumerate(vectors)]
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 2 * 8 * 8)          # two anchors a block
    assert found(spark, rows) == brute(rows)


def test_pruned_search_sees_every_wanted_vector():
    """Feasible ranges never lose a vector that reaches the threshold, and do leave vectors out."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    centers = rng.normal(size=(20, 24))
    centers *= 5 / np.linalg.norm(centers, axis=1, keepdims=True)      # a bucket holds similar lengths
    p = np.floor(64 * (centers[rng.integers(0, 20, 1500)] + rng.normal(scale=.05, size=(1500, 24))))
    q = np.floor(64 * (centers + rng.normal(scale=.05, size=centers.shape)))
    block = pa.table({"anchor_key": np.arange(20), "vec_id": np.arange(20), "label": np.zeros(20, np.int64),
                      "length": np.linalg.norm(q, axis=1), "v": pa.array(q.tolist(), pa.list_(pa.float64()))})
    anchors = hard_negatives.Anchors(block)
    bucket = hard_negatives.Bucket(np.arange(1500), p, np.linalg.norm(p, axis=1))
    scores = q @ p.T
    least = np.quantile(scores, .98, axis=1)
    seen, scored = {i: set() for i in range(20)}, 0
    for part, got, places in anchors.feasible(bucket, np.arange(20), least):
        scored += got.size
        for i, row in zip(part, got):
            at = np.arange(1500) if places is None else places
            assert (row == scores[i][at]).all()
            seen[int(i)] |= set(at[row >= least[i]].tolist())
    assert all(seen[i] == set(np.flatnonzero(scores[i] >= least[i]).tolist()) for i in range(20))
    assert scored < scores.size / 2
