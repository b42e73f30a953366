from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from parcelake.llm import components, near_duplicates as nd, shingles, tables


def brute(rows, similarity=nd.SIMILARITY):
    """doc_id -> (class, links) by comparing all pairs."""
    sets = {d: set(shingles.shingle_set(t).tolist()) for d, t in rows}
    root, links = {d: d for d in sets}, defaultdict(int)

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and common >= similarity * (len(sets[a]) + len(sets[b]) - common) - 1e-6:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (find(d), links[d]) for d in sets}


def families(n, seed=2):
    """Texts in families of near copies around the threshold, and exact copies."""
    rng, rows = random.Random(seed), []
    while len(rows) < n:
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(40, 200))]
        for _ in range(rng.choice([1, 1, 2, 5, 40])):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10 ** 9)}"
            rows += [(len(rows), " ".join(own))] * 1
            if rng.random() < .2:
                rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [nd.BLOCK, 8])
def test_join_by_brute_force(spark, by_id, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = families(500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, expected = by_id(nd.join(docs)), brute(rows)
    assert {d: (r["class_id"], r["n_links"]) for d, r in found.items()} == expected
    kept = sorted(r["doc_id"] for r in nd.keep_one(docs).collect())
    assert kept == sorted({c for c, _ in expected.values()})


def test_given_documents(spark, by_id):
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents")
    found = by_id(nd.join(docs))
    expected = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert {d: (r["class_id"], r["n_links"]) for d, r in found.items()} == expected


def test_bands_reach_the_recall():
    bands, rows = nd.choose_bands(nd.SIMILARITY, nd.RECALL)
    assert bands * rows <= nd.HASHES and 1 - (1 - nd.SIMILARITY ** rows) ** bands >= nd.RECALL
    sketcher, rng, met = nd.Sketcher(bands, rows), np.random.default_rng(0), 0
    for _ in range(400):
        own = np.unique(rng.integers(0, 1 << 63, 225).astype(np.uint64))
        a, b = own[:200], own[25:]          # Jaccard 175 / 225, just below the threshold
        met += bool((sketcher.band_hashes(a) == sketcher.band_hashes(b)).any())
    assert met >= 396


def test_components_by_brute_force(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)]
    found = {r["node"]: r["root"] for r in components.stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {n: r for n, r in root.items() if n != r}


def test_special_cases(odd, nothing):
    rows = nd.join(odd).collect()
    assert len(rows) == 10
    groups = {}
    for r in rows:
        groups.setdefault(r["doc_id"], []).append((r["class_id"], r["n_copies"], r["n_links"]))
    assert groups[6] == [(6, 3, 2)] * 2 and groups[7] == [(6, 3, 2)]
    assert groups[1] == [(1, 1, 0)] and groups[2] == [(2, 1, 0)] and groups[4] == [(4, 1, 0)]
    assert groups[5] == [(5, 1, 0)] and len(groups[None]) == 2
    kept = nd.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 4, 5, 6, 8]
    assert nd.join(nothing).count() == 0 and nd.keep_one(nothing).count() == 0
