from __future__ import annotations

import random

import numpy as np

from parcelake.llm import decontaminate as dc, shingles, tables

SF = "/root/testdata/sf0.001"


def full_score(item, window):
    """Smith-Waterman cell by cell."""
    best, row = 0, [0] * (len(window) + 1)
    for a in item:
        new = [0]
        for j, b in enumerate(window, 1):
            new.append(max(0, row[j - 1] + (dc.MATCH if a == b else dc.OTHER), row[j] + dc.GAP, new[-1] + dc.GAP))
        row = new
        best = max(best, *row)
    return best / (dc.MATCH * len(item))


def test_alignment_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, window = rng.integers(1, 6, rng.integers(1, 12)), rng.integers(0, 6, rng.integers(0, 25))
        score, first, last = dc.align(item, window)
        assert score == full_score(item.tolist(), window.tolist())
        if score:
            assert full_score(item.tolist(), window[first:last + 1].tolist()) == score


def test_hits_by_brute_force(spark, docs):
    """Every document against every item, aligned over the whole text."""
    benchmark = tables.read(spark, SF, "benchmark")
    items = [(r["item_id"], shingles.words(r["text"])) for r in benchmark.collect()]
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.contamination(docs, benchmark).collect()}
    expected = {}
    for row in docs.collect():
        words = shingles.words(row["text"])
        grams = {tuple(words[i:i + 2]) for i in range(len(words))}
        for item_id, item in items:
            # two fifths of an item aligned have two of its words in a row
            if any(tuple(item[i:i + 2]) in grams for i in range(len(item))):
                numbers = {w: k for k, w in enumerate(dict.fromkeys(item), 1)}
                score = dc.align(np.array([numbers[w] for w in item]),
                                 np.array([numbers.get(w, 0) for w in words], np.int64))[0]
                if score >= dc.SCORE:
                    expected[row["doc_id"], item_id] = score
    assert found == expected and found


def planted(rng, words, edits):
    """Words of an item with a share of them replaced, dropped or followed by another."""
    out = []
    for word in words:
        if rng.random() < edits:
            out += rng.choice([["other"], [], [word, "more"]])
        else:
            out.append(word)
    return out


def test_edited_copies_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(4)
    names = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(names, k=40))) for k in range(30)]
    rows, truth = [], set()
    for k in range(300):
        words = rng.choices(names, k=200)
        if k % 3 == 0:
            item = rng.randrange(30)
            truth.add((k, item))
            words[100:100] = planted(rng, items[item][1].upper().split(), 0.2)
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.contamination(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == truth
    assert all(95 <= r["first_word"] <= 110 and 120 <= r["last_word"] <= 150 for r in found)
    clean = {r["doc_id"] for r in dc.keep_clean(docs, benchmark).collect()}
    assert clean == set(range(300)) - {d for d, _ in truth}


def edited(words, kind):
    """An edit at every third word: replaced, dropped, or a word put in after two or after each."""
    if kind == "replaced":
        return ["other" if k % 3 == 2 else w for k, w in enumerate(words)]
    if kind == "dropped":
        return [w for k, w in enumerate(words) if k % 3 != 2]
    every = 2 if kind == "after two" else 1
    return [x for k, w in enumerate(words) for x in ([w, "more"] if k % every == every - 1 else [w])]


def test_edits_at_every_third_word_are_found(spark):
    rng = random.Random(5)
    names = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(names, k=39 + k % 2))) for k in range(12)]
    rows, truth = [], set()
    kinds = ["replaced", "dropped", "after two", "after each"]
    for k in range(120):
        words = rng.choices(names, k=200)
        if k % 2:
            item = rng.randrange(12)
            own = edited(items[item][1].split(), kinds[k // 2 % 4])
            words[100:100] = own
            truth.add((k, item, dc.SCORE <= full_score(items[item][1].split(), own)))
        rows.append((k, " ".join(words)))
    assert sum(t[2] for t in truth) >= 45       # those with every third word replaced score 0.5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in dc.contamination(docs, benchmark).collect()}
    assert found == {t[:2] for t in truth if t[2]}
    assert {r["doc_id"] for r in dc.keep_clean(docs, benchmark).collect()} == set(range(120)) - {d for d, _ in found}


def test_long_passages_of_longer_items_are_found(spark):
    item = [f"w{k}" for k in range(400)]
    texts = [item[200:250], edited(item[100:150], "after two"), item[70:99], item[10:40], ["other"] * 50]
    docs = spark.createDataFrame([(k, " ".join(["x"] * 60 + t + ["y"] * 60)) for k, t in enumerate(texts)],
                                 "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"]: r for r in dc.contamination(docs, benchmark).collect()}
    assert sorted(found) == [0, 1, 3]
    assert (found[0]["score"], found[0]["first_word"], found[0]["last_word"]) == (50 / 400, 60, 109)
    assert sorted(r["doc_id"] for r in dc.keep_clean(docs, benchmark).collect()) == [2, 4]


def test_no_alignment_is_missed():
    """Few different words, so that all kinds of alignments occur; every score around the threshold."""
    rng, some = random.Random(7), 0
    for case in range(1500):
        names = [f"w{k}" for k in range(rng.choice([4, 10, 30]))]
        item = rng.choices(names, k=rng.randrange(3, 24))
        words = rng.choices(names, k=rng.randrange(40))
        words[7:7] = planted(rng, item, rng.choice([0.3, 0.5, 0.7]))
        seeds = dc.Seeds([(1, " ".join(item))])
        seeds.keep_rare({int(k): rng.randrange(5) for k in seeds.sorted})
        score, expected = [h[1] for h in seeds.hits(" ".join(words))], full_score(item, words)
        assert score == ([expected] if expected >= dc.SCORE else []), (item, words)
        some += expected >= dc.SCORE and expected < 0.6
    assert some > 100


def test_item_in_every_document_keeps_its_seeds(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(k, f"before {k} {item} after") for k in range(50)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert dc.contamination(docs, benchmark).count() == 50


def test_blocks_change_nothing(docs, spark):
    benchmark = tables.read(spark, SF, "benchmark")
    blocks = list(dc.blocks(benchmark, 2000))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == sorted(
        r["item_id"] for r in benchmark.collect())


def test_special_cases(spark, odd, nothing):
    benchmark = spark.createDataFrame(
        [(1, None), (2, ""), (3, "x"), (4, "same text here for all of us"), (4, "same text here for all of us"),
         (None, "the lost and found of the of"), (5, "word word word word")], "item_id long, text string")
    rows = [(r["doc_id"], r["item_id"]) for r in dc.contamination(odd, benchmark).collect()]
    assert sorted(rows, key=repr) == sorted(
        [(6, 4)] * 4 + [(7, 4)] * 2 + [(None, None), (5, 5), (8, 3)], key=repr)
    assert dc.contamination(nothing, benchmark).count() == 0
    assert dc.contamination(odd, benchmark.limit(0)).count() == 0
    kept = dc.keep_clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == 4
