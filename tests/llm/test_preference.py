from __future__ import annotations

import zlib

import numpy as np

from parcelake.llm import preference, queries, tables
from tests.llm.conftest import SF


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op13_quality_ranking(spark, sf).join(tables.read(spark, sf, "labels"), "doc_id").collect()
    own = [r for r in rows if r["held_out"]]
    good = sorted(r["score"] for r in own if r["quality"] == 1)
    bad = [r["score"] for r in own if r["quality"] == 0]
    assert len(good) > 300 and len(bad) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in own]) > 0.99
    assert np.mean(np.searchsorted(good, bad, "right")) < 0.005 * len(good)        # area under the curve


def test_contract_columns(spark):
    got = queries.op13_quality_ranking(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == tables.read(spark, SF, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = tables.read(spark, SF, "documents"), tables.read(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, "
                               "1 - quality, quality) as quality")
    one, other = preference.fit(docs, labels), preference.fit(docs, turned)
    assert (one.weights == other.weights).all() and one.cut == other.cut


def test_ranking_recovers_planted_preferences():
    rng = np.random.default_rng(4)
    wanted = np.zeros(preference.WIDTH)
    wanted[:5] = [2, -1, 1, 0, -2]
    x = rng.normal(size=(6000, preference.WIDTH))
    good = rng.random(6000) < preference._sigmoid(x @ wanted * 3)
    model = preference.rank(x[good], x[~good], float(np.mean(~good)))
    assert np.corrcoef(model.weights * (1 / model.spread), wanted)[0, 1] > 0.95
    assert np.mean((model.score(x) >= preference.THRESHOLD) == good) > 0.88
    # the cut leaves out as large a share as the labels do
    assert abs(np.mean(model.score(x) < preference.THRESHOLD) - np.mean(~good)) < 0.01


def test_features_by_brute_force(docs):
    texts = [r["text"] for r in docs.limit(60).collect()] + ["", " ", "a", "a a a", "É!! é", "x\nx\n\nx", "A b c"]
    for text in (t.encode() for t in texts):
        got = preference.features(text)
        assert np.allclose(got[:256] ** 2 * max(len(text), 1), [text.count(bytes([b])) for b in range(256)])
        words = text.split()
        shapes = got[256:]
        assert np.isclose(shapes[0], np.log1p(len(words)))
        assert np.isclose(shapes[4] ** 2 * max(len(words), 1), len(set(words)))
        assert np.isclose(shapes[5] ** 2 * max(len(words), 1), sum(a == b for a, b in zip(words, words[1:])))
        assert np.isclose(shapes[6] ** 2 * max(len(words), 1), sum(not w.isalpha() for w in words))


def test_long_texts_are_cut_between_words(monkeypatch):
    text = ("one two two  three\nfour " * 40).encode() + b"z" * 300
    whole = preference.features(text)
    for limit in (40, 64, 333, 4096):
        monkeypatch.setattr(preference, "PIECE_BYTES", limit)
        if limit >= 301:
            assert np.allclose(preference.features(text), whole)
        assert np.allclose(preference.features(text[:900]), _with(900, text))


def _with(n, text):
    old, preference.PIECE_BYTES = preference.PIECE_BYTES, 1 << 20
    try:
        return preference.features(text[:n])
    finally:
        preference.PIECE_BYTES = old


def test_special_cases(spark, odd, nothing):
    docs, labels = tables.read(spark, SF, "documents"), tables.read(spark, SF, "labels")
    model = preference.fit(docs, labels)
    rows = preference.score_all(odd, model).collect()
    assert len(rows) == odd.count()
    by_text = {}
    for r, o in zip(rows, odd.collect()):
        assert r["doc_id"] == o["doc_id"] and 0 <= r["score"] <= 1
        assert r["held_out"] is not None and (r["doc_id"] is not None or not r["held_out"])
        assert by_text.setdefault(o["text"] or "", r["score"]) == r["score"]      # null like empty, copies alike
    assert preference.score_all(nothing, model).count() == 0


def test_unusable_labels(spark, docs):
    def labels(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, text string")

    assert preference.fit(docs, labels()) == 0.5
    assert preference.fit(docs, labels((1, 1, "t"), (2, 1, "t"), (2, 1, "t"))) == 0.75      # one document twice
    both = labels((1, 1, "t"), (1, 0, "t"), (2, None, "t"), (None, 1, "t"), (3, 7, "t"), (4, 1, "t"))
    held = [i for i in (1, 2, 3, 4) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert not held and preference.fit(docs, both) == 2 / 3
    assert preference.fit(docs, labels((-5, 0, "t"), (-6, 1, "t"))) == 0.5                    # no such document
    rows = preference.score_all(docs, 0.5).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}


def test_every_labelled_document_is_learned_from(spark):
    """More documents of a label than were once drawn; few partitions or many give the same numbers."""
    docs = spark.range(1, 12_001).selectExpr(
        "id AS doc_id", "concat(repeat(char(97 + cast(id % 23 AS int)), cast(1 + id % 7 AS int)), ' word ', id, "
        "if(id % 6 = 0, ' #*#', '')) AS text")
    labels = docs.selectExpr("doc_id", "if(doc_id % 6 = 0, 0, 1) AS quality")
    model = preference.fit(docs, labels)
    known = [r["text"].encode() for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    found = np.array([preference.features(text) for text in known])
    assert np.allclose(model.mean, found.mean(axis=0), atol=1e-7)
    bad = sum(b"#" in text for text in known)
    assert np.sum(model.score(found) < preference.THRESHOLD) == bad
    again = preference.fit(docs.repartition(13, "text"), labels)
    assert (again.weights == model.weights).all() and (again.cut, again.slope) == (model.cut, model.slope)


def test_the_loss_of_all_pairs_is_least():
    rng = np.random.default_rng(8)
    good, bad = rng.normal(.3, 1, (700, preference.WIDTH)), rng.normal(0, 1, (90, preference.WIDTH))
    model = preference.rank(good, bad, .1)
    good, bad = (np.clip((x - model.mean) / model.spread, -8, 8) for x in (good, bad))
    lost = preference._sigmoid((bad @ model.weights)[None, :] - (good @ model.weights)[:, None])
    gradient = (lost.mean(axis=0) @ bad / len(bad) - lost.mean(axis=1) @ good / len(good)
                + preference.DECAY * model.weights)
    assert np.abs(gradient).max() < 1e-4


def test_large_label_tables_are_not_broadcast(spark, monkeypatch):
    docs, labels = tables.read(spark, SF, "documents"), tables.read(spark, SF, "labels")
    one = preference.fit(docs, labels)
    monkeypatch.setattr(preference.tables, "BROADCAST_BYTES", 0)
    other = preference.fit(docs, labels)
    assert (one.weights == other.weights).all() and one.cut == other.cut
