from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from parcelake.llm import language, tables


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark, by_id):
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents")
    found = by_id(language.predict(docs, language.fit(docs)))
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert found.keys() == truth.keys()
    held = [d for d in truth if found[d]["held_out"]]
    assert held and all(found[d]["held_out"] == is_held_out(d) for d in truth)
    assert np.mean([found[d]["lang_pred"] == truth[d] for d in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_convolution_by_brute_force():
    net = language.train([("x", b"abcabc abc"), ("y", b"zzz yyy xxz")] * 8)
    windows, counts = language.to_windows([b"abc zzz", b"q" * 300, b""])
    assert counts.tolist() == [1, 2, 0]
    hidden = net.pooled(windows)[0]
    expected = []
    for window in windows.tolist():
        row = [max(sum(table[o][window[p + o]][f] for o in range(len(table)))
                   for p in range(len(window) - len(table) + 1))
               for table in net.filters for f in range(language.FILTERS)]
        expected.append(row)
    np.testing.assert_allclose(hidden, np.array(expected) + net.bias, rtol=1e-4)


def test_long_text_is_read_to_its_end():
    net = language.train([("x", b"abcabc abc " * 9), ("y", b"zzz yyy xxz " * 9)] * 20)
    long = "abcabc abc " * 200_000
    labels, scores = language.judge(net, pa.array([long, long[:200] + "zzz yyy xxz " * 300_000, "zzz yyy xxz " * 20]))
    assert labels == ["x", "y", "y"] and min(scores) > 0.9


def test_special_cases(odd, nothing):
    net = language.fit(odd)
    assert net.labels == ["de", "en"]
    found = language.predict(odd, net).collect()
    assert len(found) == 10
    for row in found:
        unknown = row["doc_id"] in (1, 2, 4)
        assert (row["lang_pred"] == "und") == unknown or row["doc_id"] is None
        assert row["held_out"] == is_held_out(row["doc_id"])
        assert row["score"] > 0 or row["lang_pred"] == "und"
    assert language.fit(nothing) is None
    assert language.predict(nothing, None).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}
    kept = language.keep_known(odd, net, 0.0)
    assert kept.columns == odd.columns and kept.filter("doc_id in (1, 2, 4)").count() == 0
    assert kept.filter("doc_id = 6").count() == 2


def test_letters_are_of_category_l():
    import unicodedata

    for text in ("½ ²", "Ⅷ", "", "123 _ !", "٣", "①"):
        assert not language.has_letter(text)
    for text in ("½ a", "é", "中", "² ß", "ª"):
        assert language.has_letter(text)
    for number in range(0x3000):
        assert language.has_letter(chr(number)) == unicodedata.category(chr(number)).startswith("L")
