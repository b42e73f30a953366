from __future__ import annotations

import re
from collections import Counter

import numpy as np

from parcelake.llm import quality, tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """Base counts straight from their definition."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again))


def test_counts_by_brute_force(docs):
    texts = [r["text"] for r in docs.select("text").collect()]
    texts += ["", "a", "a b", "a b c", "a b c a b c", "x\nx\n \ny\nx", "é中 #\x0b|\x85 a b", "a a a a", "t\r\nt\r\n"]
    for text in texts:
        assert quality.features(text.encode())[:5] == brute(text)


def test_every_document_is_judged(docs, by_id):
    found = by_id(quality.score(docs))
    for row in docs.select("doc_id", "text").collect():
        n_words, chars, symbols, dup, repeat = brute(row["text"])
        got = found[row["doc_id"]]
        failed = n_words < 50 or 100 * repeat > 50 * n_words
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"],
                got["n_repeat_words"], got["base_failed"]) == (n_words, chars, symbols, dup, repeat, failed)
        assert not (failed and got["kept"]) and 0 <= got["quality"] <= 1


def test_estimation_finds_planted_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    right = np.linspace(0.7, 0.95, quality.RULES)
    says = np.where(rng.random((len(good), quality.RULES)) < right, good[:, None], ~good[:, None])
    cast = np.where(rng.random(says.shape) < 0.2, quality.ABSTAIN, np.where(says, quality.GOOD, quality.BAD))
    pattern, count = np.unique(cast @ quality.BASE, return_counts=True)
    table = quality.estimate(pattern, count.astype(float))
    assert np.mean((table[cast @ quality.BASE] >= 0.5) == good) > 0.97


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    judged = quality.score(tables.read(spark, sf, "documents")).withColumnRenamed("quality", "probability")
    rows = judged.join(tables.read(spark, sf, "labels"), "doc_id").filter("not base_failed").collect()
    for label, least in ((0, 0.95), (1, 0.98)):
        own = [r for r in rows if r["quality"] == label]
        assert np.mean([r["kept"] == bool(label) for r in own]) > least


def test_special_cases(odd, nothing):
    found = quality.score(odd).collect()
    assert len(found) == 10
    assert all(r["base_failed"] for r in found)
    assert {r["doc_id"]: r["n_repeat_words"] for r in found}[5] == 40_000
    assert quality.score(nothing).count() == 0
    assert quality.keep_good(nothing).columns == nothing.columns
    assert quality.keep_good(odd).count() == 0


def test_keep_good_is_the_verdict(docs):
    kept = {r["doc_id"] for r in quality.score(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == kept
