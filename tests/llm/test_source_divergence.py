from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelake.llm import queries, source_divergence, tables
from tests.llm.conftest import SF

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, least_docs=30, top=50):
    """Dense tables in Python's own integers, every copy read for itself."""
    groups, docs = defaultdict(Counter), Counter()
    langs = defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = TERM.findall(text.translate(FOLD))
        groups[lang, source].update(words)
        docs.update((lang, w) for w in set(words))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = sorted(w for (of, w), n in docs.items() if of == lang and n >= least_docs)

        def probabilities(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + 10 ** 9 * (counts[w] + 5) // (total + 5 * len(kept)) for w in kept}

        p = {s: probabilities(groups[lang, s]) for s in sources}
        q = probabilities(sum((groups[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][w] - p[t][w]) for w in kept), t) for t in sources if t != s]
            own = [(p[s][w] - q[w], w) for w in kept if groups[lang, s][w] and p[s][w] > q[w]]
            for part, values, most in (("pair", pairs, None), ("term", own, top)):
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def table(spark, rows):
    return spark.createDataFrame([(i, *r, 1, 2, "x", 0) for i, r in enumerate(rows)],
                                 "doc_id int, text string, lang string, source string, n int, docs int, "
                                 "term string, number int")


def test_given_documents(spark):
    rows = [tuple(r) for r in tables.read(spark, SF, "documents").select("text", "lang", "source").collect()]
    assert found(queries.op12_source_divergence(spark, SF)) == brute(rows)


WORDS = ["über", "Ab", "ab", "zz", "中文", "don't", "x1y", "ÀÉ", "\U0001f642", "été", "naïve", "a b"]


def sample(n, sources, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = rng.choice(WORDS, rng.integers(0, 12))
        rows.append((" ".join(words), ["en", "de", None][int(rng.integers(0, 3))],
                     f"s{rng.integers(0, sources)}"))
    rows += [("Ab ab copies of one text", "en", f"s{i % 3}") for i in range(200)]
    rows += [(None, None, None), ("", "", ""), ("", "fr", "only"), ("lonely words", "it", "a"), (None, "it", None)]
    return rows


@pytest.mark.parametrize("sources", [3, 9])
def test_by_brute_force(spark, sources):
    rows = sample(400, sources)
    assert found(source_divergence.audit(table(spark, rows), 5)) == brute(rows, 5)


def test_tiles_blocks_and_batches_change_nothing(spark, monkeypatch):
    rows = sample(300, 11, seed=4)
    monkeypatch.setattr(source_divergence, "SOURCES_AT_ONCE", 2)
    monkeypatch.setattr(source_divergence, "BLOCK_ROWS", 7)
    assert found(source_divergence.audit(table(spark, rows), 5)) == brute(rows, 5)


def test_pair_sums_by_tile():
    """Tiles of the last and first sources together hold every pair once."""
    import pandas as pd

    rng = np.random.default_rng(1)
    n, v = 2 * source_divergence.TILE + 3, 40
    base = rng.integers(1, 50, n)
    p = np.where(rng.random((n, v)) < .1, rng.integers(50, 90, (n, v)), base[:, None])
    s, w = np.nonzero(p != base[:, None])
    left = pd.DataFrame({"lang": "x", "number": s, "term": w, "p": p[s, w]})
    seen = set()
    for low in range(3):
        for high in range(low, 3):
            sides = [np.isin(np.arange(n) // source_divergence.TILE, (low, high))]
            right = pd.DataFrame({"lang": "x", "number": np.flatnonzero(sides[0]), "low": low, "high": high,
                                  "base": base[sides[0]]})
            got = source_divergence._distances(left[left["number"].isin(right["number"])], right)
            for a, b, value, terms in zip(got["a"], got["b"], got["value"], got["seen"]):
                unseen = (v - terms) * abs(int(base[a]) - int(base[b]))
                assert value + unseen == np.abs(p[a] - p[b]).sum()
                assert (a, b) not in seen
                seen.add((a, b))
    assert len(seen) == n * (n - 1) // 2


def test_special_cases(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    assert found(source_divergence.audit(odd, 1)) == brute(rows, 1)
    assert found(source_divergence.audit(odd)) == brute(rows)
    assert found(source_divergence.audit(nothing)) == []


def test_long_texts_are_cut_between_words(monkeypatch):
    folded = b"  one two   " + b"x" * 50 + b" three\xc3\xa9 "
    for limit in (1, 3, 5, 9, 17, 1000):
        cut = [w for words in source_divergence.pieces(folded, limit) for w in words]
        assert cut == folded.split()


def test_copies_are_read_once(spark):
    rows = [("same text", "en", f"s{i % 4}") for i in range(100)] + [("other text", "en", "s0")]
    texts = source_divergence.collapsed(table(spark, rows), 4).collect()
    assert sorted((r["text"], sorted((c["source"], c["n"]) for c in r["copies"])) for r in texts) == [
        ("other text", [("s0", 1)]), ("same text", [(f"s{i}", 25) for i in range(4)])]
