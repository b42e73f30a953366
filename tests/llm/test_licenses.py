from __future__ import annotations

import random
import re
from itertools import product
from re import _constants as C, _parser

import pytest

from parcelake.llm import licenses, tables

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    places = sorted((at, label) for phrase, label in licenses.PHRASES.items() for at in range(len(words))
                    if words[at:at + len(phrase.split())] == phrase.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({label for _, label in places})))


def brute_rest(found):
    """Suppression by comparing all pairs."""
    return sorted(d for d in found if not any(
        e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or e[2] == d[2] and (e[:2] != d[:2] or e[3] < d[3]))
        and e != d for e in found))


def test_base_columns_by_brute_force(spark, by_id):
    docs = tables.read(spark, "/root/testdata/sf0.01", "documents")
    found = by_id(licenses.scan_all(docs))
    for row in docs.select("doc_id", "text").collect():
        r = found[row["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(row["text"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert any(r["n_base"] for r in found.values())


def test_there_are_hundreds_of_rules_and_their_keyword_is_needed():
    rules = licenses.rules()
    assert sum(len(group) for _, group in rules) > 200
    assert len({keyword for keyword, _ in rules}) == len(rules)


def matches(parsed):
    """Texts a pattern matches: all branches, optional parts left out and repeated most."""
    parts = []
    for kind, value in parsed:
        if kind is C.LITERAL:
            parts.append([chr(value)])
        elif kind is C.IN:
            parts.append([chr(v) for k, v in value if k is C.LITERAL]
                         or ["7" if (C.CATEGORY, C.CATEGORY_DIGIT) in value else "x"])
        elif kind is C.BRANCH:
            parts.append([text for branch in value[1] for text in matches(branch)])
        elif kind is C.SUBPATTERN:
            parts.append(matches(value[3]))
        else:
            assert kind is C.MAX_REPEAT
            low, high, inner = value
            parts.append(["".join(p) for n in {low, low if high is C.MAXREPEAT else high}
                          for p in product(matches(inner), repeat=n)])
    return ["".join(p) for p in product(*parts)]


def ungated(joined):
    return sorted((m.start(), m.end(), rank, number, label) for _, group in licenses.rules()
                  for rank, number, label, pattern in group for m in pattern.finditer(joined))


def test_keywords_skip_no_match_of_any_rule():
    texts = 0
    for line in licenses.RULES.strip().splitlines():
        if line.startswith("["):
            continue
        pattern = line.split(" ", 2)[2]
        for k, text in enumerate(matches(_parser.parse(pattern))):
            assert re.fullmatch(pattern, text)
            found = licenses.detections(text.encode())
            assert (0, len(text.encode())) in {d[:2] for d in found}, text
            if k < 3:
                assert sorted(found) == ungated(text.encode())
            texts += 1
    assert texts > 2000


def test_keywords_skip_no_match_in_the_given_documents(spark):
    for row in tables.read(spark, "/root/testdata/sf0.01", "documents").select("text").collect():
        joined = b" ".join((row["text"] or "").encode().translate(licenses._WORDS).split())
        assert sorted(licenses.detections(joined)) == ungated(joined)


@pytest.mark.parametrize("text, labels", [
    ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
     "WARRANTIES", "bsd-disclaimer"), ("SPDX-License-Identifier: BSL-1.0", "boost-1"),
    ("Internet Systems Consortium License", "isc"), ("Q Public License", "qpl"), ("OpenRAIL and Open RAIL", "openrail-m"),
    ("distributed under the Expat License", "mit"), ("3-clause license", "bsd-3"), ("see the license", "unknown"),
    ("Unauthorised copying of this file is strictly prohibited", "proprietary"), ("unter MIT-Lizenz", "mit"),
])
def test_labels_without_the_common_keyword(text, labels):
    assert licenses.scan(text.encode())[5] == labels


def test_suppression_by_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        found = [(a, a + rng.randrange(1, 9), rng.randrange(5), k, "x")
                 for k, a in enumerate(rng.choices(range(12), k=rng.randrange(9)))]
        assert sorted(licenses.unsuppressed(found)) == brute_rest(found)


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3-plus"), ("CC BY-NC 4.0", "cc-by-nc"), ("cc by nc sa", "cc-by-nc,cc-by-nc-sa"),
    ("GNU Lesser General Public License v2.1", "lgpl-2-1"), ("see the limits of the mitten", ""),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Todos los derechos reservados", "all-rights-reserved"), ("", ""), (None, ""),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\")", "mit"),
])
def test_labels(text, labels):
    assert licenses.scan((text or "").encode())[5] == labels


def test_phrases_count_all_places():
    text = ("under the mit license " * 3 + "cc by nc " * 2).encode()
    assert licenses.scan(text)[:5] == (18, 5, 0, 15, "cc-by-nc,mit")


def test_special_cases(odd, nothing):
    rows = licenses.scan_all(odd).collect()
    assert len(rows) == 10
    for r in rows:
        if r["doc_id"] in (1, 2, 4):
            assert (r["n_words"], r["n_base"], r["first_word"], r["base_labels"], r["labels"], r["score"]) == (
                0, 0, None, "", "", 0.0)
    assert licenses.scan_all(nothing).count() == 0
    long = b"under the mit license and more " * 30_000
    assert licenses.scan(long)[1] == 30_000
    spans = licenses.spans(odd.sparkSession.createDataFrame([(1, "x y Released under the MIT License")], "doc_id long, text string"))
    assert [tuple(r) for r in spans.collect()] == [(1, 2, 5, "notice", "mit")]
