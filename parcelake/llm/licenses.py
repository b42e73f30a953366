"""Licence scan: ordered signature rules over the words of a text.

A-Z are lower-cased and the words joined by one blank. Keywords gate the rules; the matches of the
rules left are detections, word intervals with a class. A detection inside another one of a
higher or the same class is suppressed (of equal intervals the first rule stays); the labels of the
others are the text's. Fixed phrases are reported beside that, all places of them.

Results in special cases: a null or empty text has no words, null places, empty label strings and
score 0; repeated rows are scanned one by one; a null doc_id is carried on.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, functions as F

from parcelake.llm import tables
from parcelake.llm.license_rules import RULES

#: phrase -> label, found wherever its words stand together
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2",
           "cc by nc": "cc-by-nc"}
#: classes, from the most to the least telling, and how far each is to be believed
CLASSES = {"text": 0.95, "notice": 0.9, "tag": 0.85, "name": 0.75, "mention": 0.4}
_RANK = {name: rank for rank, name in enumerate(CLASSES)}

_WORDS = bytes(c + 32 if 65 <= c <= 90 else
               c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@cache
def rules() -> list[tuple[tuple[bytes, ...], list[tuple[int, int, str, re.Pattern]]]]:
    """Keywords, one of which every match contains, and their rules (rank, number, label, pattern)."""
    groups, number = {}, 0
    for line in RULES.strip().splitlines():
        if line.startswith("["):
            group = groups.setdefault(tuple(line[1:-1].encode().split(b"|")), [])
            continue
        kind, label, pattern = line.split(" ", 2)
        number += 1
        group.append((_RANK[kind], number, label, re.compile(
            rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())))
    return list(groups.items())


def detections(joined: bytes) -> list[tuple[int, int, int, int, str]]:
    """(start, end, rank, rule, label) of every match, in bytes."""
    found = []
    for keywords, group in rules():
        if any(k in joined for k in keywords):
            for rank, number, label, pattern in group:
                found += [(m.start(), m.end(), rank, number, label) for m in pattern.finditer(joined)]
    return found


def unsuppressed(found: list[tuple[int, int, int, int, str]]) -> list[tuple[int, int, int, int, str]]:
    """Detections that lie in no other one of their class or a more telling one."""
    out, ends = [], [-1] * len(CLASSES)
    for item in sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3])):
        end, rank = item[1], item[2]
        if max(ends[:rank + 1]) < end:
            out.append(item)
        ends[rank] = max(ends[rank], end)
    return out


def places(words: list[bytes], joined: bytes) -> list[tuple[int, str]]:
    """Word position and label of every place of every phrase."""
    found = []
    for phrase, label in PHRASES.items():
        first, *rest = own = phrase.encode().split()
        if phrase.encode() in joined:
            at = -1
            while True:
                try:
                    at = words.index(first, at + 1)
                except ValueError:
                    break
                if words[at:at + len(own)] == own:
                    found.append((at, label))
    return sorted(found)


def scan(text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections."""
    words = text.translate(_WORDS).split()
    joined = b" ".join(words)
    base = places(words, joined)
    own = unsuppressed(detections(joined))
    labels = {label for _, label in base}
    return (len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted(labels)), ",".join(sorted(labels | {d[4] for d in own})),
            max([0.0, *(list(CLASSES.values())[d[2]] for d in own)]), len(own))


FIELDS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, n_detections long")


def scan_all(docs: DataFrame) -> DataFrame:
    """FIELDS of every document."""
    names = [c.split()[0] for c in FIELDS.split(", ")][1:]

    def step(batch):
        found = [scan(t) for t in tables.raw(batch.column("text"))]
        return {"doc_id": batch.column("doc_id")} | {
            name: [row[i] for row in found] for i, name in enumerate(names)}

    return tables.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), step, FIELDS)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, kind, label of every detection that stands."""
    kinds = list(CLASSES)

    def step(batch):
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), tables.raw(batch.column("text"))):
            joined = b" ".join(text.translate(_WORDS).split())
            rows += [(doc, joined.count(b" ", 0, a), joined.count(b" ", a, b) + 1, kinds[rank], label)
                     for a, b, rank, _, label in unsuppressed(detections(joined))]
        return {name: [r[i] for r in rows]
                for i, name in enumerate(("doc_id", "first_word", "n_words", "kind", "label"))}

    return tables.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), step,
                         "doc_id long, first_word long, n_words long, kind string, label string")
