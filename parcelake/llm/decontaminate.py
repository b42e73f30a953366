"""Passages of benchmark items in documents, also edited ones.

1. Seeds: the pairs of item words one or two apart, found in a document one or two apart. How many
   documents hold each is counted over all documents, and an item leaves out its commonest places.
2. A document with enough seeds is aligned with the item around them (Smith-Waterman over words:
   match 2, mismatch -1, gap -1). The score is the alignment's over that of the whole item. A hit has
   `SCORE`, or the points of `LONG` matched words: a long passage of a still longer item.

No alignment of the wanted score is missed. Between two matches that follow each other and are more
than two apart in either text stand two edits or more, which undo a match. So an alignment of p points
has pairs of weight p - 2 (2 if next to each other in both texts, else 1), at most one of them at
each place of the item, and their shifts differ by its gaps, at most 2 * item words - p. Places of
half that weight at most are left out, and as much less is asked for (`needed`).

Items are taken in blocks of `BLOCK_BYTES` of text; each block meets all documents in one pass.

Results in special cases: a null or empty text has no hits; an item without words has none; items
of equal text are hit together; an item of two words needs both, at most two apart; a null doc_id or
item_id is carried on; repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from parcelake.llm import shingles, tables

APART = 2
BLOCK_BYTES = 4 << 20
MATCH, OTHER, GAP = 2, -1, -1
SCORE = 0.4
LONG = 30           # matched words: an alignment with their score is a hit in an item of any length
HITS = "doc_id long, item_id long, score double, first_word long, last_word long"


def points(n: int, least: float) -> float:
    """Score of alignment wanted of an item of n words."""
    return MATCH * min(n * least, LONG)


class Seeds:
    """Seeds of one block of items; a seed is looked up by the numbers of its two words."""

    def __init__(self, items: list[tuple[int | None, str | None]], least: float = SCORE):
        self.numbers: dict[bytes, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        for item_id, text in items:
            found = shingles.words(text)
            if found:
                self.items.append((item_id, np.array(
                    [self.numbers.setdefault(w, len(self.numbers) + 1) for w in found])))
        self.size = len(self.numbers) + 1
        self.least = least
        self.needed = np.array([max(1.0, points(len(own), least) - MATCH - 1e-9) for _, own in self.items])
        self.single = any(len(own) == 1 for _, own in self.items)
        places = [np.zeros((4, 0), np.int64)]       # key, item, offset, words apart
        for index, (_, own) in enumerate(self.items):
            for apart in range(len(own) > 1, min(APART, len(own) - 1) + 1):
                n = len(own) - apart
                key = own[:n] * self.size + (own[apart:] if apart else 0)
                places.append(np.stack([key, np.full(n, index), np.arange(n), np.full(n, apart)]))
        self.place(np.concatenate(places, 1))

    def place(self, places: np.ndarray) -> None:
        """Sorted seeds, and the places in items of each."""
        self.places = places[:, np.argsort(places[0], kind="stable")]
        self.sorted, self.starts, self.counts = np.unique(self.places[0], return_index=True, return_counts=True)

    def number(self, text: str | None) -> np.ndarray:
        """Numbers of a text's words; 0 if no item has the word."""
        found = shingles.words(text)
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in found), np.int64, len(found))

    def found(self, own: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(words apart, numbers of seeds, their positions) in a document."""
        out = []
        known = own > 0
        if not len(self.sorted) or not known.any():
            return out
        for apart in range(not self.single, APART + 1):
            n = max(0, len(own) - apart)
            at = np.flatnonzero(known[:n] & known[apart:])
            key = own[at] * self.size
            if apart:
                key += own[at + apart]
            seed = np.searchsorted(self.sorted, key)
            seed[seed == len(self.sorted)] = 0
            hit = self.sorted[seed] == key
            out.append((apart, seed[hit], at[hit]))
        return out

    def keep_rare(self, documents: dict[int, int]) -> None:
        """Leave out of each item its commonest places by the number of documents."""
        common = np.array([documents.get(k, 0) for k in self.places[0].tolist()], np.int64)
        ends = np.cumsum([len(own) for _, own in self.items])
        begins = ends - [len(own) for _, own in self.items]
        spots = begins[self.places[1]] + self.places[2] if len(ends) else self.places[1]
        by_spot = np.bincount(spots, common, ends[-1] if len(ends) else 0)
        for index, (_, own) in enumerate(self.items):
            left_out = int(self.needed[index] // (2 * MATCH))
            mine = by_spot[begins[index]:ends[index] - 1]
            if left_out:
                most = np.sort(mine)[len(mine) - left_out - 1]
                self.needed[index] -= MATCH * int((mine > most).sum())
                mine[mine > most] = -1
        self.place(self.places[:, by_spot[spots] >= 0])

    def hits(self, text: str | None) -> list[tuple[int | None, float, int, int]]:
        """(item_id, score, first word, last word): the best place of each item in a text."""
        own = self.number(text)
        found = [f for f in self.found(own) if len(f[1])]
        if not found:
            return []
        seed, at = (np.concatenate([f[k] for f in found]) for k in (1, 2))
        apart = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
        count = self.counts[seed]
        row = np.repeat(self.starts[seed] - np.cumsum(count) + count, count) + np.arange(count.sum())
        _, index, offset, inside = self.places[:, row]
        weight = 1 + ((inside == 1) & (np.repeat(apart, count) == 1))
        begin = np.repeat(at, count) - offset
        total = np.bincount(index, weight)
        out = []
        for k in np.flatnonzero(total >= self.needed[:len(total)]).tolist():
            item_id, item = self.items[k]
            mine = index == k
            best_of = np.zeros(len(item), np.int64)
            np.maximum.at(best_of, offset[mine], weight[mine])
            if best_of.sum() < self.needed[k]:
                continue
            best = (0, 0, 0)
            for low, high in self.windows(k, begin[mine], weight[mine]):
                low = max(0, low)
                score, a, b = align(item, own[low:high])
                if score > best[0]:
                    best = (score, low + a, low + b)
            if best[0] * MATCH * len(item) >= points(len(item), self.least) - 1e-9:
                out.append((item_id, *best))
        return out

    def windows(self, index: int, begin: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, int]]:
        """Parts of a document with seeds of the needed weight, wide enough for any wanted alignment."""
        n = len(self.items[index][1])
        slack = max(0, int(MATCH * n - points(n, self.least) + 1e-9))
        order = np.argsort(begin, kind="stable")
        begin, sums = begin[order], np.concatenate([[0], np.cumsum(weight[order])])
        high = np.searchsorted(begin, begin + slack, "right")
        enough = np.flatnonzero(sums[high] - sums[:-1] >= self.needed[index])
        first = last = None
        for low, top in zip(begin[enough].tolist(), begin[high[enough] - 1].tolist()):
            if first is not None and low > last + 2 * slack + n:
                yield first - slack, last + n + slack
                first = None
            first, last = low if first is None else first, top
        if first is not None:
            yield first - slack, last + n + slack


def matrix_best(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the window position where it ends."""
    steps = np.arange(len(window) + 1) * -GAP
    row, best, end = np.zeros(len(window) + 1, np.int64), 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(window == word, MATCH, OTHER))
        row = np.maximum.accumulate(new + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Score (1 for the whole item) and the first and last aligned position of the window."""
    best, end = matrix_best(item, window)
    if not best:
        return 0.0, 0, 0
    length = matrix_best(item[::-1], window[:end][::-1])[1]
    return best / (MATCH * len(item)), end - length, end - 1


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of about `block_bytes`; one block at a time is on the driver."""
    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = chosen.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-total // block_bytes))
    for k in range(count):
        mine = chosen.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield sorted(((r["item_id"], r["text"]) for r in mine.collect()), key=repr)


def rare_seeds(docs: DataFrame, items: list[tuple], least: float) -> Seeds:
    """The seeds of a block, thinned by their document counts over all documents."""
    seeds = Seeds(items, least)

    def step(batch):
        counts = np.zeros(len(seeds.sorted), np.int64)
        for text in batch.column("text").to_pylist():
            found = [seed for _, seed, _ in seeds.found(seeds.number(text))]
            if found:
                counts[np.unique(np.concatenate(found))] += 1
        held = np.flatnonzero(counts)
        return {"key": seeds.sorted[held], "n": counts[held]}

    counted = tables.mapped(docs.select("text"), step, "key long, n long")
    totals = counted.groupBy("key").agg(F.sum("n").alias("n")).collect()
    seeds.keep_rare({r["key"]: r["n"] for r in totals})
    return seeds


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = SCORE) -> DataFrame:
    """One row per document and benchmark item found in it."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for items in blocks(benchmark):
        seeds = rare_seeds(docs, items, least)

        def step(batch, seeds=seeds):
            rows = [(doc, *hit) for doc, text in zip(batch.column("doc_id").to_pylist(),
                                                     batch.column("text").to_pylist())
                    for hit in seeds.hits(text)]
            names = [c.split()[0] for c in HITS.split(", ")]
            return {name: [r[i] for r in rows] for i, name in enumerate(names)}

        found = tables.mapped(chosen, step, HITS)
        out = found if out is None else out.unionByName(found)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: float = SCORE) -> DataFrame:
    """The documents without any benchmark item."""
    for items in blocks(benchmark):
        seeds = rare_seeds(docs, items, least)
        docs = tables.kept(docs, lambda batch, seeds=seeds: [
            not seeds.hits(text) for text in batch.column("text").to_pylist()])
    return docs
