"""How far the sources of a language differ in their words, copies of a text being read once.

1. Collapse: equal texts of a language become one row with the number of its copies per source. The
   digests are counted; the text itself is shuffled once, reduced to one copy per input split first.
2. Terms: every remaining text is tokenized once. Its counts, times the copies, are added up per
   (language, source, term) in the task, as are the documents that hold the term.
3. Audit: a term is kept if enough documents of its language hold it. A source's probability of a
   kept term is a whole number (see `share`). Two sources are compared by the sum of differences
   over all kept terms; only terms that occur in one of them are looked at, in blocks of terms and
   tiles of sources, and the terms of neither, which all differ by the same, are added by number.

Results in special cases: null text, language and source count as empty strings; a text without a
term counts as a document and its source as a group; a language without kept terms has pairs of
value 0 and no terms; an empty table gives no rows; repeated rows are copies like any others; equal
values are ranked by the item in UTF-8 order; other columns are not read. Sums hold up to 2 ** 53
words per language.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelake.llm import tables

LEAST_DOCS = 30
TOP_TERMS = 50
SCALE_STEPS = 3             # probabilities are scaled by 1000 to this power
SMOOTHING = 5
SOURCES_AT_ONCE = 1024      # sources of a text taken in one row, about
TILE = 256                  # sources compared with each other at once
BLOCK_ROWS = 200_000        # counts of a language compared at once, about
HELD_TERMS = 2_000_000      # counts a task holds before it passes them on
EXPANDED_ROWS = 1_000_000   # counts of copies added at once
PIECE_BYTES = 1 << 20       # bytes of a text split into words at once

# Fixed: ASCII without letters separates words, A-Z become a-z, everything else is part of a word.
_FOLD = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32
              for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_PAIRS = "lang string, a int, b int, value long, seen long"


# --- 1. collapse -------------------------------------------------------------------------

def collapsed(docs: DataFrame, sources: int) -> DataFrame:
    """lang, text, copies: one row per different text of a language, copies as (source, n).

    With more than SOURCES_AT_ONCE sources in all a text may come in several rows, each with
    other sources, so that no row holds an unbounded list.
    """
    known = (docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
             .withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))))
    part = F.pmod(F.xxhash64("source"), F.lit(-(-sources // SOURCES_AT_ONCE)))
    copies = (known.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
              .groupBy("lang", "digest", part.alias("_part"))
              .agg(F.collect_list(F.struct("source", "n")).alias("copies")))
    texts = known.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies")


# --- 2. terms ----------------------------------------------------------------------------

def pieces(folded: bytes, limit: int = PIECE_BYTES):
    """The words of a folded text, a bounded number of bytes at a time (or one word)."""
    at = 0
    while at < len(folded):
        end = at + limit
        if end < len(folded):
            cut = folded.rfind(b" ", at, end)
            cut = folded.find(b" ", end) if cut < 0 else cut
            end = len(folded) if cut < 0 else cut
        yield folded[at:end].split()
        at = end + 1


class _Totals:
    """Counts of terms and of documents with them, per (language, source).

    Terms and groups are numbered in the task; a count is kept under group << 32 | term.
    """

    def __init__(self):
        self.terms: dict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.n, self.docs = (np.zeros(0, np.int64) for _ in range(3))
        self.new: list[tuple[np.ndarray, ...]] = []

    def add(self, langs: list[str], texts: list[bytes], copies: list[list[dict]]) -> None:
        found, sizes = [np.zeros(0, np.int64)], []
        for text in texts:
            numbers = [np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))
                       for words in pieces(text.translate(_FOLD))]
            found += numbers
            sizes.append(sum(map(len, numbers)))
        key = np.repeat(np.arange(len(texts)) << 32, sizes) | np.concatenate(found)
        key, n = np.unique(key, return_counts=True)
        doc, term = key >> 32, key & 0xFFFFFFFF

        listed = [len(c) for c in copies]
        first = np.concatenate([[0], np.cumsum(listed)])
        group = np.array([self.groups.setdefault((lang, c["source"]), len(self.groups))
                          for lang, some in zip(langs, copies) for c in some], np.int64)
        times = np.array([c["n"] for some in copies for c in some], np.int64)
        rows = np.concatenate([[0], np.cumsum(np.asarray(listed, np.int64)[doc])])
        start = 0
        while start < len(key):         # one row per copy, a bounded number of them at a time
            end = max(start + 1, int(np.searchsorted(rows, rows[start] + EXPANDED_ROWS, "right")) - 1)
            row = np.repeat(np.arange(start, end), np.diff(rows[start:end + 1]))
            copy = first[doc[row]] + np.arange(rows[start], rows[end]) - rows[row]
            self._merge(group[copy] << 32 | term[row], n[row] * times[copy], times[copy])
            start = end

    def _merge(self, *counted: np.ndarray) -> None:
        self.new.append(counted)
        if sum(len(keys) for keys, *_ in self.new) > max(len(self.keys), EXPANDED_ROWS):
            self.settle()

    def settle(self) -> None:
        """Add up what has come in since the last time."""
        keys, n, docs = (np.concatenate(c) for c in zip((self.keys, self.n, self.docs), *self.new))
        self.new = []
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        self.keys = keys[starts]
        self.n, self.docs = (np.add.reduceat(c[order], starts) if len(starts) else c for c in (n, docs))

    def full(self) -> bool:
        return max(len(self.keys), len(self.terms)) > HELD_TERMS

    def batches(self, target: pa.Schema, rows: int = 50_000):
        self.settle()
        names = pa.array(list(self.terms), pa.binary())
        langs, sources = (pa.array([g[i] for g in self.groups], pa.string()) for i in (0, 1))
        for at in range(0, len(self.keys), rows):
            part = slice(at, at + rows)
            group = pa.array(self.keys[part] >> 32)
            yield tables.as_batch({
                "lang": langs.take(group), "source": sources.take(group),
                "term": names.take(pa.array(self.keys[part] & 0xFFFFFFFF)).cast(pa.string()),
                "n": self.n[part], "docs": self.docs[part]}, target)


def counts(texts: DataFrame) -> DataFrame:
    """n and docs of every term in every (lang, source)."""
    target = tables.arrow_schema(_COUNTS)

    def run(batches):
        totals = _Totals()
        for part in tables.slices(batches):
            totals.add(part.column("lang").to_pylist(), tables.raw(part.column("text")),
                       part.column("copies").to_pylist())
            if totals.full():
                yield from totals.batches(target)
                totals = _Totals()
        yield from totals.batches(target)

    return (tables.map_arrow(texts, run, _COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


# --- 3. audit ----------------------------------------------------------------------------

def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(10 ** 9 * (count + 5) / (total + 5 * vocabulary)), by long division in longs."""
    rest, below = count + SMOOTHING, total + SMOOTHING * vocabulary
    below = F.when(below > 0, below).otherwise(F.lit(1))
    result = F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        result = result * 1000 + F.call_function("div", rest, below)
        rest = rest % below
    return result + 1


def _distances(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums of differences of all pairs of a tile over the terms of a block.

    `left`: lang, source number, term number and p of the terms that occur; `right`: lang, number
    and p of a term that does not occur (`base`) of every source of the tile.
    """
    right = right.sort_values("number")
    numbers, base = right["number"].to_numpy(), right["base"].to_numpy()
    low, high = int(right["low"].iloc[0]), int(right["high"].iloc[0])
    total = np.zeros((len(numbers), len(numbers)), np.int64)
    place = np.searchsorted(numbers, left["number"].to_numpy())
    _, column = np.unique(left["term"].to_numpy(), return_inverse=True)
    order = np.argsort(column, kind="stable")
    place, column, p = place[order], column[order], left["p"].to_numpy()[order]
    seen = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, seen, TILE):
        start, end = np.searchsorted(column, [first, first + TILE])
        table = np.repeat(base[:, None], min(TILE, seen - first), axis=1)
        table[place[start:end], column[start:end] - first] = p[start:end]
        for i, row in enumerate(table):
            total[i] += np.abs(table - row).sum(axis=1)
    first, second = numbers // TILE == low, numbers // TILE == high
    a, b = np.nonzero(first[:, None] & second[None, :] & (numbers[:, None] < numbers[None, :]))
    return pd.DataFrame({"lang": right["lang"].iloc[0], "a": numbers[a], "b": numbers[b],
                         "value": total[a, b], "seen": seen})


def _tiles(number: Column, tiles: Column) -> Column:
    """The tiles a source takes part in: (low, high) with each tile of its language."""
    own = F.floor(number / TILE).cast("int")
    return F.transform(F.sequence(F.lit(0), tiles - 1), lambda other: F.struct(
        F.least(own, other).alias("low"), F.greatest(own, other).alias("high")))


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language, both ways round.

    `kept`: lang, number (of the source), term_id, p, tiles and blocks; `groups`: lang, source, number,
    base, vocabulary, tiles and blocks, the last two being those of the language.
    """
    key = ["lang", "block", "low", "high"]
    left = (kept.withColumn("tile", F.explode(_tiles(F.col("number"), F.col("tiles"))))
            .select("lang", F.pmod(F.xxhash64("term_id"), F.col("blocks")).cast("int").alias("block"),
                    "tile.*", "number", F.col("term_id").alias("term"), "p"))
    right = (groups.withColumn("tile", F.explode(_tiles(F.col("number"), F.col("tiles"))))
             .withColumn("block", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
             .select("block", "tile.*", *[F.col(c).alias(c) for c in ("lang", "number", "base")]))
    sums = (left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_distances, _PAIRS)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")))

    def side(name: str) -> DataFrame:
        return groups.select("lang", F.col("number").alias(name), F.col("source").alias(f"{name}_source"),
                             F.col("base").alias(f"{name}_base"), F.col("vocabulary").alias(f"{name}_v"))

    unseen = (F.col("a_v") - F.col("seen")) * F.abs(F.col("a_base") - F.col("b_base"))
    value = F.when(F.col("a_v") == 0, 0).otherwise(F.col("value") + unseen)
    both = sums.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"]).select(
        "lang", F.col("a_source").alias("s"), F.col("b_source").alias("t"), value.alias("value"))
    ways = F.explode(F.array(F.struct(F.col("s").alias("source"), F.col("t").alias("item")),
                             F.struct(F.col("t").alias("source"), F.col("s").alias("item"))))
    return both.select("lang", ways.alias("way"), "value").select("lang", "way.*", "value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources, and each source's own terms."""
    plain = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")])
    occurring = tables.materialise(plain.distinct(), "divergence-groups")
    sources = max(1, occurring.select("source").distinct().count())
    found = tables.materialise(counts(collapsed(docs, sources)), "divergence-counts")

    vocabulary = tables.materialise(
        found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")),
        "divergence-vocabulary")
    sparse = tables.materialise(found.join(vocabulary, ["lang", "term"]).select(
        "lang", "source", "term", "term_id", "n", "lang_n"), "divergence-kept")

    per_source = sparse.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    per_lang = (vocabulary.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
                .join(per_source.groupBy("lang").agg(F.ceil(F.sum("rows") / BLOCK_ROWS).alias("blocks")), "lang"))
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = (occurring.withColumn("number", F.row_number().over(numbered) - 1)
              .withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
              .join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
              .fillna(0, ["total", "rows", "vocabulary", "lang_total"]).fillna(1, ["blocks"]))
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    base = share(F.lit(0).cast("long"), F.col("total"), F.col("vocabulary"))
    groups = tables.materialise(groups.withColumn("tiles", tiles).withColumn("base", base),
                                "divergence-sources")

    kept = sparse.join(groups.select("lang", "source", "number", "total", "vocabulary", "lang_total",
                                     "tiles", "blocks"), ["lang", "source"])
    kept = kept.withColumn("p", share(F.col("n"), F.col("total"), F.col("vocabulary")))
    pairs = pair_values(kept, groups).withColumn("part", F.lit("pair"))
    whole = share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"))
    own = (kept.withColumn("value", F.col("p") - whole).where(F.col("value") > 0)
           .select("lang", "source", F.col("term").alias("item"), "value", F.lit("term").alias("part")))

    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("rank", F.row_number().over(by)).select(*columns).unionByName(
        own.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top_terms).select(*columns)))


#: The same by the dense table of all sources and kept terms, for DuckDB.
ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source
    FROM documents),
words AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs),
kept AS (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term)
    GROUP BY lang, source, term),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n
    FROM groups g JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term)),
per_source AS (
    SELECT lang, source, term, n,
           1 + (1000000000 * (n + 5)::HUGEINT)
               // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
    FROM dense),
lang_counts AS (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term),
per_lang AS (
    SELECT lang, term,
           1 + (1000000000 * (n + 5)::HUGEINT)
               // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
    FROM lang_counts),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           coalesce((SELECT sum(abs(x.p - y.p)) FROM per_source x JOIN per_source y USING (lang, term)
                     WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
own AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value
    FROM per_source JOIN per_lang USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
