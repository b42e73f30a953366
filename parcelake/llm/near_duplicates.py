"""Join of documents whose five-word shingle sets have a Jaccard similarity of 0.8 or more.

1. Documents of equal shingle set are one text class; from here on there are classes only.
2. MinHash bands: band and row counts are chosen for the target recall at the threshold. The
   classes are shuffled on band hashes, and each class is linked to the smallest of its bucket
   (not to all of it). Components of these links hold every pair that shares a band.
3. Components are cut into blocks of about `BLOCK` classes, and every pair of blocks is one tile.
   A tile compares all its pairs by their full shingle sets with matrix products and emits, per
   class, its number of links and the smallest class it hangs together with: no pair becomes a row.
4. Components of the verified links are the groups.

Results in special cases: a null or empty text or one without words has no links and is its own
group; shorter texts have one shingle of all their words; repeated rows count as copies; a null
doc_id is carried on, and a group's class_id is its smallest doc_id that is not null.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from parcelake.llm import components, shingles, tables

SIMILARITY = 0.8
RECALL = 0.9995
HASHES = 200            # most MinHash values of a text
BLOCK = 768             # classes in a block
_CELLS = 8 << 20        # cells of the incidence matrix held at a time

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(similarity: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, that reach the recall."""
    best = None
    for rows in range(1, hashes + 1):
        share = similarity ** rows
        bands = 1 if share >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-share))
        if bands * rows > hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no banding of so few hashes reaches this recall")
    return best


@dataclass
class Sketcher:
    bands: int
    rows: int

    def __post_init__(self):
        rng = np.random.default_rng(20240229)
        n = self.bands * self.rows
        self.flip = rng.integers(0, 1 << 32, (n, 1), np.uint32)
        self.factor = rng.integers(0, 1 << 32, (n, 1), np.uint32) | np.uint32(1)

    def band_hashes(self, own: np.ndarray) -> np.ndarray:
        """One 64-bit hash per band of a shingle set that is not empty."""
        low = own.astype(np.uint32)
        least = np.full(len(self.flip), np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(low), 4096):
            mixed = low[at:at + 4096] ^ self.flip
            mixed *= self.factor
            np.minimum(least, mixed.min(axis=1), out=least)
        value = np.arange(1, self.bands + 1, dtype=np.uint64) * _FACTOR
        for column in least.reshape(self.bands, self.rows).T:
            value = (value ^ column) * _FACTOR
            value ^= value >> np.uint64(29)
        return value.view(np.int64)


def set_id(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes that together name a row's content."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("doc_id", "text").alias("row_key"),
                       F.xxhash64("text").alias("text_key"))


def sketch(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Per row: its keys, the id of its shingle set (null without words), size and band hashes."""
    sketcher = Sketcher(bands, rows)

    def step(batch):
        sets = [shingles.shingle_set(t) for t in batch.column("text").to_pylist()]
        return ({n: batch.column(n) for n in ("doc_id", "row_key", "text_key")}
                | {"set_id": [set_id(s) if len(s) else None for s in sets],
                   "n_shingles": [len(s) for s in sets],
                   "bands": [sketcher.band_hashes(s) if len(s) else [] for s in sets]})

    return tables.mapped(keyed(docs), step, "doc_id long, row_key long, text_key long, "
                         "set_id binary, n_shingles long, bands array<long>")


def compare(sets: list[np.ndarray], copies: np.ndarray, n_left: int,
            similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked documents of each set and the first set it hangs together with.

    If `n_left` is not zero, only the pairs between the first `n_left` sets and the others count:
    other tiles have those within a side.
    """
    n, head, tail = len(sets), slice(0, n_left or len(sets)), slice(n_left, len(sets))
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    begins = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    counts = np.diff(np.append(begins, len(flat)))
    column = np.repeat(np.cumsum(counts > 1) - 1, counts)
    shared = np.repeat(counts > 1, counts)
    column, owner = column[shared], owner[shared]
    common = np.zeros((head.stop, n - n_left), np.float32)
    width = max(1, _CELLS // n)
    top = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, top, width):
        low, high = np.searchsorted(column, (at, at + width))
        part = np.zeros((n, min(width, top - at)), np.float32)
        part[owner[low:high], column[low:high] - at] = 1
        common += part[head] @ part[tail].T
    union = sizes[head, None] + sizes[None, tail] - common
    found = common >= similarity * union - 1e-6
    linked = np.zeros((n, n), bool)
    linked[head, tail] = found
    if n_left:
        linked[tail, head] = found.T
    np.fill_diagonal(linked, False)
    links = linked @ copies
    root = np.arange(n)
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], n).min(axis=1))
        new = new[new]
        if (new == root).all():
            return links, root
        root = new


def verify(tiles: DataFrame, similarity: float) -> DataFrame:
    """set_id, root, links, blocks of each set of each tile; the rows come sorted by tile."""
    schema = "set_id binary, root binary, links long, blocks int"
    tile = ("component", "low", "high")

    target = tables.arrow_schema(schema)

    def finish(rows: list[tuple], within: bool):
        """`within`: the tile is of one block. A block of a pair may be empty."""
        rows.sort(key=lambda r: (not r[2], r[0]))
        ids, n_left = [r[0] for r in rows], sum(r[2] for r in rows)
        if within or 0 < n_left < len(rows):
            links, root = compare([r[3] for r in rows], np.array([r[1] for r in rows], np.int64),
                                  0 if within else n_left, similarity)
        else:
            links, root = np.zeros(len(rows), np.int64), range(len(rows))
        return tables.as_batch({"set_id": ids, "root": [ids[i] for i in root], "links": links,
                                "blocks": [r[4] for r in rows]}, target)

    def run(batches):
        now, rows = None, []
        for batch in batches:
            column = batch.column("shingles")
            values = column.flatten().to_numpy().view(np.uint64)
            offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
            fields = [batch.column(c).to_pylist() for c in (*tile, "set_id", "copies", "block", "blocks")]
            for i, (a, low, high, own, copies, block, blocks) in enumerate(zip(*fields)):
                if (a, low, high) != now:
                    if rows:
                        yield finish(rows, now[1] == now[2])
                    now, rows = (a, low, high), []
                rows.append((own, copies, block == low, values[offsets[i]:offsets[i + 1]].copy(), blocks))
        if rows:
            yield finish(rows, now[1] == now[2])

    sorted_tiles = (tiles.repartition(*tile).sortWithinPartitions(*tile)
                    .select(*tile, "set_id", "copies", "block", "blocks", "shingles"))
    return tables.map_arrow(sorted_tiles, run, schema)


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL
            ) -> tuple[DataFrame, DataFrame]:
    """The sketch of all rows, and of each shingle set its first row, group and links.

    The second table has set_id, copies, first (doc_id, row_key, text_key), class_first (the first
    row of the group) and links (linked documents of other sets).
    """
    drawn = tables.materialise(sketch(docs, *choose_bands(similarity, recall)), "sketch")
    sets = tables.materialise(
        drawn.filter(F.col("set_id").isNotNull()).groupBy("set_id")
        .agg(F.count("*").alias("copies"), F.any_value("bands").alias("bands"),
             F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key", "text_key"))
             .alias("first"))
        .withColumn("node", F.xxhash64("set_id")), "sets")

    banded = sets.select("node", F.explode("bands").alias("band"))
    heads = (banded.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("tail"))
             .filter(F.col("head") < F.col("tail")).select("band", "head"))
    found = components.stars(banded.join(heads, "band").select(
        F.col("node").alias("a"), F.col("head").alias("b")))
    roots = found.select("root").distinct().select(F.col("root").alias("node"), "root")
    member = found.unionByName(roots).withColumnRenamed("root", "component")
    sized = member.groupBy("component").agg(F.count("*").alias("n")).select(
        "component", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    wanted = tables.materialise(
        sets.join(member, "node").join(sized, "component")
        .select("set_id", "copies", "component", "blocks", "first.row_key", "first.text_key",
                F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("block")), "wanted")

    texts = keyed(docs).join(tables.small(wanted.select("row_key", "text_key"), 64),
                             ["row_key", "text_key"], "left_semi")

    def cut(batch):
        own = [shingles.shingle_set(t) for t in batch.column("text").to_pylist()]
        return {"set_id": [set_id(s) for s in own], "shingles": [s.view(np.int64) for s in own]}

    full = (tables.mapped(texts, cut, "set_id binary, shingles array<long>")
            .groupBy("set_id").agg(F.any_value("shingles").alias("shingles")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = (wanted.join(full, "set_id").select("*", other)
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    checked = tables.materialise(verify(tiles, similarity), "checked")

    across = components.stars(checked.filter("blocks > 1").select(
        F.col("set_id").alias("a"), F.col("root").alias("b")))
    linked = (checked.groupBy("set_id").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
              .filter("links > 0")
              .join(across.select(F.col("node").alias("set_id"), F.col("root").alias("across")),
                    "set_id", "left")
              .select("set_id", "links", F.coalesce("across", "root").alias("root")))
    named = linked.join(sets.select("set_id", "first"), "set_id")
    groups = named.groupBy("root").agg(F.min("first").alias("class_first"))
    joined = tables.materialise(named.join(groups, "root").select("set_id", "links", "class_first"), "linked")
    # written, so that the join of all rows with it meets two plain shuffles, which Spark can split
    result = sets.select("set_id", "copies", "first").join(joined, "set_id", "left").select(
        "set_id", "copies", "first", F.coalesce("class_first", "first").alias("class_first"),
        F.coalesce("links", F.lit(0)).alias("links"))
    return drawn, tables.materialise(result, "classes")


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Per row of `docs`: doc_id, class_id (the smallest doc_id of its group), n_copies (rows of
    the same shingle set, itself included), n_links (other rows at `similarity` or more, copies
    included) and n_shingles."""
    drawn, found = classes(docs, similarity, recall)
    return (drawn.select("doc_id", "set_id", "n_shingles").join(found, "set_id", "left")
            .select("doc_id", F.coalesce("class_first.doc_id", "doc_id").alias("class_id"),
                    F.coalesce("copies", F.lit(1)).alias("n_copies"),
                    F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
                    "n_shingles"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row of each group: that with the smallest doc_id. Rows without words all stay."""
    drawn, found = classes(docs, similarity, recall)
    row = ["row_key", "text_key"]
    keepers = found.filter(F.col("first") == F.col("class_first")).select("first.row_key", "first.text_key")
    wordless = drawn.filter(F.col("set_id").isNull()).select(*row)
    stay = tables.materialise(keepers.unionByName(wordless).distinct(), "stay")
    left = docs.join(tables.small(stay, 64), same_row(docs, stay), "left_semi")
    again = tables.materialise(
        drawn.filter(F.col("set_id").isNotNull()).groupBy(*row).agg(F.count("*").alias("n"))
        .filter("n > 1").select(*row), "again")
    if again.isEmpty():
        return left
    # rows repeated as they are: one of each
    return (left.join(again, same_row(left, again), "left_anti").unionByName(
        left.join(again, same_row(left, again), "left_semi").dropDuplicates(["doc_id", "text"])))


def same_row(docs: DataFrame, keys: DataFrame):
    return ((F.xxhash64(docs["doc_id"].cast("long"), docs["text"]) == keys["row_key"])
            & (F.xxhash64(docs["text"]) == keys["text_key"]))
