"""Hard negatives by coordinate pruning over length buckets (the LEMP scheme for inner products).

Vectors are grouped by label, sorted by length and cut into buckets of one label and similar
length. A bucket keeps one sorted list per coordinate of its unit vectors. For an anchor `q` that
needs a score of `t` or more:

* a bucket whose longest vector cannot reach `t` is left out;
* otherwise the angle between `q` and a wanted vector is at most `acos(t / (|q| * longest))`. For
  each focus coordinate of `q` (those in which `q` is largest) that leaves a range of feasible
  values: a run of the sorted list. The runs are intersected, shortest first;
* what is left is scored exactly, in integers. Where the shortest run holds most of a bucket, the
  whole bucket is scored at once instead: a matrix product costs less than an intersection.

`t` is the anchor's worst score among the best found so far in the task, so it rises bucket by
bucket. Buckets never leave their task: a task keeps the best `k` of every anchor and emits those; a
window over them gives the best of all tasks. Anchors come in blocks of a bounded number of bytes,
each held against all rows; the index of buckets is written once and read by every block.

Results in special cases: rows without id, label or vector, or with a null, NaN or infinite
component take no part; a vector that is shorter than another counts as filled up with zeros; an
empty vector scores 0 with everything; equal scores are settled by the smaller id. Other rows of an
anchor are those of another id; a repeated row is a row of its own, as an anchor too. Scores are
exact integers; beyond 64 bits they are held at the largest long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelake.llm import tables
from parcelake.sizing import FILE_BYTES_PER_PARTITION, UNKNOWN_BYTES, estimated_bytes

BUCKET_ROWS = 2048
LEAST_LENGTH = 0.9          # shortest to longest vector of a bucket
FOCUS = 4                   # focus coordinates of an anchor
DENSE_SHARE = 0.25          # a run over more of its bucket than this is not worth intersecting
ANCHOR_BYTES = 8 << 20      # components of the anchors of a block
DENSE_ANCHORS = 512         # anchors scored at once against a whole bucket
EXACT = float(1 << 52)      # sums below this are exact in doubles
LOW, HIGH = -(1 << 63), (1 << 63) - 1

INDEX = "vec_id long, label long, length double, v array<double>"
FOUND = "anchor_key long, slot int, found_id long, score long"
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


# --- index -------------------------------------------------------------------------------

def whole_numbers(rows: DataFrame, scale: int = 256) -> DataFrame:
    """INDEX columns of the rows that take part: components become floor(scale * x)."""
    target = tables.arrow_schema(INDEX)

    def step(batch: pa.RecordBatch) -> dict:
        column = batch.column("embedding")
        sizes = np.diff(column.offsets.to_numpy())
        values = column.flatten()
        bad = values.is_null().to_numpy(zero_copy_only=False)
        numbers = np.floor(float(scale) * values.fill_null(0).to_numpy().astype(np.float64))
        bad |= ~np.isfinite(numbers)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        with np.errstate(over="ignore", invalid="ignore"):
            squares = np.concatenate([[0], np.cumsum(bad)])
            length = np.sqrt(_sums(numbers * numbers, ends))
        good = np.flatnonzero(squares[ends[1:]] == squares[ends[:-1]])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers))
        return {"vec_id": batch.column("vec_id").take(pa.array(good)),
                "label": batch.column("label").take(pa.array(good)),
                "length": length[good], "v": lists.take(pa.array(good)).cast(target.field("v").type)}

    usable = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return tables.mapped(usable, step, INDEX)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[ends[i]:ends[i + 1]]; 0 of nothing."""
    out = np.zeros(len(ends) - 1)
    some = np.flatnonzero(np.diff(ends))
    if len(some):
        out[some] = np.add.reduceat(values, ends[:-1][some])
    return out


def build_index(numbers: DataFrame) -> DataFrame:
    """The rows by label and falling length, dealt out evenly whatever one label holds, on disk."""
    spark = numbers.sparkSession
    size, parts = estimated_bytes(numbers), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size < UNKNOWN_BYTES:
        parts = max(parts, -(-size // FILE_BYTES_PER_PARTITION))
    order = [F.col("label"), F.col("length").desc(), F.col("vec_id")]
    return tables.materialise(
        numbers.repartitionByRange(parts, *order).sortWithinPartitions(*order), "negatives-index")


class Bucket:
    """Rows of one label and similar length, with sorted lists of the coordinates asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.vectors, self.longest = ids, vectors, float(lengths.max())
        self._scale = np.where(lengths > 0, lengths, 1)
        self._lists: dict[int, tuple] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted values of a coordinate, the rows in that order, and each row's place in it."""
        if f not in self._lists:
            values = self.vectors[:, f] / self._scale
            order = np.argsort(values, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            self._lists[f] = values[order], order, place
        return self._lists[f]


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows of `width` doubles, cut or filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fits = at < width
    out[np.repeat(np.arange(len(sizes)), sizes)[fits], at[fits]] = values[fits]
    return out


def buckets(batch: pa.RecordBatch, width: int):
    """(label, Bucket) of the index rows of a batch."""
    if not batch.num_rows:
        return
    labels, ids = batch.column("label").to_numpy(), batch.column("vec_id").to_numpy()
    lengths, vectors = batch.column("length").to_numpy(), matrix(batch.column("v"), width)
    cuts = np.flatnonzero(np.diff(labels)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(labels)]):
        while start < end:
            stop = min(end, start + BUCKET_ROWS)
            short = np.flatnonzero(lengths[start:stop] < LEAST_LENGTH * lengths[start])
            stop = start + int(short[0]) if len(short) else stop
            yield int(labels[start]), Bucket(ids[start:stop], vectors[start:stop], lengths[start:stop])
            start = stop


# --- anchors -----------------------------------------------------------------------------

class Anchors:
    """A block of anchors. `widest` is the number of components that any of them has."""

    def __init__(self, block: pa.Table):
        block = block.combine_chunks()
        self.keys = block.column("anchor_key").to_numpy()
        self.ids, self.labels = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
        self.lengths = block.column("length").to_numpy()
        lists = block.column("v").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0) if lists.num_chunks else pa.array([], block.schema.field("v").type)
        self.widest = max([1, *np.diff(lists.offsets.to_numpy()).tolist()])
        self.vectors = matrix(lists, self.widest)
        unit = self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.angles = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1, 1))

    def scores(self, rows: np.ndarray, bucket: Bucket, chosen=slice(None)) -> np.ndarray:
        """Exact scores of anchors `rows` with the chosen vectors of a bucket."""
        q, p = self.vectors[rows], bucket.vectors[chosen]
        if self.lengths[rows].max(initial=0) * bucket.longest < EXACT:
            return np.rint(q @ p.T).astype(np.int64)
        whole = np.vectorize(int, otypes=[object])
        exact = whole(q) @ whole(p.T)
        return np.clip(exact, LOW, HIGH).astype(np.int64)

    def feasible(self, bucket: Bucket, rows: np.ndarray, least: np.ndarray):
        """(anchors, scores, vectors) of a bucket whose score may be `least` or more.

        `rows` are anchors, `least` their thresholds as doubles, -inf for none. Vectors are given
        as their places in the bucket, the same ones for all anchors of one result.
        """
        reach = self.lengths[rows] * bucket.longest
        slack = 1e-9 * np.abs(least) + 1e-6
        alive = least - slack <= reach
        rows, reach, wanted = rows[alive], reach[alive], (least - slack)[alive]
        if not len(rows):
            return
        prunable = wanted > 0
        cosine = np.where(prunable, np.minimum(wanted, reach) / np.where(reach > 0, reach, 1), -1)
        spread = np.arccos(np.clip(cosine, -1, 1))
        starts, ends = self._runs(bucket, rows, spread)
        widths = ends - starts
        dense = ~prunable | (widths.min(axis=1) > DENSE_SHARE * len(bucket.ids))
        whole = rows[dense]
        for at in range(0, len(whole), DENSE_ANCHORS):
            part = whole[at:at + DENSE_ANCHORS]
            yield part, self.scores(part, bucket), None
        order = np.argsort(widths, axis=1, kind="stable")
        for i in np.flatnonzero(~dense):
            first, *others = order[i]
            _, listed, _ = bucket.coordinate(int(self.focus[rows[i], first]))
            left = listed[starts[i, first]:ends[i, first]]
            for j in others:
                _, _, place = bucket.coordinate(int(self.focus[rows[i], j]))
                at = place[left]
                left = left[(at >= starts[i, j]) & (at < ends[i, j])]
            if len(left):
                one = rows[i:i + 1]
                yield one, self.scores(one, bucket, left), left

    def _runs(self, bucket: Bucket, rows: np.ndarray, spread: np.ndarray):
        """Where the feasible values of every focus coordinate begin and end in its list."""
        focus, angles = self.focus[rows], self.angles[rows]
        lowest = np.cos(np.minimum(angles + spread[:, None], np.pi)) - 1e-9
        highest = np.cos(np.maximum(angles - spread[:, None], 0)) + 1e-9
        starts, ends = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            values, _, _ = bucket.coordinate(int(f))
            here = focus == f
            starts[here] = np.searchsorted(values, lowest[here], "left")
            ends[here] = np.searchsorted(values, highest[here], "right")
        return starts, ends


class Best:
    """The best `k` of each slot of each anchor with scores between `low` and `high`."""

    def __init__(self, anchors: Anchors, k: int, low: np.ndarray, high: np.ndarray):
        """`low` and `high` have a row per anchor and a column per slot; low > high: nothing."""
        self.anchors, self.k, self.low, self.high = anchors, k, low, high
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.bar = low.copy()               # what a new score has to reach
        self.open = low <= high

    def least(self, rows: np.ndarray) -> np.ndarray:
        """The score that could still change a slot of each anchor."""
        bars = np.where(self.open[rows], self.bar[rows].astype(np.float64), np.inf)
        return np.where(bars.min(axis=1) <= float(LOW), -np.inf, bars.min(axis=1))

    def add(self, bucket: Bucket, rows: np.ndarray) -> None:
        rows = rows[self.open[rows].any(axis=1)]
        if not len(rows):
            return
        for part, scores, places in self.anchors.feasible(bucket, rows, self.least(rows)):
            ids = bucket.ids if places is None else bucket.ids[places]
            bars = np.where(self.open[part], self.bar[part], HIGH).min(axis=1)
            tops = np.where(self.open[part], self.high[part], LOW).max(axis=1)
            if scores.shape[1] > 4 * self.k and self.low.shape[1] == 1 and (tops == HIGH).all():
                # the anchor itself may be among them: one more than wanted is surely enough
                cut = scores.shape[1] - self.k - 1
                bars = np.maximum(bars, np.partition(scores, cut, axis=1)[:, cut])
            good = (scores >= bars[:, None]) & (scores <= tops[:, None])
            for i in np.flatnonzero(good.any(axis=1)):
                self._merge(int(part[i]), scores[i][good[i]], ids[good[i]])

    def _merge(self, row: int, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.anchors.ids[row]
        scores, ids = scores[other], ids[other]
        for slot in np.flatnonzero(self.open[row]):
            fits = (scores >= self.bar[row, slot]) & (scores <= self.high[row, slot])
            if not fits.any():
                continue
            s, n = self.found.get((row, slot), (scores[:0], ids[:0]))
            s, n = np.concatenate([s, scores[fits]]), np.concatenate([n, ids[fits]])
            order = np.lexsort((n, ~s))[:self.k]        # ~s falls as s grows, without overflow
            self.found[row, slot] = s[order], n[order]
            if len(order) == self.k:
                self.bar[row, slot] = s[order[-1]]

    def columns(self) -> dict:
        rows = [(int(self.anchors.keys[row]), slot, n, s) for (row, slot), (scores, ids)
                in sorted(self.found.items()) for s, n in zip(scores.tolist(), ids.tolist())]
        key, slot, found, score = zip(*rows) if rows else ((), (), (), ())
        return {"anchor_key": key, "slot": slot, "found_id": found, "score": score}


def _search(index: DataFrame, anchors: Anchors, same_label: bool, k: int, low: np.ndarray,
            high: np.ndarray) -> DataFrame:
    """The best `k` per anchor and slot over all rows of the index, and their rank."""
    target = tables.arrow_schema(FOUND)

    def run(batches):
        best = Best(anchors, k, low, high)
        for part in tables.slices(batches):
            for label, bucket in buckets(part, anchors.widest):
                best.add(bucket, np.flatnonzero((anchors.labels == label) == same_label))
        yield tables.as_batch(best.columns(), target)

    by = Window.partitionBy("anchor_key", "slot").orderBy(F.desc("score"), "found_id")
    return (tables.map_arrow(index, run, FOUND).withColumn("rank", F.row_number().over(by))
            .where(F.col("rank") <= k))


# --- operator ----------------------------------------------------------------------------

def anchor_blocks(chosen: DataFrame, rows: int) -> list[tuple[int, int]]:
    """Ranges of anchor_key with at most `rows` anchors each: the key counts within a task."""
    task = F.shiftright("anchor_key", 33)
    counts = chosen.groupBy(task.alias("task")).agg(F.count("*").alias("n")).orderBy("task").collect()
    pieces = [((r["task"] << 33) + at, (r["task"] << 33) + min(at + rows, r["n"]))
              for r in counts for at in range(0, r["n"], rows)]
    blocks: list[list[int]] = []
    held = 0
    for start, end in pieces:
        if blocks and held + end - start <= rows:
            blocks[-1][1] = end
            held += end - start
        else:
            blocks.append([start, end])
            held = end - start
    return [(a, b) for a, b in blocks]


def mine(numbers: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100) -> DataFrame:
    """For each anchor and each of its best `positives` rows of the same label, the best
    `negatives` rows of another label that score from `low` to `high` percent of the positive.

    `numbers` has the columns of INDEX. Two passes over the index per block of anchors.
    """
    spark = numbers.sparkSession
    index = build_index(numbers)
    chosen = tables.materialise(
        index.where(is_anchor).withColumn("anchor_key", F.monotonically_increasing_id()), "anchors")
    widest = chosen.agg(F.max(F.size("v"))).first()[0]
    path = tables.scratch_path(spark, "negatives")
    block_rows = max(1, ANCHOR_BYTES // (8 * max(widest or 1, 1)))
    written = []
    for number, (start, end) in enumerate(anchor_blocks(chosen, block_rows)):
        block = chosen.where((F.col("anchor_key") >= start) & (F.col("anchor_key") < end))
        written.append(f"{path}/block={number}")
        _mine_block(index, Anchors(block.toArrow()), positives, negatives, low, high).write.option(
            "compression", "zstd").parquet(written[-1])
    if not written:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(*written)


def _mine_block(index: DataFrame, anchors: Anchors, positives: int, negatives: int, low: int,
                high: int) -> DataFrame:
    n = len(anchors.keys)
    nothing, everything = np.full((n, 1), LOW), np.full((n, 1), HIGH)
    own = sorted(set(anchors.labels.tolist()))
    same = index.where(F.col("label").isin(own)) if len(own) <= 1000 else index
    best = _search(same, anchors, True, positives, nothing, everything).toArrow()
    row_of = {key: row for row, key in enumerate(anchors.keys.tolist())}
    ids, scores = np.zeros((2, n, positives), np.int64)
    lows, highs = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
    for key, found, score, rank in zip(*[best.column(c).to_pylist() for c in
                                         ("anchor_key", "found_id", "score", "rank")]):
        at = row_of[key], rank - 1
        ids[at], scores[at] = found, score
        # in whole numbers: low * positive <= 100 * negative <= high * positive
        lows[at], highs[at] = max(LOW, -(-low * score // 100)), min(HIGH, high * score // 100)
    pairs = index.sparkSession.createDataFrame(pa.table({
        "anchor_key": np.repeat(anchors.keys, positives),
        "slot": np.tile(np.arange(positives, dtype=np.int32), n),
        "anchor_id": np.repeat(anchors.ids, positives),
        "positive_id": ids.ravel(), "positive_score": scores.ravel()}))
    found = _search(index, anchors, False, negatives, lows, highs)
    return (found.join(pairs, ["anchor_key", "slot"])
            .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def relabelled(rows: DataFrame) -> DataFrame:
    """`embeddings` with the label moved on by one (of ten) where the id is divisible by 7."""
    label = F.col("label").cast("long")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


#: The same rows by plain nested loops, for DuckDB.
ORACLE = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
           list_dot_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored
    WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER
           AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> anchor_label AND 80 * positive_score <= 100 * score
  AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
