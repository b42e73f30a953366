"""Quality by Bradley-Terry ranking: a document's score is learned from preference pairs.

A document labelled 1 is preferred to one labelled 0 with probability sigmoid(u(good) - u(bad)), where
u is linear in features of the text (shares of bytes, shape of words and lines, repetition). The
weights minimise the mean logistic loss of all pairs of a good and a bad document, so the balance of
the labels does not matter. The cut is the quantile of the scores that leaves out as large a share as
the labels do; scores are then put on the scale from 0 to 1 so that the cut falls on `THRESHOLD`.

Learned from every labelled document that is not held out: their features are written once, and a
Newton step sums over them in two passes. How often a document meets one of the other label at which
distance of u follows from the counts of u per label, so pairs are neither listed nor drawn. All sums
are of whole numbers: the result does not depend on the order or the partitions of the rows. The
driver gets sums only, of a size that does not grow with the rows.

Results in special cases: null text is scored like an empty one; a null doc_id is neither learned
from nor held out; labels other than 0 and 1 and documents labelled both ways teach nothing; without
documents of both labels every score is the smoothed share of label 1; repeated rows are scored one by
one, and equal texts get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelake.llm import tables
from parcelake.llm.language import held_out

PIECE_BYTES = 1 << 20       # bytes of a text split into words at once
LABEL_BYTES = 64            # of a label in a broadcast
STEPS, LEAST_FALL = 40, 1e-3        # Newton steps at most; the last lowers the loss by less than this part
DECAY = 1e-3
THRESHOLD = 0.3

_SHAPES = 12
WIDTH = 256 + _SHAPES


def features(text: bytes) -> np.ndarray:
    """Square roots of the share of every byte value, then shapes of words and lines."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(len(text), 1)
    n = again = symbolic = shouted = longest = 0
    distinct: set[bytes] = set()
    last, at = b"", 0
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):             # a piece ends with a blank, if it has one
            cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            end = cut + 1 if cut > at else end
        words = text[at:end].split()
        at = end
        if not words:
            continue
        n += len(words)
        again += sum(map(eq, words, words[1:])) + (words[0] == last)
        last = words[-1]
        distinct.update(words)
        shouted += sum(map(bytes.isupper, words))
        symbolic += len(words) - sum(map(bytes.isalpha, words))
        longest = max(longest, max(map(len, words)))
    lines = text.split(b"\n")
    words = max(n, 1)
    letters = int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum())
    shapes = [np.log1p(n), np.log1p(len(lines)), np.log1p(longest), len(text) / words / 10,
              np.sqrt(len(distinct) / words), np.sqrt(again / words), np.sqrt(symbolic / words),
              np.sqrt(shouted / words), np.sqrt(1 - len(set(lines)) / len(lines)),
              letters / size, counts[65:91].sum() / max(letters, 1), float(n == 0)]
    return np.concatenate([np.sqrt(counts / size), shapes])


def all_features(batch: pa.RecordBatch) -> np.ndarray:
    found = [features(text) for text in tables.raw(batch.column("text"))]
    return np.array(found, np.float64).reshape(-1, WIDTH)


@dataclass
class Ranking:
    """score = sigmoid(slope * (u - cut) + logit(THRESHOLD)), u = weights . (features - mean) / spread."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def utility(self, found: np.ndarray) -> np.ndarray:
        # row by row, so that a document's score does not depend on those beside it
        scaled = np.clip((found - self.mean) / self.spread, -8, 8)
        return np.array([float(row @ self.weights) for row in scaled])

    def score(self, found: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * (self.utility(found) - self.cut) + _logit(THRESHOLD))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


# Sums over documents. A pass takes the labels and features of some rows and returns whole numbers,
# which `Total` adds up over all rows.
Pass = Callable[[np.ndarray, np.ndarray], np.ndarray]
Total = Callable[[Pass, int], np.ndarray]

ROWS = 2048                 # rows of a pass at a time; keeps its products of whole numbers exact
_UNIT = np.full(WIDTH, 2.0 ** 24)       # a feature's sums are counted in parts of 1 / _UNIT
_UNIT[:256] = 2.0 ** 30
_UNIT[256 + 3] = 2.0 ** 16              # the mean length of words, which has no bound
_MOST = 1024                # a larger feature counts as this in mean and spread
_Z, _W = 2.0 ** 12, 2.0 ** 20           # parts of scaled features and weights
_BINS, _PER_UNIT, _COARSE = 4096, 64, 64        # of u: number, per unit, and how many make a coarse one
_FINE_BINS, _FINE_PER_UNIT = 1 << 18, 1024      # of u for the cut
_TRIANGLE = np.triu_indices(WIDTH)


def _bins(u: np.ndarray, bins: int, per_unit: int) -> np.ndarray:
    return np.clip(np.floor(u * per_unit) + bins // 2, 0, bins - 1).astype(np.int64)


def _centres(bins: int, per_unit: int) -> np.ndarray:
    return (np.arange(bins) - bins // 2 + .5) / per_unit


def _over(other: np.ndarray, function, per_unit: int) -> np.ndarray:
    """For u in every bin, the mean of function(u - v) over the v counted in `other`."""
    apart = np.arange(1 - len(other), len(other)) / per_unit
    return np.convolve(other / other.sum(), function(apart), "valid")


def _bell(x: np.ndarray) -> np.ndarray:
    return _sigmoid(x) * _sigmoid(-x)


def _moments(quality: np.ndarray, found: np.ndarray) -> np.ndarray:
    x = np.minimum(found, _MOST)
    sums = np.rint(np.hstack([x * _UNIT, x * x * _UNIT])).astype(np.int64).sum(axis=0)
    return np.concatenate([sums, np.bincount(quality, minlength=2)])


@dataclass
class _Scaled:
    """Features and u as whole numbers, so that products and sums are exact in any order."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def __call__(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.rint(np.clip((found - self.mean) / self.spread, -8, 8) * _Z)
        return z, z @ np.rint(self.weights * _W) / (_Z * _W)


def _counts_of(scaled: _Scaled) -> Pass:
    """How many documents of each label have u in each bin."""
    def counts(quality, found):
        return np.bincount(quality * _BINS + _bins(scaled(found)[1], _BINS, _PER_UNIT), minlength=2 * _BINS)

    return counts


def _loss(counts: np.ndarray, weights: np.ndarray) -> float:
    """The mean loss of all pairs, and the decay."""
    bad, good = counts
    mean = _over(good, lambda x: np.logaddexp(0, x), _PER_UNIT) @ bad / bad.sum()
    return float(mean + DECAY / 2 * weights @ weights)


def _slopes_of(scaled: _Scaled, counts: np.ndarray) -> Pass:
    """Per label: the sum of scaled features times the chance of losing to (good) or winning over (bad)
    a document of the other label; their products times the curvature; their sums per coarse bin."""
    bad, good = counts
    chance = [_over(good, _sigmoid, _PER_UNIT), _over(bad, lambda x: _sigmoid(-x), _PER_UNIT)]
    coarse = counts.reshape(2, -1, _COARSE).sum(axis=2)
    bell = [_over(coarse[1 - label], _bell, _PER_UNIT / _COARSE) for label in (0, 1)]
    at = _centres(_BINS, _PER_UNIT)

    def slopes(quality, found):
        z, u = scaled(found)
        rough, place = np.rint(z / 16), _bins(u, _BINS, _PER_UNIT) // _COARSE
        out = []
        for label in (0, 1):
            own = quality == label
            r = np.rint(np.interp(u[own], at, chance[label]) * 2.0 ** 24)
            out.append(r @ z[own])
            a = np.rint(bell[label][place[own]] * 2.0 ** 20)
            out.append(((rough[own] * a[:, None]).T @ rough[own])[_TRIANGLE])
            sums = np.zeros((len(bell[label]), WIDTH))
            np.add.at(sums, place[own], rough[own])
            out.append(sums.ravel())
        return np.concatenate(out).astype(np.int64)

    return slopes


_SLOPES = WIDTH + len(_TRIANGLE[0]) + _BINS // _COARSE * WIDTH      # numbers per label


def _newton_step(sums: np.ndarray, documents: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Gradient and curvature of the loss of all pairs, solved for the step."""
    gradient, curved, means = DECAY * weights, DECAY * np.eye(WIDTH), []
    for label, sign in ((0, 1), (1, -1)):
        own = sums[label * _SLOPES:(label + 1) * _SLOPES] / documents[label]
        first, second, by_bin = np.split(own, [WIDTH, WIDTH + len(_TRIANGLE[0])])
        gradient = gradient + sign * first / (2.0 ** 24 * _Z)
        upper = np.zeros((WIDTH, WIDTH))
        upper[_TRIANGLE] = second / (2.0 ** 20 * (_Z / 16) ** 2)
        curved = curved + upper + np.triu(upper, 1).T
        means.append(by_bin.reshape(-1, WIDTH) / (_Z / 16))
    place = np.arange(_BINS // _COARSE) * (_COARSE / _PER_UNIT)
    mixed = means[0].T @ _bell(place[:, None] - place) @ means[1]
    return np.linalg.solve(curved - mixed - mixed.T, gradient)


def learn(total: Total, bad_share: float | None = None) -> Ranking | None:
    """The ranking that all documents summed by `total` teach; None without documents of both labels.
    The cut leaves out `bad_share` (default: the share of bad ones among the documents)."""
    sums = total(_moments, 2 * WIDTH + 2)
    documents = sums[-2:]
    if not documents.all():
        return None
    mean, square = (sums[:-2].reshape(2, WIDTH) / _UNIT) / documents.sum()
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    spread[spread < 4 / np.sqrt(_UNIT)] = 1         # as good as constant

    def counted(weights):
        return total(_counts_of(_Scaled(mean, spread, weights)), 2 * _BINS).reshape(2, _BINS)

    weights = np.zeros(WIDTH)
    counts = counted(weights)
    loss = _loss(counts, weights)
    for _ in range(STEPS):
        step = _newton_step(total(_slopes_of(_Scaled(mean, spread, weights), counts), 2 * _SLOPES),
                            documents, weights)
        share = 1.0
        while True:
            tried = np.rint((weights - share * step) * _W) / _W
            counts_tried = counted(tried)
            loss_tried = _loss(counts_tried, tried)
            if loss_tried < loss or share < .01:
                break
            share /= 2
        if loss_tried >= loss:
            break
        fall = 1 - loss_tried / loss
        weights, counts, loss = tried, counts_tried, loss_tried
        if fall < LEAST_FALL:
            break

    model = Ranking(mean, spread, weights, 0.0, 1.0)
    fine = total(_fine_counts_of(model), 2 * _FINE_BINS).reshape(2, _FINE_BINS)
    level = documents[0] / documents.sum() if bad_share is None else bad_share
    share = level * fine[0] / documents[0] + (1 - level) * fine[1] / documents[1]
    model.cut = _quantile(share, level)
    model.slope = _slope(fine, model.cut, level)
    return model


def _fine_counts_of(model: Ranking) -> Pass:
    def counts(quality, found):
        place = _bins(model.utility(found), _FINE_BINS, _FINE_PER_UNIT)
        return np.bincount(quality * _FINE_BINS + place, minlength=2 * _FINE_BINS)

    return counts


def _quantile(share: np.ndarray, level: float) -> float:
    """The middle of the gap between occupied bins that has nearest to `level` of all documents below."""
    full = np.flatnonzero(share)
    if len(full) == 1:
        return float(_centres(_FINE_BINS, _FINE_PER_UNIT)[full[0]])
    below = np.cumsum(share[full])[:-1]
    gap = int(np.argmin(np.abs(below - level)))
    return float(_centres(_FINE_BINS, _FINE_PER_UNIT)[full[gap:gap + 2]].mean())


def _slope(fine: np.ndarray, cut: float, level: float) -> float:
    """The slope between .05 and 20 under which the labels are likeliest."""
    places = [np.flatnonzero(counts) for counts in fine]
    bad, good = (_centres(_FINE_BINS, _FINE_PER_UNIT)[p] - cut for p in places)
    bad_weight, good_weight = (counts[p] / counts.sum() for counts, p in zip(fine, places))

    def loss(slope: float) -> float:
        at = _logit(THRESHOLD)
        return ((1 - level) * np.logaddexp(0, -(slope * good + at)) @ good_weight
                + level * np.logaddexp(0, slope * bad + at) @ bad_weight)

    return float(min(np.geomspace(.05, 20, 60), key=loss))


def rank(good: np.ndarray, bad: np.ndarray, bad_share: float) -> Ranking:
    """Weights from all pairs of a good and a bad document (rows of features)."""
    quality, found = np.repeat([1, 0], [len(good), len(bad)]), np.concatenate([good, bad])
    return learn(lambda step, size: _summed(step, quality, found, size), bad_share)


def _summed(step: Pass, quality: np.ndarray, found: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for at in range(0, len(quality), ROWS):
        out += step(quality[at:at + ROWS], found[at:at + ROWS])
    return out


def totals_of(stored: DataFrame) -> Total:
    """Sums over quality, found (features as bytes): each task adds up its rows, Spark the tasks."""
    target = tables.arrow_schema("place int, value long")

    def total(step: Pass, size: int) -> np.ndarray:
        def run(batches):
            own = np.zeros(size, np.int64)
            for part in tables.slices(batches):
                found = np.frombuffer(b"".join(part.column("found").to_pylist())).reshape(-1, WIDTH)
                own += _summed(step, part.column("quality").to_numpy(), found, size)
            full = np.flatnonzero(own)
            yield tables.as_batch({"place": full.astype(np.int32), "value": own[full]}, target)

        sums = (tables.map_arrow(stored, run, "place int, value long")
                .groupBy("place").agg(F.sum("value").alias("value")).toArrow())
        out = np.zeros(size, np.int64)
        out[sums.column("place").to_numpy()] = sums.column("value").to_numpy()
        return out

    return total


def fit(docs: DataFrame, labels: DataFrame) -> Ranking | float:
    """A ranking learned from all labelled documents that are not held out, or a constant score."""
    usable = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").alias("_other"))
              .where("quality = _other").select("doc_id", "quality"))
    counts = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    bad, good = counts.get(0, 0), counts.get(1, 0)
    constant = (good + 1) / (good + bad + 2)
    if not bad or not good:
        return constant
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(usable) if (good + bad) * LABEL_BYTES <= tables.BROADCAST_BYTES else usable, "doc_id")

    def step(batch):
        return {"quality": batch.column("quality"),
                "found": [row.tobytes() for row in all_features(batch)]}

    stored = tables.materialise(
        tables.mapped(known.select("quality", "text"), step, "quality int, found binary"), "quality-features")
    model = learn(totals_of(stored), bad / (good + bad))
    return constant if model is None else model


def score_all(docs: DataFrame, model: Ranking | float) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`; only the text is an input."""
    def step(batch):
        if isinstance(model, float):
            score = np.full(batch.num_rows, model)
        else:
            score = model.score(all_features(batch))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": score,
                "predicted": (score >= THRESHOLD).astype(np.int32)}

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         held_out(F.col("doc_id")).alias("held_out"), "text")
    return tables.mapped(chosen, step, "doc_id long, held_out boolean, score double, predicted int")
