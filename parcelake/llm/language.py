"""Language of a text by a byte convolutional network.

A window of `WINDOW` bytes passes filters of several widths, is max-pooled over its positions and
classified by a softmax layer. A text is cut into windows from its first to its last byte; its
probabilities are the means over its windows, weighted by their bytes. The input is a byte, so a
filter is a table of one row per byte value and a convolution is a sum of looked-up rows.

The network is trained in numpy on the driver, on a bounded sample: about `SAMPLE_DOCS` documents
per language (twice that in all at most, times the number of languages), `SAMPLE_WINDOWS` windows
of each.

Results in special cases: a null text, an empty text and a text without a letter are `und` with
score 0; without any labelled text every document is `und`; ties go to the first label in order;
repeated rows are judged one by one; a null doc_id is never learned from and not held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelake.llm import tables

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 4
EPOCHS = 8
CHUNK = 64              # windows computed at a time, so that activations stay in cache
UNKNOWN = "und"

_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """A character of a Unicode category L; fractions, superscripts and number forms are none."""
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


@dataclass
class Network:
    labels: list[str]
    filters: list[np.ndarray]       # per width: (width, 256, FILTERS)
    bias: np.ndarray                # (len(WIDTHS) * FILTERS,)
    dense: np.ndarray               # (len(WIDTHS) * FILTERS, labels)
    dense_bias: np.ndarray

    def pooled(self, windows: np.ndarray, with_argmax: bool = False):
        """Max over positions of every filter, and where it was found."""
        best, where = [], []
        for table in self.filters:
            span = windows.shape[1] - len(table) + 1
            total = table[0].take(windows[:, :span], axis=0)
            for offset in range(1, len(table)):
                total += table[offset].take(windows[:, offset:offset + span], axis=0)
            best.append(total.max(axis=1))
            if with_argmax:
                where.append(total.argmax(axis=1))
        return np.concatenate(best, axis=1) + self.bias, where

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.labels)), np.float64)
        for at in range(0, len(windows), CHUNK):
            hidden = np.maximum(self.pooled(windows[at:at + CHUNK])[0], 0)
            out[at:at + CHUNK] = _softmax(hidden @ self.dense + self.dense_bias)
        return out


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def to_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts, zero-filled at each text's end, and the number of windows of each."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    joined = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts.tolist()))
    return np.frombuffer(joined, np.uint8).reshape(-1, WINDOW), counts


def train(examples: list[tuple[str, bytes]], seed: int = 7) -> Network | None:
    """A network from (label, window) pairs; None if there are none."""
    if not examples:
        return None
    examples = sorted(examples)
    rng = np.random.default_rng(seed)
    labels = sorted({label for label, _ in examples})
    target = np.array([labels.index(label) for label, _ in examples])
    data = np.zeros((len(examples), WINDOW), np.uint8)
    for row, (_, text) in zip(data, examples):
        text = text[:WINDOW]
        row[:len(text)] = np.frombuffer(text, np.uint8)
    width = len(WIDTHS) * FILTERS
    net = Network(labels,
                  [rng.normal(0, .3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(width, np.float32),
                  rng.normal(0, .3, (width, len(labels))).astype(np.float32),
                  np.zeros(len(labels), np.float32))
    for table in net.filters:
        table[:, 0] = 0
    if len(labels) == 1:
        return net
    weight = len(target) / (len(labels) * np.bincount(target, minlength=len(labels)))
    params = [*net.filters, net.bias, net.dense, net.dense_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    columns = np.arange(FILTERS)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for at in range(0, len(order), CHUNK):
            chosen = order[at:at + CHUNK]
            x, rows = data[chosen].copy(), np.arange(len(chosen))
            # a third of the windows are cut short, as the last one of a text is
            for row in np.flatnonzero(rng.random(len(chosen)) < .33):
                x[row, rng.integers(8, WINDOW):] = 0
            hidden, where = net.pooled(x, True)
            active = np.maximum(hidden, 0)
            error = _softmax(active @ net.dense + net.dense_bias)
            error[rows, target[chosen]] -= 1
            error *= (weight[target[chosen]] / len(chosen))[:, None]
            back = (error @ net.dense.T) * (hidden > 0)
            grads = []
            for k, (table, best) in enumerate(zip(net.filters, where)):
                grad = np.zeros_like(table)
                part = back[:, k * FILTERS:(k + 1) * FILTERS]
                for offset in range(len(table)):
                    np.add.at(grad[offset], (x[rows[:, None], best + offset], columns), part)
                grad[:, 0] = 0
                grads.append(grad)
            grads += [back.sum(axis=0), active.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += .1 * (g - m)
                v += .01 * (g * g - v)
                p -= .01 * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .99 ** step)) + 1e-6)
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Train on the labelled documents that are not held out (columns doc_id, text, lang)."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                        & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    grain = 1 << 30
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items())
                           for x in (lang, min(grain, -(-grain * sample_docs // n)))])
    length = F.length("text")
    starts = [F.floor(F.greatest(length - WINDOW, F.lit(0)) * k / SAMPLE_WINDOWS).cast("int") + 1
              for k in range(SAMPLE_WINDOWS)]
    sample = (known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share[F.col("lang")])
              .filter(F.col("text").isNotNull())
              .select("lang", F.array_distinct(F.array(
                  *[F.substring("text", s, F.lit(WINDOW)) for s in starts])).alias("parts"))
              .limit(2 * sample_docs * len(counts)))
    return train([(row["lang"], part.encode()) for row in sample.collect()
                  for part in row["parts"] if has_letter(part)])


def judge(net: Network | None, column: pa.Array) -> tuple[list[str], list[float]]:
    """Label and score of each text. Long texts are taken some thousand windows at a time."""
    labels, scores = [UNKNOWN] * len(column), [0.0] * len(column)
    if net is None:
        return labels, scores
    known = [i for i, t in enumerate(column.to_pylist()) if t and has_letter(t)]
    texts = tables.raw(column)
    span = WINDOW * 4096

    def totals(group: list[int]) -> None:
        windows, counts = to_windows([texts[i] for i in group])
        weighted = net.probabilities(windows) * np.count_nonzero(windows, axis=1)[:, None]
        ends = np.cumsum(counts)
        for i, total in zip(group, np.add.reduceat(weighted, ends - counts)):
            finish(i, total)

    def finish(i: int, total: np.ndarray) -> None:
        best = int(total.argmax())
        labels[i], scores[i] = net.labels[best], float(min(1.0, total[best] / max(total.sum(), 1e-12)))

    group, size = [], 0
    for i in known:
        if len(texts[i]) > span:
            total = 0
            for at in range(0, len(texts[i]), span):
                windows, _ = to_windows([texts[i][at:at + span]])
                total = total + net.probabilities(windows).T @ np.count_nonzero(windows, axis=1)
            finish(i, total)
            continue
        group.append(i)
        size += len(texts[i])
        if size > span:
            totals(group)
            group, size = [], 0
    if group:
        totals(group)
    return labels, scores


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of `docs`; only the text is an input."""
    def step(batch):
        labels, scores = judge(net, batch.column("text"))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": labels, "score": scores}

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         held_out(F.col("doc_id")).alias("held_out"), "text")
    return tables.mapped(chosen, step,
                         "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, net: Network | None, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is known with `least_score` or more."""
    def step(batch):
        labels, scores = judge(net, batch.column("text"))
        return [lang != UNKNOWN and score >= least_score for lang, score in zip(labels, scores)]

    return tables.kept(docs, step)
