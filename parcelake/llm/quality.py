"""Quality by weak supervision: rules vote or abstain, and how far each is to be believed is
estimated from their agreement (expectation-maximisation), without labels.

Every rule says good, bad or nothing about a text. The joint votes of all documents are counted
(3 ** rules patterns at most, whatever the corpus) and a two-class model with independent rules is
fitted to the counts on the driver. The posterior probability of "good" replaces the requirement
that every rule be passed.

Results in special cases: a null text counts as one without words and fails the base rule; with
no documents the model is the prior one half and nothing is returned; repeated rows are judged
one by one.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from parcelake.llm import tables

GOOD, ABSTAIN, BAD = 2, 1, 0
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS) + b"]")
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_letters", "n_digits", "n_symbol_words")


def count_repeats(words: list[bytes]) -> int:
    """Words that lie in a three-word window which occurs again."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(ids), bool)
    for part in (order[1:][same], order[:-1][same]):
        for offset in range(3):
            again[part + offset] = True
    return int(again.sum())


def features(text: bytes) -> tuple[int, ...]:
    """The values of FEATURES for one text in UTF-8."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    solid = text.translate(None, SPACES)

    def count(chars: bytes) -> int:
        return len(solid) - len(solid.translate(None, chars))
    upper, lower = count(_UPPER), count(_LOWER)
    points = len(solid) - count(bytes(range(0x80, 0xC0)))
    wide = points - (len(solid) - count(bytes(range(0x80, 0x100))))
    symbols = count(SYMBOLS)
    symbolic = sum(map(bool, map(_SYMBOL.search, words))) if symbols else 0
    return (len(words), points, symbols, len(lines) - len(set(lines)), count_repeats(words),
            len(lines), upper, upper + lower + wide, count(_DIGITS), symbolic)


def votes(f: np.ndarray) -> np.ndarray:
    """Vote of each rule (columns) on each row of FEATURES: GOOD, ABSTAIN or BAD."""
    f = f.astype(np.float64)
    n, chars, symbols, dup, repeat, lines, upper, letters, digits, symbolic = f.T
    words, characters, alpha = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(letters, 1)

    def rule(good, bad):
        return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))

    return np.stack([
        rule(n >= 100, n < 50),
        rule((chars >= 3 * words) & (chars <= 10 * words), (chars < 2 * words) | (chars > 15 * words)),
        rule(100 * symbols <= chars, 100 * symbols > 8 * chars),
        rule((20 * dup <= lines) & (lines >= 3), (2 * dup > lines) & (dup >= 3)),
        rule(10 * repeat <= n, 10 * repeat > 3 * words),
        rule(5 * upper <= letters, 2 * upper > alpha),
        rule(4 * letters >= 3 * characters, 2 * letters < characters),
        rule(20 * digits <= chars, 5 * digits > characters),
        rule(50 * symbolic <= n, 5 * symbolic > words),
    ], axis=1)


RULES = 9
BASE = 3 ** np.arange(RULES)


def base_failed(f: np.ndarray) -> np.ndarray:
    return (f[:, 0] < 50) | (100 * f[:, 4] > 50 * f[:, 0])


def all_features(batch) -> np.ndarray:
    return np.array([features(t) for t in tables.raw(batch.column("text"))],
                    np.int64).reshape(-1, len(FEATURES))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, the features and the vote pattern (rule i has digit i in base 3)."""
    def step(batch):
        values = all_features(batch)
        return ({"doc_id": batch.column("doc_id"), "pattern": (votes(values) @ BASE).astype("int32"),
                 "base_failed": base_failed(values)}
                | {name: values[:, i] for i, name in enumerate(FEATURES)})

    return tables.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), step,
                         "doc_id long, " + ", ".join(f"{n} long" for n in FEATURES)
                         + ", base_failed boolean, pattern int")


def fit(measured: DataFrame, rounds: int = 200) -> np.ndarray:
    """Posterior probability of "good" for each vote pattern, from the counts of all documents."""
    counts = measured.groupBy("pattern").agg(F.count("*").alias("n")).collect()
    pattern = np.array([r["pattern"] for r in counts], np.int64)
    weight = np.array([r["n"] for r in counts], np.float64)
    order = np.argsort(pattern)
    return estimate(pattern[order], weight[order], rounds)


def estimate(pattern: np.ndarray, weight: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Expectation-maximisation over pattern counts, started from the all-must-pass filter."""
    cast = pattern[:, None] // BASE % 3
    good = np.where((cast == BAD).any(axis=1), .1, .9)
    prior, table = .5, np.full((2, RULES, 3), 1 / 3)
    for _ in range(rounds if len(pattern) else 0):
        for side, share in enumerate((1 - good, good)):
            mass = share * weight
            for vote in (BAD, ABSTAIN, GOOD):
                table[side, :, vote] = mass @ (cast == vote) + 1
            table[side] /= table[side].sum(axis=1, keepdims=True)
        prior = float(np.clip(good @ weight / weight.sum(), .01, .99))
        new = posterior(cast, prior, table)
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    return posterior(np.arange(3 ** RULES)[:, None] // BASE % 3, prior, table)


def posterior(cast: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    rules = np.arange(RULES)
    odds = np.log(prior / (1 - prior)) + (
        np.log(table[1, rules, cast]) - np.log(table[0, rules, cast])).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def judge(measured: DataFrame, good: np.ndarray, least: float = 0.5) -> DataFrame:
    """Adds quality (the posterior) and kept to measured documents."""
    quality = F.element_at(F.lit(good.tolist()), F.col("pattern") + 1)
    return (measured.withColumn("quality", quality)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
            .drop("pattern"))


def score(docs: DataFrame) -> DataFrame:
    """Features, posterior and verdict of every row of `docs`."""
    measured = tables.materialise(measure(docs), "quality")
    return judge(measured, fit(measured))


def keep_good(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that pass the base rule and are good with probability `least` or more.

    Votes are counted in one pass and applied in a second one, without a join.
    """
    good = fit(measure(docs))

    def step(batch):
        values = all_features(batch)
        return ~base_failed(values) & (good[votes(values) @ BASE] >= least)

    return tables.kept(docs, step)
