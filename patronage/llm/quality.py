"""Quality scores by naive-Bayes support vectors.

A text becomes a set of n-gram indicators, hashed into a fixed number of features. Each indicator
is scaled by its log-count ratio between the classes, and a linear hinge-loss model is fitted on
the scaled indicators by dual coordinate descent. Margins become probabilities by a logistic
curve fitted on margins of rows that the fold's model had not seen.

n-grams are words, and n-grams of the text's *shape*: letters become `a` or `A`, digits `0`,
runs of a letter class collapse, and a word or line equal to the one before is a sign of its own.
So layout, shouting, symbol noise and repetition show in short n-grams in any language.

The fit uses at most `max_rows` labelled rows, those with the least hash of doc_id; the model has
at most 2**BITS weights, which bounds what goes to every task. Scores cover every text.

Nulls: a null text is empty, and has a score. Labels without doc_id or quality are left out;
several labels of one doc_id count as their mean, 1 from a half. Without labels of both classes
every score is the share of label 1, or a half without labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 18
SHAPE_NGRAMS = 5
_shape = np.frombuffer(
    bytes(
        ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128
        else ord("0") if 48 <= c <= 57 else ord(" ") if c in (9, 11, 12, 13, 32) else c
        for c in range(256)
    ),
    np.uint8,
)
_collapses = np.isin(np.arange(256), np.frombuffer(b"Aa0 ", np.uint8))
#: Lower case, with everything but letters as a space.
_letters = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _hashed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of the whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    found = np.zeros(1 << BITS, bool)
    found[0] = True
    if raw:
        data = _shape[np.frombuffer(raw, np.uint8)]
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != data[:-1]) | ~_collapses[data[1:]]
        symbols = gram = data[keep].astype(np.uint64)
        for n in range(1, SHAPE_NGRAMS + 1):
            if n > 1:
                if len(symbols) < n:
                    break
                gram = (gram[:-1] << np.uint64(8)) | symbols[n - 1 :]
            found[_hashed(gram * np.uint64(8) + np.uint64(n))] = True
        words = text.split()
        signs = [(1 << 40) + zlib.crc32(w) for w in set(raw.translate(_letters).split())]
        signs += _runs(np.fromiter(map(str.__eq__, words[1:], words), bool, max(0, len(words) - 1)), 1)
        lines = text.split("\n")
        signs += _runs(np.fromiter((a == b != "" for a, b in zip(lines[1:], lines)), bool, len(lines) - 1), 2)
        found[_hashed(np.array(signs, np.uint64))] = True
    return np.flatnonzero(found).astype(np.int32)


def _runs(same: np.ndarray, kind: int) -> list[int]:
    """n-grams of "equal to the one before": a sign per power of two up to the longest run."""
    if not same.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    longest = int((edges[1::2] - edges[::2]).max())
    return [(1 << 61) + kind * 100 + k for k in range(longest.bit_length())]


class Model:
    """Weights of the indicators, a bias and the curve from margin to probability."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def score(self, text: str | None) -> float:
        margin = float(self.weights[features(text)].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels) if y == label]
        count = smooth + np.bincount(np.concatenate(own), minlength=1 << BITS)
        counts.append(count / (smooth * 2 + len(own)))
    return np.log(counts[0] / counts[1])


def descend(rows, labels, ratios, cost: float = 1.0, rounds: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 by dual coordinate descent; classes weigh alike in the loss."""
    y = np.where(labels == 1, 1.0, -1.0)
    upper = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))) * cost
    scaled = []
    for r in rows:
        value = ratios[r]
        norm = np.sqrt((value**2).sum()) or 1.0
        scaled.append(value / norm)  # long texts weigh as much as short ones
    w, bias = np.zeros(len(ratios)), 0.0
    alpha = np.zeros(len(y))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(y)):
            r, x = rows[i], scaled[i]
            slack = y[i] * (w[r] @ x + bias) - 1
            new = min(max(alpha[i] - slack / 2.0, 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[r] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def fit(texts: list[str | None], labels: np.ndarray, folds: int = 4) -> Model:
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1 or min((labels == 1).sum(), (labels == 0).sum()) < folds:
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model(np.zeros(1 << BITS), 0.0, 0.0, float(odds))
    rows = [features(t) for t in texts]
    margins = np.zeros(len(rows))
    for k in range(folds):
        mine = np.arange(len(rows)) % folds == k
        known = [r for r, m in zip(rows, mine) if not m]
        if len(set(labels[~mine])) < 2:
            continue
        model = _linear(known, labels[~mine])
        for i in np.flatnonzero(mine):
            margins[i] = model[0][rows[i]].sum() + model[1]
    slope, shift = logistic(margins, labels)
    weights, bias = _linear(rows, labels)
    return Model(weights.astype(np.float32), bias, slope, shift)


def _linear(rows, labels) -> tuple[np.ndarray, float]:
    ratios = log_count_ratios(rows, labels)
    w, bias = descend(rows, labels, ratios)
    return w * ratios / np.sqrt(np.mean([(ratios[r] ** 2).sum() for r in rows])), bias


def logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, classes smoothed as by Platt, by Newton's method."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - goal) * margin).sum() + 1e-3 * a, (p - goal).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margin**2).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum()]])
        step = np.linalg.solve(h + np.eye(2) * 1e-6, g)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def held_out(doc_id: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> Model:
    """A model from labelled rows that are not held out, at most `max_rows` of them."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), "quality").where("id is not null and quality is not null")
        .groupBy("id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .where(~held_out("id"))
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where("id is not null").distinct()
    chosen = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "quality").agg(F.min("text").alias("text"))
    got = rows.toPandas().sort_values("id")
    return fit(got["text"].tolist(), got["quality"].to_numpy(np.int64))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with the score of each whole text, in place of a column of that name."""
    others = [f for f in docs.schema.fields if f.name != name]

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = np.array([model.score(t) for t in pdf["text"]], np.float64)
            pdf = pdf[[f.name for f in others]]
            yield pdf.assign(**{name: scores})

    return docs.mapInPandas(scored, T.StructType([*others, T.StructField(name, T.DoubleType())]))
