"""Operator 8: quality rules.  Counts with fixed limits, then an n-gram model with a fixed threshold.

The model is a logistic regression over hashed word and character n-grams, fitted by
numpy on a bounded sample of rows that ``labels.quality`` marks, calibrated on a part
of the sample kept back, and applied in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns, labelled_sample, mix, windows, word_ids

WHITE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
#: Buckets of hashed n-grams, as a power of two; at most 16, as buckets take two bytes.
BITS = 16
#: Fixed limits.
LEAST_WORDS, MOST_REPEATED_PERCENT, LEAST_PROBABILITY = 10, 20, 0.2


@dataclass(frozen=True)
class NgramModel:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, text: str, words: np.ndarray) -> float:
        """Calibrated probability that the text is good; texts without n-grams get that of weight zero."""
        z = self.bias + sum(float(self.weights[f].mean()) for f in _features(text, words) if len(f))
        return float(1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -50, 50))))


def _features(text: str, words: np.ndarray) -> list[np.ndarray]:
    """Buckets of words, word pairs and runs of three characters, two bytes each."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    grams = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77C2B2AE63) \
        + points[2:] * np.uint64(0xC2B2AE3D27D4EB4F) if len(points) > 2 else points[:0]
    families = [words, windows(words, 2) if len(words) > 1 else words[:0], grams]
    return [(mix(f + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.uint16) for k, f in enumerate(families)]


def _words(text: str) -> np.ndarray:
    return word_ids(text.encode("utf-8").split())


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 8000, epochs: int = 12, seed: int = 1,
) -> NgramModel:
    """Fit on at most ``per_class`` labelled texts of each class, of each at most ``max_chars`` characters.

    A fifth of the sample calibrates.  Shares of the classes among all labels enter the
    calibration.  Without labels of both classes every text gets probability one.
    """
    sample = labelled_sample(labels, docs, "quality", per_class, max_chars, seed)
    shares = {r["quality"]: r["n"] for r in labels.where("quality in (0, 1)").groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = np.zeros(1 << BITS, np.float64)
    y = np.array([float(label == 1) for _, _, label in sample])
    if not len(y) or y.min() == y.max():
        return NgramModel(weights.astype(np.float32), 0.0, 0.0, 50.0)
    features = [_features(t, _words(t)) for _, t, _ in sample]
    back = np.arange(len(y)) % 5 == 0
    rng = np.random.default_rng(seed)
    bias, squares, bias_square = 0.0, np.full(1 << BITS, 1e-8), 1e-8

    def flat(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, the row of each, and its share in the row's sum; of one batch at a time, as they take many times the sample."""
        at = [(f, k) for k, r in enumerate(rows) for f in features[r] if len(f)]
        if not at:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        sizes = np.array([len(f) for f, _ in at])
        return np.concatenate([f for f, _ in at]), np.repeat([k for _, k in at], sizes), np.repeat(1.0 / sizes, sizes)

    fitted = np.flatnonzero(~back)
    batches = np.array_split(rng.permutation(fitted), max(1, len(fitted) // 48))
    for _ in range(epochs):
        for k in rng.permutation(len(batches)):
            (bucket, row, share), truth = flat(batches[k]), y[batches[k]]
            z = bias + np.bincount(row, weights[bucket] * share, len(truth))
            wrong = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - truth) / len(truth)
            slope = np.bincount(bucket, wrong[row] * share, 1 << BITS)
            squares += slope ** 2
            weights -= 4.0 * slope / np.sqrt(squares) * (slope != 0)
            bias_square += wrong.sum() ** 2
            bias -= 0.3 * wrong.sum() / bias_square ** 0.5
    z = np.array([bias + sum(weights[f].mean() for f in features[r] if len(f)) for r in np.flatnonzero(back)])
    a, b = platt(z, y[back])
    prior = np.log(shares[1] / shares[0]) - np.log(y.mean() / (1 - y.mean()))
    return NgramModel(weights.astype(np.float32), float(bias), a, float(b + prior))


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits labels ``y`` at scores ``z`` best; damped Newton steps."""
    a, b = 1.0, 0.0
    scale = float(np.std(z)) or 1.0
    z = z / scale
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        w = p * (1 - p)
        g = np.array([((p - y) * z).sum() + 0.01 * a, (p - y).sum()])
        h = np.array([[(w * z * z).sum() + 0.05, (w * z).sum()], [(w * z).sum(), w.sum() + 0.05]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    return float(a / scale), float(b)


def counts(text: str, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    repeated = 0
    if len(words) >= 5:
        runs = windows(words, 5)
        _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
        twice = times[which] > 1
        covered = np.zeros(len(words) + 1, np.int64)
        at = np.flatnonzero(twice)
        np.add.at(covered, at, 1)
        np.subtract.at(covered, at + 5, 1)
        repeated = int((np.cumsum(covered)[:-1] > 0).sum())
    return (
        len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated,
    )


def judge(
    docs: DataFrame, model: NgramModel, text: str = "text", keep: list[str] | None = None, prefix: str = "",
) -> DataFrame:
    """Add the counts, ``base_failed``, ``score`` and ``kept`` to every row, their names after ``prefix``.

    Null and empty texts have no words: ``base_failed`` is true and ``kept`` false.  Each row
    stands alone, so repeated rows get the same values; other columns pass, columns
    of the added names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    arrow = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        rows = []
        for value in columns[text]:
            body = value.as_py() or ""
            words = _words(body)
            n = counts(body, words)
            failed = n[0] < LEAST_WORDS or 100 * n[4] > MOST_REPEATED_PERCENT * n[0]
            p = model.probability(body, words)
            rows.append((*n, failed, p, not failed and p >= LEAST_PROBABILITY))
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(arrow)]

    fields = [T.StructField(prefix + name, kind) for name, kind in zip(names, kinds)]
    return append_columns(docs, fields, fill, [text], keep)


def accepted(docs: DataFrame, labels: DataFrame, **fitting: int) -> DataFrame:
    """The documents that the rules keep, with their own columns only."""
    judged = judge(docs, fit(docs, labels, **fitting), prefix="__rules_")
    return judged.where(F.col("__rules_kept")).select(*docs.columns)
