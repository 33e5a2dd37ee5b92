"""Operator 7: language by a bidirectional gated recurrent network over bytes, in numpy.

A text is cut into words; the network reads the bytes of a word in both directions and
labels every byte.  A document's probabilities are the means over the bytes of all its
words that hold a letter.  Words repeat, so a worker remembers their sums.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns, labelled_sample

#: Longest run of characters that is read as one sequence; longer words are several.
SEQUENCE = 24
#: Words whose sums a worker remembers before it starts anew.
REMEMBERED = 150_000
#: Sequences that run through the network at once.
ROWS = 4096
ONE_HOT = np.eye(256, dtype=np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (steps, rows, width) of one direction over byte columns ``x`` (rows, steps)."""
    width = recurrent.shape[0]
    h = np.zeros((len(x), width), np.float32)
    out = np.empty((x.shape[1], len(x), width), np.float32)
    for t in range(x.shape[1]):
        a = inputs[x[:, t]]
        u = h @ recurrent
        gates = _sigmoid(a[:, :2 * width] + u[:, :2 * width])
        z, r = gates[:, :width], gates[:, width:]
        n = np.tanh(a[:, 2 * width:] + r * u[:, 2 * width:])
        if trace is not None:
            trace.append((h, z, r, n, u[:, 2 * width:]))
        h = n + z * (h - n)
        out[t] = h
    return out


def _back(x: np.ndarray, recurrent: np.ndarray, trace: list, d_out: np.ndarray, d_inputs: np.ndarray, d_recurrent: np.ndarray) -> None:
    """Backpropagation through time of one direction; adds to the gradients."""
    width = recurrent.shape[0]
    d_h = np.zeros_like(d_out[0])
    for t in range(x.shape[1] - 1, -1, -1):
        h, z, r, n, u = trace[t]
        d_h = d_h + d_out[t]
        d_n = d_h * (1 - z) * (1 - n * n)
        d_z = d_h * (h - n) * z * (1 - z)
        d_r = d_n * u * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_n * r], axis=1)
        d_inputs += ONE_HOT[x[:, t]].T @ np.concatenate([d_z, d_r, d_n], axis=1)
        d_recurrent += h.T @ d_u
        d_h = d_h * z + d_u @ recurrent.T


@dataclass
class Network:
    languages: list[str]
    weights: list[np.ndarray]  # inputs and recurrent weights forward, the same backward, output, bias
    known: dict[str, int] = field(default_factory=dict)
    sums: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "weights": self.weights, "known": {}, "sums": None}

    def label(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (steps, rows, languages) at every byte of equally long sequences."""
        wf, uf, wb, ub, out, bias = self.weights
        both = np.concatenate([_run(x, wf, uf), _run(x[:, ::-1], wb, ub)[::-1]], axis=2)
        logits = both @ out + bias
        e = np.exp(logits - logits.max(2, keepdims=True))
        return e / e.sum(2, keepdims=True)

    def _learn_words(self, words: list[str]) -> np.ndarray:
        """Per word the sums of its bytes' probabilities, and their number (0 without a letter)."""
        total = np.zeros((len(words), len(self.languages) + 1), np.float32)
        by_length: dict[int, list[tuple[int, bytes]]] = {}
        for k, w in enumerate(words):
            for at in range(0, len(w), SEQUENCE):
                part = w[at:at + SEQUENCE]
                if any(map(str.isalpha, part)):
                    raw = part.encode("utf-8")
                    by_length.setdefault(len(raw), []).append((k, raw))
        for length, rows in by_length.items():
            for a in range(0, len(rows), ROWS):
                part = rows[a:a + ROWS]
                x = np.frombuffer(b"".join(r for _, r in part), np.uint8).reshape(len(part), length)
                at = [k for k, _ in part]
                np.add.at(total[:, :-1], at, self.label(x).sum(0))
                np.add.at(total[:, -1], at, length)
        return total

    def pool(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text; zero rows for texts without a letter."""
        words = [t.split() for t in texts]
        if self.sums is None or len(self.known) > REMEMBERED:
            self.known, self.sums = {}, np.zeros((0, len(self.languages) + 1), np.float32)
        fresh = list(set(chain.from_iterable(words)).difference(self.known))
        if fresh:
            self.known.update(zip(fresh, range(len(self.sums), len(self.sums) + len(fresh))))
            self.sums = np.concatenate([self.sums, self._learn_words(fresh)])
        out = np.zeros((len(texts), len(self.languages)))
        for k, w in enumerate(words):
            if w:
                s = self.sums[np.fromiter(map(self.known.__getitem__, w), np.int64, len(w))].sum(0, dtype=np.float64)
                if s[-1]:
                    out[k] = s[:-1] / s[-1]
        return out


def fit(
    docs: DataFrame, per_language: int = 250, max_chars: int = 800, width: int = 16, epochs: int = 3, seed: int = 1,
    max_languages: int = 200,
) -> Network:
    """Train on at most ``per_language`` texts of every non-null ``lang``, of each at most ``max_chars`` characters.

    Without any such text the network knows no language.  More than ``max_languages`` of
    them raise ValueError: the sample at the driver is bounded by that number, and a language left
    out would never be found.
    """
    known = docs.where("doc_id is not null and lang is not null").select("lang").distinct().limit(max_languages + 1).count()
    if known > max_languages:
        raise ValueError(f"lang has more than max_languages={max_languages} values")
    sample = labelled_sample(docs, docs, "lang", per_language, max_chars, seed, max_languages)
    languages = sorted({lang for _, _, lang in sample})
    rng = np.random.default_rng(seed)
    rows: dict[int, list[tuple[bytes, int]]] = {}
    for _, text, lang in sample:
        for w in text.split():
            for at in range(0, len(w), SEQUENCE):
                part = w[at:at + SEQUENCE]
                if any(map(str.isalpha, part)):
                    raw = part.encode("utf-8")
                    rows.setdefault(len(raw), []).append((raw, languages.index(lang)))
    n = max(1, len(languages))
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    weights = [
        draw(256, 3 * width, scale=0.3), draw(width, 3 * width, scale=width ** -0.5),
        draw(256, 3 * width, scale=0.3), draw(width, 3 * width, scale=width ** -0.5),
        draw(2 * width, n, scale=0.2), np.zeros(n, np.float32),
    ]
    groups = [
        (np.frombuffer(b"".join(r for r, _ in part), np.uint8).reshape(len(part), length), np.array([c for _, c in part]))
        for length, part in rows.items()
    ]
    shares = np.bincount(np.concatenate([y for _, y in groups]), minlength=n) if groups else np.ones(n)
    balance = (shares.sum() / n / np.maximum(shares, 1)).astype(np.float32)
    batches = [
        (k, at) for k, (x, _) in enumerate(groups) for at in np.array_split(rng.permutation(len(x)), -(-len(x) // 256))
    ]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps, planned = 0, epochs * len(batches)
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            k, at = batches[b]
            gradients = _gradients(weights, groups[k][0][at], groups[k][1][at], balance)
            steps += 1
            rate = 0.01 * (1 - 0.9 * steps / planned)
            for w, g, m, s in zip(weights, gradients, means, squares):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(s / (1 - 0.999 ** steps)) + 1e-6)
    return Network(languages, weights)


def _gradients(weights: list[np.ndarray], x: np.ndarray, y: np.ndarray, balance: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all bytes of equally long sequences."""
    wf, uf, wb, ub, out, bias = weights
    width, back = uf.shape[0], x[:, ::-1]
    trace_f: list = []
    trace_b: list = []
    both = np.concatenate([_run(x, wf, uf, trace_f), _run(back, wb, ub, trace_b)[::-1]], axis=2)
    logits = both @ out + bias
    e = np.exp(logits - logits.max(2, keepdims=True))
    d = e / e.sum(2, keepdims=True)
    d[:, np.arange(len(y)), y] -= 1
    d *= (balance[y] / (len(y) * x.shape[1]))[None, :, None]
    gradients = [np.zeros_like(w) for w in weights]
    flat = d.reshape(-1, d.shape[2])
    gradients[4] += both.reshape(-1, 2 * width).T @ flat
    gradients[5] += flat.sum(0)
    d_both = d @ out.T
    _back(x, uf, trace_f, d_both[:, :, :width], gradients[0], gradients[1])
    _back(back, ub, trace_b, d_both[::-1, :, width:], gradients[2], gradients[3])
    return gradients


def identify(docs: DataFrame, network: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score``, its mean probability, to every row.

    Texts that are null or hold no letter are ``und`` with score 0, and so are all if the
    network knows no language.  Each row stands alone; other columns pass, columns
    of the added names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)  # a few hundred kB, whatever the input

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        use, texts = sent.value, [t or "" for t in columns[text].to_pylist()]
        if not use.languages:
            return [pa.array(["und"] * len(texts)), pa.array([0.0] * len(texts), pa.float64())]
        p = use.pool(texts)
        best = p.argmax(1)
        some = p.sum(1) > 0
        return [
            pa.array([use.languages[k] if s else "und" for k, s in zip(best, some)]),
            pa.array(np.minimum(p[np.arange(len(p)), best], 1.0) * some, pa.float64()),
        ]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return append_columns(docs, fields, fill, [text], keep)
