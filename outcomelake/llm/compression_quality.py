"""Operator 1: a compression classifier.

One zstandard dictionary is built from good text, one from bad.  How many bytes more a
text takes with the bad one than with the good one, divided by the root of its length,
becomes a probability by a logistic curve fitted on rows that built no dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns, labelled_sample
from outcomelake.llm.quality_rules import platt

LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    shift: float

    def difference(self, text: bytes) -> float:
        good, bad = _compressors(self.good, self.bad)
        return (len(bad.compress(text)) - len(good.compress(text))) / (len(text) + 1) ** 0.5

    def probability(self, text: bytes) -> float:
        z = self.slope * (self.difference(text) if self.good else 0.0) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


@lru_cache(4)
def _compressors(*dictionaries: bytes) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in dictionaries:
        data = zstandard.ZstdCompressionDict(raw)
        data.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))
    return out


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; of few texts the texts themselves."""
    size = min(size, max(256, sum(map(len, texts)) // 8))
    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        return b"\n".join(texts)[:size] or b"\n"


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 2500, max_chars: int = 6000, size: int = 256 << 10, seed: int = 1,
) -> CompressionModel:
    """Fit on at most ``per_class`` labelled texts of each class, of each at most ``max_chars`` characters.

    Four fifths build the dictionaries of at most ``size`` bytes, the rest calibrates; the
    classes' shares among all labels enter the calibration.  Without labels of both classes
    every text scores the share of good labels, or 1 without labels.
    """
    sample = labelled_sample(labels.where("quality in (0, 1)"), docs, "quality", per_class, max_chars, seed)
    shares = {r["quality"]: r["n"] for r in labels.where("quality in (0, 1)").groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    y = np.array([float(label) for _, _, label in sample])
    if len(y) < 10 or y[::5].min() == y[::5].max():
        return CompressionModel(b"", b"", 0.0, -50.0 if shares.get(0) and not shares.get(1) else 50.0)
    texts = [t.encode("utf-8") for _, t, _ in sample]
    building = [[t for k, t in enumerate(texts) if k % 5 and y[k] == label] for label in (1, 0)]
    model = CompressionModel(*[_dictionary(b, size) for b in building], 0.0, 0.0)
    z = np.array([model.difference(t) for t in texts[::5]])
    slope, shift = platt(z, y[::5])
    rate = y[::5].mean()
    prior = np.log(shares[1] / shares[0]) - np.log(rate / (1 - rate))
    return CompressionModel(model.good, model.bad, slope, float(shift + prior))


def score(docs: DataFrame, model: CompressionModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``score``, the probability that the text is good, to every row.

    Null texts count as empty, which differ by nothing and so get the shift's
    probability.  Each row stands alone; other columns pass, a column ``score`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        use = sent.value
        return [pa.array([use.probability((v.as_py() or "").encode("utf-8")) for v in columns[text]], pa.float64())]

    return append_columns(docs, [T.StructField("score", T.DoubleType())], fill, [text], keep)
