"""Operator 10: secrets in text.  Fixed patterns, then guess costs of values that follow credential words.

The cost of a value is that of the cheapest way to guess it: a dynamic program cuts it
into dictionary words, dates, repeats, keyboard walks and spans tried by brute force.
The dictionary holds the most frequent words of the whole corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns

ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "guess")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: A credential word, a separator, a value.
CONTEXT = re.compile(
    r"""(?i:\b\w*(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|(?:access|private|auth|signing|encryption)[_-]?key|auth(?:orization)?|bearer))["']?\x20*(?:[:=]|\bis\b|=>)\x20*(?i:bearer\x20+|basic\x20+)?["'`]?([^\s"'`<>,;]+)""",
    re.ASCII)
#: Values from this many guesses on (as a power of ten) and of this many characters count as secrets.
LEAST_COST, LEAST_VALUE = 9.0, 8
#: Longest dictionary word, and cost of one more segment.
WORD_LENGTH, SEGMENT = 20, 0.3
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
LETTERS = re.compile(r"[^\W\d_]+")

_NEXT_KEY = {a + b for row in KEYBOARD for a, b in zip(row, row[1:])}
_NEXT_KEY |= {pair[::-1] for pair in _NEXT_KEY}


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses that the cheapest segmentation needs.

    Linear in the length: every segment but the repeat, the walk and the span tried by
    brute force is bounded, and those three extend step by step.
    """
    n, low = len(value), value.lower()
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[int]] = {}
    for m in (m for i in range(n) if value[i].isdigit() and (m := DATE.match(value, i))):
        dates.setdefault(m.end(), []).append(m.start())
    repeat = walk = 0  # where the repeat or walk that ends here began
    for end in range(1, n + 1):
        last = end - 1
        cost = best[last] + (0.5 if last and value[last - 1].isalnum() == value[last].isalnum() else SEGMENT) \
            + (0.5 if value[last].isdigit() else 0.92)
        if last and low[last] != low[last - 1]:
            repeat = last
        if last and low[last - 1:end] not in _NEXT_KEY:
            walk = last
        if end - repeat >= 3:
            cost = min(cost, best[repeat] + SEGMENT + 1.5 + math.log10(end - repeat))
        if end - walk >= 4:
            cost = min(cost, best[walk] + SEGMENT + 2.0 + math.log10(end - walk))
        for start in dates.get(end, ()):
            cost = min(cost, best[start] + SEGMENT + (2.0 if end - start <= 4 else 4.6))
        for start in range(max(0, end - WORD_LENGTH), end - 2):
            if (rank := ranks.get(low[start:end])) is not None:
                mixed = 0.0 if value[start:end] == low[start:end] else 0.5
                cost = min(cost, best[start] + SEGMENT + math.log10(rank + 1) + mixed)
        best[end] = cost
    return best[n]


def spans(text: str, ranks: dict[str, int]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, ordered by start, then kind as in ``KINDS``."""
    found = []
    if re.search(r"[:=]", text):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".)]}!?:")
        if len(value) >= LEAST_VALUE and guess_cost(value, ranks) >= LEAST_COST:
            found.append(("guess", m.start(1), m.start(1) + len(value)))
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


#: Whole runs of hexadecimal digits of the least length: a shorter run never matches.
HEX_LONG = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST['hex']},}}")


def dictionary(docs: DataFrame, size: int = 20_000) -> Broadcast:
    """Rank of each of the ``size`` most frequent words of all texts, on every executor; ``size`` bounds it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter[str] = Counter()
            for value in batch.column(0):
                words.update(LETTERS.findall((value.as_py() or "").lower()))
            kept = {w: n for w, n in words.items() if 3 <= len(w) <= WORD_LENGTH}
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(kept.values(), pa.int64())], names=["word", "n"])

    top = (
        docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word").limit(size).collect()
    )
    return docs.sparkSession.sparkContext.broadcast({r.word: k for k, r in enumerate(top)})


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
]))


def scan(
    docs: DataFrame, ranks: Broadcast | None = None, text: str = "text", keep: list[str] | None = None, out: str = "secrets",
) -> DataFrame:
    """Add ``secrets``, the spans found in each text (kind, start, end in code points).

    Null and empty texts have none.  Each row stands alone; other columns pass, a column
    of the added name is replaced.  Without ``ranks`` the dictionary comes from ``docs``.
    """
    ranks = ranks or dictionary(docs.select(F.col(text).alias("text")))

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        found = [spans(v.as_py() or "", ranks.value) for v in columns[text]]
        rows = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return [pa.array(rows, kind)]

    return append_columns(docs, [T.StructField(out, SPANS)], fill, [text], keep)


def redact(docs: DataFrame, marker: str = "[secret]") -> DataFrame:
    """The documents with every span, overlapping ones as one, replaced by ``marker``; ``n_chars`` follows."""
    own = docs.columns
    ranks = dictionary(docs)

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        out = []
        for value in columns["text"]:
            body = value.as_py()
            found = spans(body or "", ranks.value)
            parts, at, until = [], 0, -1
            for _, start, end in found:
                if start >= until:
                    parts += [body[at:start], marker]
                until = at = max(until, end)
            out.append("".join([*parts, body[at:]]) if found else body)
        return [pa.array(out, pa.string())]

    clean = append_columns(docs, [T.StructField("text", T.StringType())], fill, ["text"])
    if "n_chars" in own:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*own)


def digests(docs: DataFrame, size: int = 20_000) -> DataFrame:
    """Per document the number of base spans of each kind, their digest, and all spans as text."""
    rows = docs.select("doc_id", "text")
    found = scan(rows, dictionary(rows, size), keep=["doc_id"])
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.concat_ws(",", F.transform(base, as_text)).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("secrets", as_text)).alias("spans"), count("guess").alias("n_guess"),
    )
