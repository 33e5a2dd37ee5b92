"""Operator 9: bytes covered by a long string that starts in a second place.

Suffixes are ordered only through ``length`` bytes, digit by digit as a radix sort does,
the most significant first, and whatever has become unique leaves after each pass.
Equal groups of the last pass are exactly the repeated windows.

1. A window's first digit is its anchor: of all runs of ``GRAM`` bytes in it the one with
   the least hash, so equal windows have equal anchors at equal places.  Neighbouring
   windows mostly share theirs; such a run of windows is one row.  Rows whose
   anchor occurs once leave.
2. The second digit is the whole region that a row's windows cover.  Equal regions decide
   all their windows at once; each goes on as one row, and only where other regions have
   the same anchor.
3. Of the rows that are left, windows that start at most ``STEP`` bytes apart share most of
   their bytes; these are the third digit.
4. The last digit is the window itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns, chunks, discard, mix, stored

GRAM = 40
#: Window starts that are worked on together; a longer text is done in parts.
PART = 1 << 21
#: Window starts that the third digit stands for.
STEP = 16
#: Texts a task remembers before it starts anew; bounds its memory, never its results.
REMEMBERED = 200_000

_RNG = np.random.default_rng(20240229)
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 8 + 5
_U = np.uint64


class _Powers:
    """Powers of the base and of its inverse modulo 2 to the 64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = pow(_BASE, -1, 1 << 64)
            grow = lambda base: np.cumprod(np.append(_U(1), np.full(size - 1, base % (1 << 64), np.uint64)), dtype=np.uint64)
            self.up, self.down = grow(_BASE), grow(inverse)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _prefix(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of byte values times powers, and the factors that make a span's sum independent of its place."""
    up, down = _POWERS.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[:-1], out=sums[1:], dtype=np.uint64)
    return sums, down


def _spans(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: of a block's end and the next block's beginning."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    to_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_right[:n - width + 1], from_left[width - 1:n])


def _place(first: np.ndarray, anchor: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First window start of a run, how far behind it anchor and last start lie, in one number."""
    return first << 32 | (anchor - first) << 16 | (last - first)


def _unplace(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window start, anchor and last window start."""
    return place >> 32, (place >> 32) + (place >> 16 & 0xFFFF), (place >> 32) + (place & 0xFFFF)


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every run of windows with one anchor: its place, and hashes of anchor and region."""
    gram = min(GRAM, length)
    out = []
    for at in range(0, len(raw) - length + 1, PART):
        part = raw[at:at + PART + length - 1]
        sums, down = _prefix(part)
        count = len(part) - gram + 1
        grams = mix((sums[gram:] - sums[:-gram]) * down[:count])
        # The place below the hash: among equal hashes the first one wins.
        key = (grams & _U(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
        place = (_least(key, length - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        p = place[first]
        region = mix(_spans(sums, down, first, last + length) + (p - first).astype(np.uint64))
        out.append((_place(first + at, p + at, last + at), grams[p], region))
    return tuple(np.concatenate(x) for x in zip(*out))


def _text_keys() -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), "text").alias("t1"), F.xxhash64("text", F.lit(2)).alias("t2")


class _Once:
    """Keeps the first of equal texts that a task meets: copies add nothing to an order of distinct texts.

    So a text in a third of all rows makes rows once a task, not once a copy, before anything is shuffled.
    """

    def __init__(self) -> None:
        self.seen: set[tuple[int, int]] = set()

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows of ``batch``, whose first two columns are the text key, that are new to the task."""
        new = []
        for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            new.append(key not in self.seen)
            self.seen.add(key)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        return batch.filter(pa.array(new, pa.bool_()))


def _distinct_in_tasks(texts: DataFrame) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            yield once(batch)

    return texts.select("t1", "t2", "text").mapInArrow(keep, "t1 bigint, t2 bigint, text string")


def _rows(texts: DataFrame, length: int) -> DataFrame:
    """A row for each run of windows with one anchor: text key, first start, number of starts, anchor, region."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in (c for whole in batches for c in chunks(once(whole), [2])):
            t1, t2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            parts = []
            for k, value in enumerate(batch.column(2)):
                raw = np.frombuffer(value.as_buffer() or b"", np.uint8) if value.is_valid else np.zeros(0, np.uint8)
                if len(raw) >= length:
                    place, gram, region = anchors(raw, length)
                    parts.append((np.full(len(place), k), place, gram, region))
            if parts:
                row, place, gram, region = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (t1[row], t2[row], place, gram.astype(np.int64), region.astype(np.int64))],
                    names=["t1", "t2", "place", "gram", "region"])

    return texts.select("t1", "t2", "text").mapInArrow(make, "t1 bigint, t2 bigint, place bigint, gram bigint, region bigint")


def _digits(texts: DataFrame, length: int, last: bool) -> DataFrame:
    """Third digit, or the last one, of the runs listed in ``open``: text key, place and hash.

    The third digit of up to ``STEP`` windows, counted from the anchor, is the bytes that all of them share.
    """
    step = 1 if last else min(STEP, length)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (c for whole in batches for c in chunks(whole, [2])):
            for t1, t2, value, places in zip(*[batch.column(k) for k in range(4)]):
                raw = np.frombuffer(value.as_buffer(), np.uint8)
                found = np.array(places.as_py(), np.int64)
                for at in range(0, len(raw), PART):  # whole texts, in parts that overlap
                    here = found[(found >> 32 >= at) & (found >> 32 < at + PART)]
                    if not len(here):
                        continue
                    sums, down = _prefix(raw[at:at + PART + length + (1 << 16)])
                    first, anchor, final = (x - at for x in _unplace(here))
                    low, high = (anchor - final) // step, (anchor - first) // step
                    more = high - low + 1
                    k = np.repeat(np.arange(len(here)), more)
                    group = low[k] + np.arange(len(k)) - np.repeat(np.append(0, np.cumsum(more)[:-1]), more)
                    start = np.maximum(first[k], anchor[k] - group * step - step + 1)
                    end = np.minimum(final[k], anchor[k] - group * step)
                    core = anchor[k] - group * step
                    digit = mix(_spans(sums, down, core, core - step + 1 + length) + (_U(0) if last else group.astype(np.uint64)))
                    n = len(k)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, t1.as_py())), pa.array(np.full(n, t2.as_py())),
                        pa.array(_place(start + at, anchor[k] + at, end + at)), pa.array(digit.astype(np.int64)),
                    ], names=["t1", "t2", "place", "digit"])

    return texts.select("t1", "t2", "text", "open").mapInArrow(make, "t1 bigint, t2 bigint, place bigint, digit bigint")


def _repeated(rows: DataFrame, label: str, out: str) -> tuple[DataFrame, str]:
    """Per text the places whose digit occurs twice, and the path of the table read for that."""
    rows, path = stored(rows, label)
    twice = rows.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digit")
    return rows.join(twice, "digit").groupBy("t1", "t2").agg(F.collect_list("place").alias(out)), path


def _removed(texts: DataFrame, length: int, keep_text: bool) -> DataFrame:
    """Per text the removed spans, and digest and, on demand, bytes of what is left."""
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [T.StructField("spans", span), T.StructField("kept_sha256", T.StringType())]
    if keep_text:
        fields.append(T.StructField("kept_bytes", T.BinaryType()))

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        spans, digests, kept = [], [], []
        for value, whole, starts in zip(columns["text"], columns["decided"], columns["starts"]):
            raw = value.as_py().encode("utf-8")
            rows = np.array(whole.as_py() or [], np.int64)
            single = np.array(starts.as_py() or [], np.int64)
            change = np.zeros(len(raw) + 1, np.int64)
            first, _, last = _unplace(np.concatenate([rows, single]))
            np.add.at(change, first, 1)
            np.subtract.at(change, last + length, 1)
            gone = np.cumsum(change[:-1]) > 0
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            spans.append([{"start": a, "end": b} for a, b in edge.tolist()])
            left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return [pa.array(spans, arrow), pa.array(digests), *([pa.array(kept, pa.binary())] if keep_text else [])]

    return append_columns(texts, fields, fill, ["text", "decided", "starts"], ["t1", "t2"])


def repeats(docs: DataFrame, length: int = 200, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans`` (maximal removed runs of bytes), ``kept_sha256``.

    A byte is removed when a string of ``length`` bytes covers it that starts anywhere else
    too, in the same text or another; overlaps count, and strings are judged on the input.
    Null texts are empty.  Texts are told apart by a 128-bit hash, so rows that share an
    id or are repeated as a whole need no care; of equal texts long enough nothing is left.
    Other columns are not used.  With ``keep_text`` the remaining bytes are a column too.
    """
    if not 0 < length < 1 << 16:
        raise ValueError("length takes 1 to 65535 bytes")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", *_text_keys())
    long_rows = rows.where(F.octet_length("text") >= length)
    made = _rows(long_rows, length)
    shared = made.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    left, left_path = stored(made.join(shared, "gram").withColumn("row", F.xxhash64("t1", "t2", "place")), "shared-anchors")
    # Rows of equal texts are one; a region is repeated when two rows differ.
    regions, regions_path = stored(left.groupBy("gram", "region").agg(F.min("row").alias("a"), F.max("row").alias("b")), "regions")
    several = regions.groupBy("gram").agg(F.min("region").alias("x"), F.max("region").alias("y")).where("x <> y").select("gram", F.lit(True).alias("more"))
    known = regions.join(several, "gram", "left").where("a <> b or more")
    judged = (
        left.join(known, ["gram", "region"])
        .select("t1", "t2", "place", (F.col("a") != F.col("b")).alias("decided"),
                (F.col("more").isNotNull() & ((F.col("a") == F.col("b")) | (F.col("row") == F.col("a")))).alias("open"))
        .where("decided or open").groupBy("t1", "t2").agg(  # at most the rows of one text
            F.collect_set(F.when(F.col("decided"), F.col("place"))).alias("decided"),
            F.collect_set(F.when(F.col("open"), F.col("place"))).alias("open"))
    )
    texts = stored(
        _distinct_in_tasks(long_rows).join(judged, ["t1", "t2"]).groupBy("t1", "t2")
        .agg(*[F.first(c).alias(c) for c in ("text", "decided", "open")]), "texts-with-rows")[0]
    for path in (left_path, regions_path):
        discard(docs.sparkSession, path)
    opening = texts.where(F.size("open") > 0)
    third, third_path = _repeated(_digits(opening, length, last=False), "third-digits", "open")
    starts = _repeated(_digits(opening.drop("open").join(third, ["t1", "t2"]), length, last=True), "windows", "starts")[0]
    discard(docs.sparkSession, third_path)
    # Texts without open rows have all their spans; only the others move again.
    own = ["t1", "t2", "text", "decided"]
    closed = texts.where(F.size("open") == 0).select(*own, F.lit(None).cast("array<bigint>").alias("starts"))
    opened = opening.select(*own).join(starts, ["t1", "t2"], "left").select(*own, "starts")
    cut = _removed(closed.union(opened), length, keep_text)
    copied = long_rows.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t1", "t2", F.lit(True).alias("copied"))
    marked = cut.join(copied, ["t1", "t2"], "full")
    n = F.octet_length("text").cast("long")
    body = F.col("text").cast("binary")
    narrow = rows.select("doc_id", "t1", "t2", n.alias("n_bytes"), F.sha2(body, 256).alias("whole"), *([body.alias("body")] if keep_text else []))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = [
        F.when(F.col("copied"), everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
        F.when(F.col("copied"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    ]
    if keep_text:
        out.append(F.when(F.col("copied"), F.lit("").cast("binary")).otherwise(F.coalesce("kept_bytes", "body")).alias("kept_bytes"))
    return narrow.join(marked, ["t1", "t2"], "left").select("doc_id", "n_bytes", *out)


def digests(docs: DataFrame, length: int = 200) -> DataFrame:
    """Per document its bytes, the removed ones, their runs, and the digest of the rest."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeats(docs, length).select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
