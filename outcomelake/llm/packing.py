"""Operator 13: harmonic packing of token sequences.

A piece of length r belongs to the class k = capacity // r, and every sequence of
class k takes exactly k pieces of its class.  Documents may be cut, so all but a short tail of
a document becomes pieces of capacity / 1, / 2, / 4 and so on, whose sequences are full
to the last token.  Tails shorter than ``finest`` go to their own classes, which leave at
most 1 / (k + 1) of such a sequence empty, k at least capacity / finest.

Every task fills its sequences by itself: there is no shuffle, and a task holds at most
k - 1 pieces of each class.  What is left at its end is cut into powers of two and laid out
from the largest, which fills sequences exactly; the last ones are powers of two themselves.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from outcomelake.llm.common import chunks

CAPACITY, FINEST, END_ID = 1024, 64, 0
#: Slices a worker remembers before it starts anew, and the longest that it remembers.
SLICE_CACHE, SLICE_LENGTH = 500_000, 48
#: Code points sliced at once; bytes of ids in one batch of output.
WINDOW, OUT_BYTES = 1 << 18, 4 << 20
#: Up to here all Unicode versions know the same characters; later ones are compared with the library's.
COMMON = "\u0557"
#: Slices at the end of a window that its end may have changed: a contraction comes apart into two.
UNSURE = 4


def _letters() -> dict[int, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


_LETTERS = _letters()


class SliceTokens:
    """The ids of texts as little-endian unsigned 32-bit bytes; those of a slice are remembered."""

    def __init__(self, tokenizer_json: bytes) -> None:
        self.known: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.slices = regex.compile(public_tokenizers.PATTERN)
        self.common_slices = _common_slices()
        self.later = re.compile(f"[^\0-{COMMON}]")
        self.agreed: dict[str, bool] = {}
        kind = json.loads(tokenizer_json)
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.sliceable = kind["normalizer"] is None and plain.items() <= (kind["pre_tokenizer"] or {}).items()

    def _agrees(self, c: str) -> bool:
        """Whether a character is of the same kind here as in the library, whose Unicode version is another."""
        if c not in self.agreed:
            probe = f"a{c}1{c}!{c} {c}x"
            theirs = [probe[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
            self.agreed[c] = theirs == self.slices.findall(probe)
        return self.agreed[c]

    def ids(self, text: str) -> bytes:
        """The ids of a whole text; it is sliced window by window, so memory stays bounded."""
        later = () if text.isascii() else set(self.later.findall(text))
        if not self.sliceable or not all(map(self._agrees, later)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        findall = (self.slices if later else self.common_slices).findall
        out, at, width = [], 0, WINDOW
        while at < len(text):
            found = findall(text, at, at + width)
            if at + width < len(text):
                if len(found) <= UNSURE:  # a slice longer than the window
                    width *= 2
                    continue
                del found[-UNSURE:]
            out.append(b"".join(map(self._learnt(found).__getitem__, found)))
            at, width = at + sum(map(len, found)), WINDOW
        return b"".join(out)

    def _learnt(self, found: list[str]) -> dict[str, bytes]:
        """Ids of slices, these among them; the library's model merges the new ones."""
        if len(self.known) > SLICE_CACHE:
            self.known = {}
        known = self.known
        new = set(found).difference(known)
        if any(len(w) > SLICE_LENGTH for w in new):  # not remembered, so that memory stays bounded
            known = {w: known[w] for w in set(found).difference(new)}
        merge = self.tokenizer.model.tokenize
        for w in new:
            letters = w.encode("utf-8").decode("latin-1").translate(_LETTERS)
            ids = [t.id for t in merge(letters)]
            known[w] = pack_ids(f"<{len(ids)}I", *ids)
        return known


def _common_slices() -> re.Pattern:
    """The tokeniser's pattern with its classes written out up to ``COMMON``, which the standard module scans faster."""
    kind = {c: unicodedata.category(chr(c))[0] for c in range(ord(COMMON) + 1)}
    white = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0}
    letter, number, space = (
        "".join(f"\\u{c:04x}" for c in sorted(chosen))
        for chosen in ({c for c in kind if kind[c] == "L"}, {c for c in kind if kind[c] == "N"}, white)
    )
    runs = [("\\p{L}", f"[{letter}]"), ("\\p{N}", f"[{number}]"), ("[^\\s\\p{L}\\p{N}]", f"[^{space}{letter}{number}]"),
            ("\\S", f"[^{space}]"), ("\\s", f"[{space}]")]
    pattern = public_tokenizers.PATTERN
    for old, new in sorted(runs, key=lambda r: -len(r[0])):
        pattern = pattern.replace(old, new)
    return re.compile(pattern)


@lru_cache(2)
def _tokens(tokenizer_json: bytes) -> SliceTokens:
    return SliceTokens(tokenizer_json)


def piece_lengths(total: int, capacity: int = CAPACITY, finest: int = FINEST) -> list[int]:
    """How a document of ``total`` tokens is cut: whole sequences, halves and so on down to ``finest``, the tail."""
    whole, rest = divmod(total, capacity)
    out, size = [capacity] * whole, capacity
    while size > finest:
        size //= 2
        if rest >= size:
            out.append(size)
            rest -= size
    return out + [rest] * (rest > 0)


class Bins:
    """The open sequences of one task; a piece is (id, start, ids, tokens of its document)."""

    def __init__(self, first_id: int, capacity: int, finest: int) -> None:
        self.next_id, self.capacity, self.finest = first_id, capacity, finest
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id: object, ids: bytes) -> None:
        start, total = 0, len(ids) // 4
        for n in piece_lengths(total, self.capacity, self.finest):
            k = self.capacity // n
            waiting = self.open.setdefault(k, [])
            waiting.append((doc_id, start, ids[4 * start:4 * (start + n)], total))
            start += n
            if len(waiting) == k:
                self._emit(self.open.pop(k))

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, ids, total, self.next_id, at))
            at += len(ids) // 4
        self.next_id += 1

    def close(self) -> None:
        """Cut what waits into powers of two; laid out from the largest they fill sequences exactly."""
        parts = []
        for doc_id, start, ids, total in (p for k in sorted(self.open) for p in self.open[k]):
            rest = len(ids) // 4
            while rest:
                n = 1 << (rest.bit_length() - 1)
                parts.append((doc_id, start, ids[-4 * rest:][:4 * n], total))
                start, rest = start + n, rest - n
        self.open = {}
        parts.sort(key=lambda p: -len(p[2]))
        left = sum(len(p[2]) // 4 for p in parts)
        sequence, room = [], 0
        for p in parts:
            if not room:
                room = min(self.capacity, 1 << (left.bit_length() - 1))
            sequence.append(p)
            n = len(p[2]) // 4
            room, left = room - n, left - n
            if not room:
                self._emit(sequence)
                sequence = []


def pack(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, finest: int = FINEST,
    end_id: int | None = END_ID, tokenizer_path: str | None = None,
) -> DataFrame:
    """Every document's tokens in pieces, and each piece's place in a sequence of at most ``capacity`` tokens.

    Columns: ``doc_id``, ``start`` (tokens of the document before the piece), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.  ``end_id`` ends every
    document.  ``capacity`` and ``finest`` are powers of two; a smaller ``finest`` pads less and cuts more.

    A null or empty text is its end id alone (no piece without an end id).  Every row is a document of
    its own, also where rows or ids repeat or the id is null.  Other columns are not read.  An empty
    table gives no rows.  Sequence ids are unique, not consecutive, and follow from the row order of the
    input's partitions, so read a table or a checkpoint, not the result of a shuffle, to get them again.
    """
    for name, value in (("capacity", capacity), ("finest", finest)):
        if value < 1 or value & (value - 1):
            raise ValueError(f"{name} = {value} is no power of two")
    with open(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary is bounded: about 2 MB
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    fields = [
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(vocabulary.value)
        bins = Bins(TaskContext.get().partitionId() << 33, capacity, min(finest, capacity))
        id_type = pa.null()

        def take() -> pa.RecordBatch:
            columns = list(zip(*bins.rows)) if bins.rows else [()] * len(names)
            bins.rows = []
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in (part for whole in batches for part in chunks(whole, [1])):
            id_type, size = batch.column(0).type, 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (tokens.ids(value) if value else b"") + end
                bins.add(key, ids)
                size += len(ids)
                if size >= OUT_BYTES:
                    yield take()
                    size = 0
            if bins.rows:
                yield take()
        bins.close()
        if bins.rows:
            yield take()

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, T.StructType(fields))


def _token(raw: str, i: Column) -> Column:
    """The i-th little-endian 32-bit id of ``raw``."""
    digits = F.hex(F.substring(raw, i * 4 + 1, F.lit(4)))
    turned = F.concat(*[F.substring(digits, k, 2) for k in (7, 5, 3, 1)])
    return F.conv(turned, 16, 10).cast("int")


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ``ids`` as an array, ``n_tokens`` used, ``n_padding`` added up to ``capacity``.

    A sequence whose length is a power of two is left as it is.  A group has at most ``capacity`` pieces.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    digits = F.transform(F.sequence(F.lit(0), F.col("n_tokens").cast("int") - 1), lambda i: _token("_raw", i))
    used = F.col("n_tokens")
    power = used.bitwiseAND(used - 1) == 0
    padding = F.when(power, F.lit(0).cast("long")).otherwise(F.lit(capacity) - used)
    out = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("_raw"))
    filled = F.concat(digits, F.array_repeat(F.lit(pad_id), F.col("n_padding").cast("int")))
    return out.withColumn("n_padding", padding).select("sequence_id", filled.alias("ids"), "n_tokens", "n_padding")
