"""Operator 3: byte-level BPE encoding and decoding without a regular expression.

Pre-tokenisation is a finite automaton.  Every code point becomes a class, every
position a transition function, and transition functions compose associatively;
so the automaton's state at all positions of a block of texts comes from one
blocked scan over compositions.  The slices between token starts are merged by
rank, each distinct slice once, and remembered.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import lru_cache
from itertools import chain
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns

#: Code points scanned together; whole texts only, so a longer text is a block of its own.
BLOCK = 1 << 19
#: Slices a worker remembers before it starts anew, and the longest that it remembers.
SLICE_CACHE, SLICE_LENGTH = 300_000, 64
#: Above every rank.
NO_RANK = (1 << 31) - 1

# Classes of code points.
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# Symbols: a class with what the automaton has to know of the next code points.
S_OTHER, S_LETTER, S_NUMBER, S_QUOTE1, S_QUOTE2, S_BLANK, S_LAST, S_INNER, S_END = range(9)
# States: a new token starts next; inside a run of one kind; after a blank that leads a
# token; one or two more letters belong to a contraction; inside white space.
NEW, IN_LETTER, IN_NUMBER, IN_OTHER, LED, MORE1, MORE2, IN_SPACE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token starts at this position."""
    if symbol == S_END:
        return NEW, False
    if state in (MORE1, MORE2):
        return (NEW, MORE1)[state - MORE1], False
    if symbol == S_BLANK:  # a blank before other than white space leads the next token
        return LED, True
    if symbol == S_LAST:  # the last of the white space, no blank: a token of its own
        return NEW, True
    if symbol == S_INNER:
        return IN_SPACE, state != IN_SPACE
    if symbol in (S_QUOTE1, S_QUOTE2) and state not in (IN_OTHER, LED):
        return (MORE1, MORE2)[symbol - S_QUOTE1], True
    run = {S_LETTER: IN_LETTER, S_NUMBER: IN_NUMBER}.get(symbol, IN_OTHER)
    return run, state not in (run, LED)


@lru_cache(None)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each symbol's function, the table of compositions, each function's state from NEW, start flags."""
    symbols = [tuple(_step(s, a)[0] for s in range(8)) for a in range(9)]
    known = {tuple(range(8)): 0}
    queue = list(known)
    for f in queue:  # all functions that sequences of symbols make
        for g in symbols:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    size = len(known)
    compose = np.zeros(size * size, np.int32)
    for f, i in known.items():
        for g, j in known.items():
            compose[i * size + j] = known[tuple(g[s] for s in f)]
    starts = np.array([[_step(s, a)[1] for a in range(9)] for s in range(8)])
    from_new = np.zeros(size, np.int8)
    for f, i in known.items():
        from_new[i] = f[NEW]
    return np.array([known[f] for f in symbols], np.int32), compose, from_new, starts.ravel()


@lru_cache(None)
def _classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    # Unicode White_Space.
    white = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    out[white] = SPACE
    return out


def _scan(functions: np.ndarray) -> np.ndarray:
    """The function composed of all up to each position, inclusive."""
    _, compose, _, _ = _automaton()
    size, n = int(len(compose) ** 0.5), len(functions)
    width = max(1, int(n ** 0.5))
    lanes = -(-n // width)
    padded = np.zeros(lanes * width, np.int32)  # 0 is the identity
    padded[:n] = functions
    part = np.ascontiguousarray(padded.reshape(lanes, width).T)
    for k in range(1, width):
        part[k] = compose[part[k - 1] * size + part[k]]
    before, total = np.zeros(lanes, np.int32), 0
    for lane, last in enumerate(part[-1].tolist()):
        before[lane] = total
        total = compose[total * size + last]
    return compose[(before * size)[None, :] + part].T.ravel()[:n]


def token_starts(texts: list[str]) -> list[np.ndarray]:
    """For each text the code-point offsets at which slices start."""
    functions, _, from_new, starts = _automaton()
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind = _classes()[points]
    kind[ends] = 9
    follows = np.append(kind[1:], 9)
    symbol = np.array([S_OTHER, S_LETTER, S_NUMBER, S_INNER, 0, 0, 0, 0, 0, S_END], np.int8)[kind]
    last = (kind == SPACE) & (follows < SPACE)
    symbol[last] = np.where(points[last] == 0x20, S_BLANK, S_LAST)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        one, two = (np.append(points, [0, 0, 0])[quote + k] for k in (1, 2))
        letter = lambda at, of: np.isin(at, [ord(c) for c in of])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        symbol[quote[letter(one, "stmd")]] = S_QUOTE1
        symbol[quote[pair]] = S_QUOTE2
    composed = _scan(functions[symbol])
    state = np.empty(len(points), np.int64)
    state[0] = NEW
    state[1:] = from_new[composed[:-1]]
    at = np.flatnonzero(starts[state * 9 + symbol])
    cuts = np.searchsorted(at, ends)
    begins = np.append(0, ends[:-1] + 1)
    return [at[a:b] - s for a, b, s in zip(np.append(0, cuts[:-1]), cuts, begins)]


class Vocabulary:
    """Ranks of byte strings; merges the adjacent pair of lowest rank, the leftmost first, until none has a rank.

    Distinct slices are merged once and remembered in two generations.  New slices
    of a block are merged together, one merge of every slice at a time.
    """

    def __init__(self, rank_file: bytes) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.ranks, self.bytes = ranks, {rank: token for token, rank in ranks.items()}
        top = max(self.bytes) + 1
        self.lengths = np.zeros(top, np.int32)
        for rank, token in self.bytes.items():
            self.lengths[rank] = len(token)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.top = top
        self.slots = 0
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.older: dict[str, bytes] = {}

    def _store_pairs(self) -> None:
        """A hash table of all pairs of tokens that make a token."""
        pairs = [
            (self.ranks[token[:k]] * self.top + self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items() for k in range(1, len(token)) if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        self.slots = 1 << (len(pairs) * 4).bit_length()
        self.keys, self.values = np.full(self.slots, -1, np.int64), np.full(self.slots, NO_RANK, np.int32)
        keys, values = (np.array(x, np.int64) for x in zip(*pairs))
        slot = self._slot(keys)
        while len(keys):  # open addressing: who loses a slot moves on
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            lost = self.keys[slot] != keys
            keys, values, slot = keys[lost], values[lost], (slot[lost] + 1) & (self.slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.top + right
        slot = self._slot(keys)
        out, found = self.values[slot], self.keys[slot]
        open_at = np.nonzero((found != keys) & (found >= 0))
        while len(open_at[0]):
            slot[open_at] = (slot[open_at] + 1) & (self.slots - 1)
            found[open_at] = self.keys[slot[open_at]]
            out[open_at] = self.values[slot[open_at]]
            more = (found[open_at] != keys[open_at]) & (found[open_at] >= 0)
            open_at = tuple(x[more] for x in open_at)
        out[found < 0] = NO_RANK
        return out

    def _merge_equal(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Slices of at most ``width`` bytes, merged in step."""
        if not self.slots:
            self._store_pairs()
        count = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
        length = np.array([len(p) for p in pieces])
        ids = np.zeros((count, width + 1), np.int32)
        ids[:, :width] = self.single[raw]
        rank = np.full((count, width + 1), NO_RANK, np.int32)
        rank[:, :width - 1] = self._pair_ranks(ids[:, :width - 1], ids[:, 1:width])
        place = np.arange(width)
        rank[:, :width][place >= (length - 1)[:, None]] = NO_RANK
        out: list[tuple[int, ...]] = [()] * count
        rows = np.arange(count)
        while len(rows):
            at = rank.argmin(1)
            low = rank[np.arange(len(rows)), at]
            done = low == NO_RANK
            if done.any():
                for r, n, line in zip(rows[done].tolist(), length[done].tolist(), ids[done].tolist()):
                    out[r] = tuple(line[:n])
                live = ~done
                rows, ids, rank, length, at, low = rows[live], ids[live], rank[live], length[live], at[live], low[live]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            ids[every, at] = low
            after = place > at[:, None]
            ids[:, :width] = np.where(after, ids[:, 1:], ids[:, :width])
            rank[:, :width] = np.where(after, rank[:, 1:], rank[:, :width])
            length = length - 1
            fresh = self._pair_ranks(low, ids[every, at + 1])
            rank[every, at] = np.where(at + 1 < length, fresh, NO_RANK)
            inner = at > 0
            rank[every[inner], at[inner] - 1] = self._pair_ranks(ids[every[inner], at[inner] - 1], low[inner])
        return out

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """One slice by a heap of adjacent pairs over a linked list: n log n for any length."""
        ranks, n = self.ranks, len(piece)
        part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, length = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or len(part[i]) + len(part[j]) != length:
                continue  # one of the two was merged meanwhile
            part[i] += part[j]
            part[j], after[i] = None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n:
                    joined = part[left] + part[right]
                    if (r := ranks.get(joined)) is not None:
                        heapq.heappush(heap, (r, left, len(joined)))
        return tuple(ranks[p] for p in part if p is not None)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = (self.ranks[p],)
            elif len(p) > SLICE_LENGTH:
                out[i] = self._merge_long(p)
            else:
                groups.setdefault(max(4, -(-len(p) // 4) * 4), []).append(i)
        for width, members in groups.items():
            for i, ids in zip(members, self._merge_equal([pieces[i] for i in members], width)):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        slices = []
        for text, starts in zip(texts, token_starts(texts)):
            at = starts.tolist()
            slices.append(list(map(text.__getitem__, map(slice, at, at[1:] + [len(text)]))))
        if len(self.known) >= SLICE_CACHE:
            self.known, self.older = {}, self.known
        fresh = set(chain.from_iterable(slices)).difference(self.known)
        again = fresh.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new = list(fresh.difference(again))
        for piece, ids in zip(new, self.merge([p.encode("utf-8") for p in new])):
            self.known[piece] = pack(f"={len(ids)}i", *ids)
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, s)), np.int32) for s in slices]
        for p in new:
            if len(p) > SLICE_LENGTH:
                del self.known[p]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(2)
def _vocabulary(rank_file: bytes) -> Vocabulary:
    return Vocabulary(rank_file)


def _ranks(df: DataFrame, path: str | None):
    """The rank file's bytes, sent once to every executor (a vocabulary is bounded: about 1 MB)."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, text: str = "text", rank_path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add ``ids`` (token ids) and ``offsets`` (each token's first byte in the UTF-8 text).

    Null and empty texts give empty lists.  Each row stands alone, so repeated rows
    repeat, and other columns pass; existing columns ``ids`` and ``offsets`` are replaced.
    ``keep`` names the columns to pass on.
    """
    ranks = _ranks(docs, rank_path)

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        vocabulary = _vocabulary(ranks.value)
        texts = [t or "" for t in columns[text].to_pylist()]
        ids, block, size = [], [], 0
        for t in texts:
            block.append(t)
            size += len(t)
            if size >= BLOCK:
                ids += vocabulary.encode(block)
                block, size = [], 0
        if block:
            ids += vocabulary.encode(block)
        offsets = [np.cumsum(lengths := vocabulary.lengths[i]) - lengths for i in ids]
        return [_lists(ids), _lists(offsets)]

    array = T.ArrayType(T.IntegerType())
    return append_columns(docs, [T.StructField("ids", array), T.StructField("offsets", array)], fill, [text], keep)


def decode(tokens: DataFrame, rank_path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add ``decoded``, the bytes that ``ids`` stand for; null and empty lists give no bytes."""
    ranks = _ranks(tokens, rank_path)

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        vocabulary = _vocabulary(ranks.value)
        lists = columns["ids"]
        values, out = lists.flatten().to_numpy(zero_copy_only=False).tolist(), []
        at = 0
        for n in lists.value_lengths().fill_null(0).to_pylist():
            out.append(vocabulary.decode(values[at:at + n]))
            at += n
        return [pa.array(out, pa.binary())]

    return append_columns(tokens, [T.StructField("decoded", T.BinaryType())], fill, ["ids"], keep)


def digests(docs: DataFrame, rank_path: str | None = None) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the bytes decoded from them."""
    ids = encode(docs.select("doc_id", "text"), rank_path=rank_path, keep=["doc_id"])
    back = decode(ids.select("doc_id", "ids"), rank_path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
