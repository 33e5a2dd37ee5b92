"""Operator 12: the best documents for every item by term weights, with two trees.

Items and documents are vectors over the items' terms: an item has ones, a document the
weight that each of its terms would add to a score.  Both are put into trees by halving
them at the term that most nearly half of them have.  A node holds the maximum of every
coordinate below it, so the product of two nodes' maxima bounds every score between them.
A pair of nodes whose bound is below the weakest of its items' k-th scores is left out whole;
the others go one level down in both trees, and single documents are scored exactly.

The trees of items are built once and sent to the tasks; each task builds trees of its
documents batch by batch and keeps the k best of every item that it has seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from outcomelake.llm.common import append_columns, materialize

K = 50
#: Children of a node in both trees; items in a tree; documents in one, and in one of its leaves.
FAN, ITEMS, BATCH, LEAF = 8, 256, 1024, 16
#: Bytes of item texts that one pass over the documents serves, so that what is sent to the tasks is bounded.
ITEM_BYTES = 4 << 20
#: Bytes of a text that are cut into terms at once.
WINDOW = 1 << 20
#: Coordinates whose sum stays exact in doubles: each is below 2^36.
EXACT = 1 << 16
#: Bounds are sums of doubles, so they get this much room.
ROOM = 1 + 1e-9

# Everything but digits, letters and what is not ASCII separates terms; A to Z become small.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def term_counts(raw: bytes) -> tuple[int, Counter]:
    """How many terms a UTF-8 text has, and how often it has each."""
    counts: Counter = Counter()
    at = 0
    while at < len(raw):
        window = raw[at:at + WINDOW].translate(_TERM_BYTES)
        if at + WINDOW < len(raw):
            cut = window.rfind(b" ")
            if cut < 0:  # one term beyond the window: up to its end
                end = at + WINDOW
                while end < len(raw) and raw[end:end + 1].translate(_TERM_BYTES) != b" ":
                    end += 1
                window = raw[at:end].translate(_TERM_BYTES)
            else:
                window = window[:cut]
        counts.update(window.split())
        at += max(1, len(window))
    return counts.total(), counts


class Sparse(NamedTuple):
    """Rows of coordinates: row r has ``columns[starts[r]:starts[r + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the entries of ``rows``, and the place in ``rows`` that each belongs to."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        ends = np.cumsum(sizes)
        inside = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
        return self.starts[rows][owner] + inside, owner


def sparse(rows: list[np.ndarray]) -> Sparse:
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return Sparse(starts, np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64))


def tree_order(table: Sparse, leaf: int) -> np.ndarray:
    """The rows in the order of the leaves of a tree; every node but the last of a level is full.

    A node is halved at the term that most nearly half of its rows have: those with it come first.
    """
    order = np.arange(len(table.starts) - 1)
    nodes = [(0, len(order))]
    while nodes:
        a, b = nodes.pop()
        if b - a <= leaf:
            continue
        rows = order[a:b]
        half = leaf << (math.ceil(math.log2((b - a) / leaf)) - 1)
        at, owner = table.take(rows)
        columns = table.columns[at]
        if len(columns):
            present = np.bincount(columns)
            term = int(np.argmin(np.abs(present - half)))
            has = np.zeros(b - a, bool)
            has[owner[columns == term]] = True
            order[a:b] = np.concatenate([rows[has], rows[~has]])
        nodes += [(a, a + half), (a + half, b)]
    return order


class ItemTree(NamedTuple):
    """At most ``ITEMS`` items: their numbers in tree order, their terms (local numbers), each local term's number."""

    numbers: np.ndarray
    terms: Sparse
    vocabulary: np.ndarray


def item_trees(items: list[np.ndarray]) -> list[ItemTree]:
    """Trees over items given by their terms' numbers; items without terms are in none."""
    numbers = np.array([i for i, t in enumerate(items) if len(t)], np.int64)
    table = sparse([items[i] for i in numbers])
    order = tree_order(table, FAN)
    out = []
    for at in range(0, len(order), ITEMS):
        rows = order[at:at + ITEMS]
        own = [items[numbers[r]] for r in rows]
        vocabulary = np.unique(np.concatenate(own))
        out.append(ItemTree(numbers[rows], sparse([np.searchsorted(vocabulary, t) for t in own]), vocabulary))
    return out


def _runs(matrix: np.ndarray, size: int) -> np.ndarray:
    """Maxima of runs of rows."""
    return np.maximum.reduceat(matrix, np.arange(0, len(matrix), size), axis=0)


def _children(nodes: np.ndarray, size: int, total: int) -> np.ndarray:
    """Rows below nodes of ``size`` rows."""
    rows = (nodes[:, None] * size + np.arange(size)).ravel()
    return rows[rows < total]


def search(tree: ItemTree, docs: np.ndarray, weakest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document rows, item rows and scores of all pairs that reach ``weakest`` of their item.

    ``docs`` (rows in tree order, local terms) and the items go down together: batch and ``FAN``^2
    items, ``FAN`` leaves and ``FAN`` items, leaf and item, single documents.
    """
    n, terms = len(tree.numbers), docs.shape[1]
    ones = np.zeros((n, terms))
    ones[np.repeat(np.arange(n), np.diff(tree.terms.starts)), tree.terms.columns] = 1
    families, clans = _runs(ones, FAN), _runs(ones, FAN * FAN)
    floor_item = weakest[tree.numbers].astype(np.float64)
    floor_family = np.minimum.reduceat(floor_item, np.arange(0, n, FAN))
    floor_clan = np.minimum.reduceat(floor_item, np.arange(0, n, FAN * FAN))
    leaves = _runs(docs, LEAF)
    branches = _runs(leaves, FAN)
    alive = np.flatnonzero(clans @ branches.max(axis=0) * ROOM >= floor_clan)
    alive = _children(alive, FAN, len(families))
    for b in range(len(branches)):
        near = alive[families[alive] @ branches[b] * ROOM >= floor_family[alive]]
        if not len(near):
            continue
        items = _children(near, FAN, n)
        below = leaves[b * FAN:(b + 1) * FAN]
        reached = below @ ones[items].T * ROOM >= floor_item[items]
        for k in np.flatnonzero(reached.any(axis=1)).tolist():
            at = (b * FAN + k) * LEAF
            wanted, rows = items[reached[k]], docs[at:at + LEAF]
            scores = np.zeros((len(rows), len(wanted)), np.int64)
            for c in range(0, terms, EXACT):
                scores += np.rint(rows[:, c:c + EXACT] @ ones[wanted, c:c + EXACT].T).astype(np.int64)
            d, i = np.nonzero(scores >= weakest[tree.numbers[wanted]])
            if len(d):
                yield at + d, wanted[i], scores[d, i]


def contributions(tf: np.ndarray, lengths: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each entry adds to a score; ``lengths`` are those of the entries' documents."""
    wide = 50 * int(lengths.max(initial=0)) * n_docs >= 1 << 63
    m = 50 + (50 * (lengths.astype(object) if wide else lengths) * n_docs) // n_terms
    return (weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))).astype(np.float64)


class Best:
    """The k best documents of every item so far."""

    def __init__(self, n_items: int, k: int, id_type: pa.DataType) -> None:
        self.k, self.kept, self.waiting, self.n_waiting = k, None, [], 0
        self.weakest = np.ones(n_items, np.int64)  # a score has to be above 0
        self.schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("doc_id", id_type)])

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: pa.Array) -> None:
        self.waiting.append(pa.table([pa.array(item), pa.array(score), doc_id], schema=self.schema))
        self.n_waiting += len(item)

    def settle(self, at_least: int = 0) -> None:
        """Merge what waits, once it is worth it."""
        held = 0 if self.kept is None else self.kept.num_rows
        if not self.n_waiting or self.n_waiting < min(at_least, held // 4):
            return
        both = pa.concat_tables(([] if self.kept is None else [self.kept]) + self.waiting)
        self.waiting, self.n_waiting = [], 0
        both = both.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        item = both["item"].to_numpy()
        first = np.flatnonzero(np.diff(item, prepend=-1))
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        last = rank == self.k - 1
        self.weakest[item[last]] = both["score"].to_numpy()[last]
        self.kept = both.filter(pa.array(rank < self.k))


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], text: str, doc_id: str) -> DataFrame:
    """Per document: how many terms it has, which of the vocabulary and how often."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def fill(columns: dict[str, pa.Array]) -> list[pa.Array]:
        numbers, sizes, terms, times = known.value, [], [], []
        for raw in columns["_text"].to_pylist():
            n, counts = term_counts(raw or b"")
            found = sorted((numbers[t], c) for t, c in counts.items() if t in numbers)
            sizes.append(n)
            terms.append([t for t, _ in found])
            times.append([c for _, c in found])
        return [pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("_text"))
    fields = [
        T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ]
    return append_columns(chosen, fields, fill, ["_text"], keep=["doc_id"])


def _best_of_tasks(found: DataFrame, trees: list[ItemTree], weights: np.ndarray, n_items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    sent = found.sparkSession.sparkContext.broadcast((trees, weights))
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), T.StructField("doc_id", found.schema["doc_id"].dataType),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, weights = sent.value
        best = None
        for whole in batches:
            best = best or Best(n_items, k, whole.schema.field("doc_id").type)
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                lists = batch.column(2)
                rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                terms = lists.flatten().to_numpy().astype(np.int64)
                tf, lengths = batch.column(3).flatten().to_numpy(), batch.column(1).to_numpy()
                adds = contributions(tf, lengths[rows], weights[terms], n_docs, n_terms)
                for tree in trees:
                    place = np.searchsorted(tree.vocabulary, terms)
                    place[place == len(tree.vocabulary)] = 0
                    own = tree.vocabulary[place] == terms
                    docs = np.zeros((batch.num_rows, len(tree.vocabulary)))
                    docs[rows[own], place[own]] = adds[own]
                    starts = np.searchsorted(rows[own], np.arange(batch.num_rows + 1))
                    order = tree_order(Sparse(starts, place[own]), LEAF)
                    for d, i, score in search(tree, docs[order], best.weakest):
                        best.add(tree.numbers[i], score, batch.column(0).take(pa.array(order[d])))
                best.settle(at_least=1 << 16)
        if best is not None:
            best.settle()
            if best.kept is not None:
                yield from best.kept.combine_chunks().to_batches()

    return found.select("doc_id", "n", "terms", "times").where(F.size("terms") > 0).mapInArrow(run, schema)


def rank(
    docs: DataFrame, items: DataFrame, k: int = K, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score`` (above 0).

    Terms are runs of ASCII letters and digits and of all that is not ASCII; only A to Z are lower-cased.
    Equal scores go by ascending id, null ids last.  Null or empty texts have no term: such a document is in no result
    and counts nowhere, such an item has no rows.  Rows that repeat are documents, or items, of their
    own.  Other columns are not read.  Without documents or items there are no rows.

    Items go in groups of about ``ITEM_BYTES`` of text, by hash; each group is one pass over the documents that
    keeps, as a table, which of the group's terms each document has, and one that searches it.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("_text")).where("_text is not null")
    total = wanted.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    groups = -(-total // ITEM_BYTES)
    schema = T.StructType([
        T.StructField("item_id", items.schema[item_id].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType()),
    ])
    out = spark.createDataFrame([], schema)
    for g in range(groups):
        own = wanted.where(F.pmod(F.xxhash64("_text"), F.lit(groups)) == g).collect()
        counts = [sorted(term_counts(r._text.encode())[1]) for r in own]
        words = sorted({t for ts in counts for t in ts})
        if not words:
            continue
        numbers = {t: i for i, t in enumerate(words)}
        found = materialize(vectors(docs, numbers, text, doc_id), "item-terms")
        size = found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not size[0]:
            continue
        held = np.zeros(len(words), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            held[r.t] = r.df
        weights = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * int(d) + 1))) for d in held], np.int64)
        trees = item_trees([np.array([numbers[t] for t in ts], np.int64) for ts in counts])
        best = _best_of_tasks(found, trees, weights, len(own), size[0], size[1], k)
        by_rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
        fields = T.StructType([T.StructField("item", T.LongType()), schema["item_id"]])
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(own)], fields)
        out = out.union(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


_TERMS_SQL = """regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

ORACLE_SQL = f"""
WITH words AS MATERIALIZED (SELECT doc_id, {_TERMS_SQL.format("text")} AS t FROM documents),
  sizes AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM words),
  wanted AS MATERIALIZED (
    SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS_SQL.format("text")}) AS term FROM benchmark)),
  tf AS MATERIALIZED (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM words)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
  weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), sizes),
  scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN tf USING (term), sizes GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0) WHERE rank <= {K}"""
