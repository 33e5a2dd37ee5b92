"""Operator 6: near-duplicate vectors by an epsilon grid order join.

Unit vectors are at most epsilon apart exactly when their cosine reaches the threshold.
They are sorted by label and by grid cells of width epsilon on the leading principal
dimensions, and cut into intervals.  Pairs of intervals whose boxes are further apart
than epsilon are provably without links; the others are joined recursively, halves
that lie too far apart being skipped, down to small blocks that are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelake.llm.common import materialize
from outcomelake.llm.components import components

#: Rows of an interval, rows compared in full, leading dimensions of the grid.
INTERVAL, SMALL, LEADING = 1024, 64, 4
#: Dimensions that the principal axes are taken from, and lengths of vectors that get axes of their own.
AXES_FROM, LENGTHS = 256, 8
#: Added to epsilon, so that rounding never makes a distance look too long.
SLACK = 1e-6


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the keys of their class (equal label and vector), and the classes of vectors that can link.

    Vectors that are null, empty, zero or hold a null or a non-finite component, and
    rows of null label or id, are in no class.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    keyed = vectors.select("vec_id", "label", v.alias("v"), sound.alias("sound")).select(
        "vec_id", "label", "v", "sound",
        F.when(F.col("sound"), F.xxhash64(F.lit(1), "label", "v")).alias("k1"),
        F.when(F.col("sound"), F.xxhash64("v", "label", F.lit(2))).alias("k2"),
    )
    found = keyed.where("sound").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("label").alias("label"), F.first("v").alias("v"))
    return keyed.select("vec_id", "k1", "k2"), found


def _unit(lists: pa.Array, dim: int) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    """Vector lengths in a batch, and the rows of each."""
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        yield int(dim), np.flatnonzero(lengths == dim)


def principal_axes(found: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal axes of the unit vectors of each of the most frequent lengths.

    Second moments are summed over all vectors in tasks; what the driver gets is bounded by
    ``LENGTHS`` and ``AXES_FROM``.  Other lengths do without: their first dimensions serve.
    """
    lengths = [r["d"] for r in found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(LENGTHS).collect()]
    wanted = set(lengths)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, rows in _by_length(batch, "v"):
                if dim in wanted:
                    x = _unit(batch.column("v").take(pa.array(rows)), dim)[:, :AXES_FROM]
                    sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, s in sums.items():
            n = s.size
            yield pa.RecordBatch.from_arrays([pa.array([dim] * n), pa.array(range(n)), pa.array(s.ravel())], names=["d", "at", "x"])

    rows = found.select("v").mapInArrow(moments, "d bigint, at bigint, x double").groupBy("d", "at").agg(F.sum("x").alias("x")).collect()
    axes = {}
    for dim in wanted:
        side = min(dim, AXES_FROM)
        second = np.zeros(side * side)
        for r in rows:
            if r["d"] == dim:
                second[r["at"]] = r["x"]
        _, vectors = np.linalg.eigh(second.reshape(side, side))
        axes[dim] = vectors[:, ::-1][:, :LEADING].copy()
    return axes


def intervals(found: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """The classes in epsilon grid order, as a written table, each row with its interval."""
    on = [f"c{k}" for k in range(LEADING)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_length(batch, "v"):
                part = batch.take(pa.array(rows))
                x = _unit(part.column("v"), dim)
                at = x[:, :AXES_FROM] @ axes[dim] if dim in axes else x[:, :LEADING]
                at = np.pad(at, ((0, 0), (0, LEADING - at.shape[1])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("rep", "size", "label")] + [pa.array([dim] * len(x)), pa.array([r.tobytes() for r in x])]
                    + [pa.array(np.ascontiguousarray(at[:, k])) for k in range(LEADING)],
                    names=["rep", "size", "label", "dim", "unit", *on])

    kind = dict(found.dtypes)
    placed = found.select("rep", "size", "label", "v").mapInArrow(
        place, f"rep {kind['rep']}, size bigint, label {kind['label']}, dim bigint, unit binary, " + ", ".join(f"{c} double" for c in on))
    order = ["label", "dim", *[F.floor(F.col(c) / epsilon) for c in on], "rep"]
    names = [*placed.columns]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, filled, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            out = []
            for key in zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist()):
                if key != last or filled == INTERVAL:
                    number, filled, last = number + 1, 0, key
                filled += 1
                out.append((part << 32) + number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*names, "interval"])

    fields = ", ".join(f"{c} {t}" for c, t in placed.dtypes) + ", interval bigint"
    # Written first: range bounds are drawn from a sample, which then reads a table.
    ordered = materialize(placed, "vectors").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(cut, fields), "intervals")


def interval_pairs(rows: DataFrame, epsilon: float) -> DataFrame:
    """Pairs of intervals (``a`` <= ``b``) of one label whose boxes are at most epsilon apart.

    Only intervals that share a cell of the first dimension, one of them widened by
    epsilon, meet in the join.
    """
    on = [f"c{k}" for k in range(LEADING)]
    boxes = rows.groupBy("interval", "label", "dim").agg(*[f(c).alias(f"{n}{k}") for k, c in enumerate(on) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    cell = lambda x: F.floor(x / epsilon)
    left = boxes.withColumn("cell", F.explode(F.sequence(cell(F.col("lo0")), cell(F.col("hi0"))))).alias("a")
    right = boxes.withColumn("cell", F.explode(F.sequence(cell(F.col("lo0") - epsilon), cell(F.col("hi0") + epsilon)))).alias("b")
    gap = sum(
        (F.pow(F.greatest(F.lit(0.0), F.col(f"a.lo{k}") - F.col(f"b.hi{k}"), F.col(f"b.lo{k}") - F.col(f"a.hi{k}")), F.lit(2.0)) for k in range(LEADING)),
        F.lit(0.0))
    met = left.join(right, (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.cell") == F.col("b.cell")))
    near = met.where(gap <= epsilon * epsilon)
    x, y = F.col("a.interval"), F.col("b.interval")
    return near.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _join(x: np.ndarray, at: np.ndarray, y: np.ndarray, bt: np.ndarray, epsilon: float, offset: tuple[int, int]) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of two sequences that may hold links: halve what is large, skip what is too far apart."""
    gap = np.maximum(0, np.maximum(at.min(0) - bt.max(0), bt.min(0) - at.max(0)))
    if (gap * gap).sum() > epsilon * epsilon:
        return
    if max(len(x), len(y)) <= SMALL:
        yield offset[0], offset[0] + len(x), offset[1], offset[1] + len(y)
        return
    if len(x) >= len(y):
        h = len(x) // 2
        yield from _join(x[:h], at[:h], y, bt, epsilon, offset)
        yield from _join(x[h:], at[h:], y, bt, epsilon, (offset[0] + h, offset[1]))
    else:
        h = len(y) // 2
        yield from _join(x, at, y[:h], bt[:h], epsilon, offset)
        yield from _join(x, at, y[h:], bt[h:], epsilon, (offset[0], offset[1] + h))


def links_of_pair(rows: pd.DataFrame, threshold: float, epsilon: float) -> pd.DataFrame:
    """Of two intervals (or one with itself): per class the vectors linked to it here, and the least class it is tied to here."""
    on = [f"c{k}" for k in range(LEADING)]
    sides = [r for _, r in rows.groupby("side")]
    one = len(sides) == 1
    a, b = sides[0], sides[-1]
    x, y = (np.frombuffer(b"".join(s["unit"]), np.float64).reshape(len(s), -1) for s in (a, b))
    na, nb = (np.sqrt((s * s).sum(1)) for s in (x, y))
    ids = np.concatenate([a["rep"].to_numpy(), b["rep"].to_numpy()])
    links, shift = np.zeros(len(ids), np.int64), 0 if one else len(a)
    size_a, size_b = a["size"].to_numpy(), b["size"].to_numpy()
    parent = list(range(len(ids)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for p, q, r, s in _join(x, a[on].to_numpy(), y, b[on].to_numpy(), epsilon, (0, 0)):
        near = (x[p:q] @ y[r:s].T) / np.outer(na[p:q], nb[r:s]) >= threshold
        i, j = np.nonzero(near)
        i, j = i + p, j + r
        if one:
            i, j = i[i != j], j[i != j]  # every ordered pair occurs
            np.add.at(links, i, size_b[j])
        else:
            np.add.at(links, i, size_b[j])
            np.add.at(links, j + shift, size_a[i])
        for u, v in zip(i.tolist(), (j + shift).tolist()):
            u, v = root(u), root(v)
            if u != v:
                if ids[u] > ids[v]:
                    u, v = v, u
                parent[v] = u
    linked = np.flatnonzero(links)
    return pd.DataFrame({"rep": ids[linked], "links": links[linked], "tied": [ids[root(int(k))] for k in linked]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors link when their labels are equal and not null, their lengths are equal and their
    cosine reaches ``threshold``.  Vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing, nor do rows of null id, whose
    ``component_id`` is null and ``kept`` true.  Rows that share an id are one node.
    Equal vectors are compared once, and count as often as they occur.  A task gets two
    intervals, so its input is bounded, however many vectors are alike.
    """
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    keyed, found = classes(vectors)
    found = materialize(found, "classes")
    rows = intervals(found, principal_axes(found), epsilon)
    pairs = materialize(interval_pairs(rows, epsilon), "interval-pairs")
    sides = pairs.select("a", "b", F.col("a").alias("interval"), F.lit(0).alias("side")).union(
        pairs.where("a <> b").select("a", "b", F.col("b").alias("interval"), F.lit(1).alias("side")))
    members = sides.join(rows.drop("label", "dim"), "interval")
    rep = dict(found.dtypes)["rep"]

    def join(group: pd.DataFrame) -> pd.DataFrame:
        return links_of_pair(group, threshold, epsilon)

    links = materialize(members.groupBy("a", "b").applyInPandas(join, f"rep {rep}, links bigint, tied {rep}"), "links")
    per_class = links.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("rep").alias("u"), F.col("tied").alias("v")))
    known = (
        found.select("k1", "k2", "rep", "size").join(per_class, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("k1", "k2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    out = keyed.join(known, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(u, v) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), least AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
counted AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN least ON least.u = e.vec_id LEFT JOIN counted ON counted.u = e.vec_id
"""
