"""Operator 11: vectors as codes, one small codebook per part, by ball k-means in whole numbers.

The vectors of a codebook entry are a ball around it.  Another entry can take a vector from
the ball only where the ball's radius reaches half way to it: these are the ball's neighbours.
Vectors nearer to their entry than half way to the nearest neighbour are its stable core
and keep their entry without a comparison.  The others lie in rings: with the neighbours in
order of distance, a vector is compared only with those whose half way it has passed.

All of it is exact.  With D the squared distance of two entries and d that of a vector to
its entry, another entry is strictly farther where D > 4 d, so ties still reach the comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import discard, scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Numbers of vector components that a task holds at once beside Spark's batch.
BLOCK = 1 << 20
#: The code of a part that has no entry yet.
NONE = 255


class Codes(NamedTuple):
    """``rows``: vec_id, label, code, error; ``codebooks[part][entry]``: its whole-number components."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


def whole_numbers(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """``_x``: floor of every component times ``scale``; rows that cannot be compared are left out."""
    too_large = F.raise_error(F.lit(f"a component times {scale} leaves 64 bits")).cast("long")
    number = lambda c: F.when(F.abs(c) < 2.0 ** 62, F.floor(c).cast("long")).otherwise(too_large)
    x = F.col(vector).cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    kept = vectors.where(F.col(vector).isNotNull()).where(~F.exists(x, bad))
    return kept.withColumn("_x", F.transform(x, lambda c: number(c * float(scale))))


def assign(x: np.ndarray, codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row of ``x`` and its squared distance; ``codes`` says whose ball a row is in.

    Any ball is a right start: the nearer its entry, the fewer comparisons.
    """
    found, error = codes.copy(), np.zeros(len(x), x.dtype)
    between = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    for home in np.unique(codes).tolist():
        ball = np.flatnonzero(codes == home)
        d = ((x[ball] - book[home]) ** 2).sum(axis=1)
        best, entry = d.copy(), np.full(len(ball), home, codes.dtype)
        near = np.flatnonzero(between[home] <= 4 * d.max())
        near = near[near != home]
        near = near[np.argsort(between[home][near], kind="stable")]
        ring = np.arange(len(ball))
        for other in near.tolist():
            # Rings are nested: who has not passed this half way passes none of the later ones.
            ring = ring[between[home][other] <= 4 * d[ring]]
            if not len(ring):
                break
            e = ((x[ball[ring]] - book[other]) ** 2).sum(axis=1)
            better = (e < best[ring]) | ((e == best[ring]) & (other < entry[ring]))
            best[ring[better]], entry[ring[better]] = e[better], other
        found[ball], error[ball] = entry, best
    return found, error


def _numbers(lists: pa.Array, dims: int, reach: int) -> np.ndarray:
    """Rows of components; Python integers where squares, or those of entries within ``reach``, could leave 64 bits."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dims)
    reach = max(1, reach, int(np.abs(flat.astype(np.float64)).max(initial=0.0)))
    return flat if 16 * dims * reach * reach < 1 << 62 else flat.astype(object)


def _pass(state: DataFrame, codebooks: list[list[list[int]]], dims: int) -> DataFrame:
    """Every row with its new codes; the first of each block also with the change of its entries' sums.

    ``change`` has one number per part, entry and component, the last component being the
    number of rows: what enters an entry is added, what leaves it is taken off.
    """
    parts, width = len(codebooks), dims // len(codebooks)
    entries = len(codebooks[0])
    reach = max((abs(v) for part in codebooks for entry in part for v in entry), default=0)
    schema = T.StructType([f for f in state.schema if f.name in ("vec_id", "label", "_x")] + [
        T.StructField("codes", T.BinaryType()), T.StructField("error", T.DecimalType(38, 0)),
        T.StructField("change", T.ArrayType(T.DecimalType(38, 0))),
    ])

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _numbers(batch.column(2), dims, reach)
        raw = b"".join(batch.column(3).to_pylist())
        before = np.frombuffer(raw, np.uint8).reshape(len(x), parts)
        after, error = np.empty_like(before), np.zeros(len(x), x.dtype)
        change = np.zeros((parts, entries, width + 1), object)
        for p in range(parts):
            own = x[:, p * width:(p + 1) * width]
            book = np.array(codebooks[p], object if x.dtype == object else np.int64).reshape(entries, width)
            old = before[:, p]
            new, d = assign(own, np.where(old == NONE, 0, old), book)
            after[:, p] = new
            error += d
            moved = new != old  # the stable ones change no sum
            for codes, sign in ((new[moved], 1), (old[moved], -1)):
                for e in np.unique(codes[codes != NONE]).tolist():
                    rows = own[moved][codes == e]
                    change[p, e, :width] += sign * rows.sum(axis=0)
                    change[p, e, width] += sign * len(rows)
        number = pa.decimal128(38, 0)
        changes = [[int(v) for v in change.ravel()]] + [None] * (len(x) - 1)
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), batch.column(2), pa.array([r.tobytes() for r in after], pa.binary()),
            pa.array([int(e) for e in error], number), pa.array(changes, pa.list_(number)),
        ], names=[f.name for f in schema])

    rows_at_once = max(1, BLOCK // max(1, dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                yield block(batch.slice(at, rows_at_once))

    return state.select("vec_id", "label", "_x", "codes").mapInArrow(run, schema)


def _changed(state: DataFrame) -> dict[int, int]:
    """The sums of ``change``; as many numbers as the codebooks have, however many rows there are."""
    sums = state.where("change is not null").select(F.posexplode("change")).groupBy("pos").agg(F.sum("col").alias("s"))
    return {r.pos: int(r.s) for r in sums.where("s <> 0").collect()}


def compress(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codes:
    """Codebooks by ``rounds`` of k-means for every part of the vectors, and each vector's codes by them.

    A component x counts as floor(scale * x).  Codebooks start from the vectors of the
    ``entries`` (at most 255) smallest ids, all of them where there are fewer; a round assigns all parts
    and moves an entry to the floored mean of its own; entries without parts stay; a last pass assigns again.

    Vectors that are null or hold null or non-finite components are left out.  Rows with equal
    ids or vectors are vectors of their own; a null id sorts last, ids that tie sort by vector.
    An empty table gives no rows.  Vectors of unequal lengths, of a length that ``parts`` does not divide, or with
    a component that leaves 64 bits raise an error.  Other columns are not read.

    One pass reads and writes the table once: whole numbers, codes and, in few of the rows,
    the changes of the sums, so only what moved is summed and the driver gets one number per codebook component.
    The table of the pass before is deleted once the new one is complete.
    """
    if not 0 < entries < NONE or parts < 1 or rounds < 0:
        raise ValueError(f"parts = {parts}, entries = {entries} or rounds = {rounds} out of range")
    chosen = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("_v"), F.col(label).alias("label"))
    start = whole_numbers(chosen, "_v", scale).select(
        "vec_id", "label", "_x", F.lit(bytes([NONE]) * parts).alias("codes"), F.lit(None).cast("decimal(38,0)").alias("error"),
    )
    table, state = _store(start, "vectors")
    lengths = state.agg(F.min(F.size("_x")), F.max(F.size("_x"))).first()
    if lengths[0] is None:
        return Codes(state.select("vec_id", "label", F.lit("").alias("code"), "error"), [])
    dims = lengths[0]
    if lengths[0] != lengths[1] or dims % parts:
        raise ValueError(f"vectors of {lengths[0]} to {lengths[1]} components cannot be cut into {parts} equal parts")
    width = dims // parts
    first = state.orderBy(F.asc_nulls_last("vec_id"), "_x").limit(entries).select("_x").collect()
    books = [[r[0][p * width:(p + 1) * width] for r in first] for p in range(parts)]
    found = len(first)
    sums = [0] * (parts * found * (width + 1))
    for k in range(rounds + 1):
        older, (table, state) = table, _store(_pass(state, books, dims), f"codes-{k}")
        discard(vectors.sparkSession, older)
        if k == rounds:
            break
        for at, s in _changed(state).items():
            sums[at] += s
        books = [[_entry(sums, (p * found + e) * (width + 1), width, books[p][e]) for e in range(found)] for p in range(parts)]
    return Codes(state.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error"), books)


def _store(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """``df`` written to the shared folder: where, and as read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def _entry(sums: list[int], at: int, width: int, old: list[int]) -> list[int]:
    n = sums[at + width]
    return [sums[at + k] // n for k in range(width)] if n else old


def digests(vectors: DataFrame, **settings) -> DataFrame:
    """Per vector: its code, its error, the error of all vectors of its label, a digest of the codebooks.

    Rows without a label are one group.  A label may hold any share of the rows: its errors are summed
    map-side, and its sum meets its rows in a join that splits hot keys.
    """
    codes = compress(vectors, **settings)
    numbers = ",".join(str(v) for part in codes.codebooks for entry in part for v in entry)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    totals = codes.rows.groupBy(F.col("label").alias("_l")).agg(F.sum("error").cast("long").alias("label_error"))
    joined = codes.rows.join(totals, F.col("label").eqNullSafe(F.col("_l")))
    return joined.select(
        "vec_id", "code", F.col("error").cast("long").alias("error"), "label_error", F.lit(digest).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    """The same in SQL: parts in rows, one common table per round."""
    parts = f"""
  v AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i,
           list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {SCALE}) AS BIGINT)) AS x,
           len(embedding) // {PARTS} AS w
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
  p AS MATERIALIZED (
    SELECT i, part, list_slice(x, part * w + 1, (part + 1) * w) AS x, w FROM v, range({PARTS}) AS r(part)),
  book0 AS MATERIALIZED (SELECT part, i - 1 AS entry, x AS c FROM p WHERE i <= {ENTRIES})"""
    steps = [parts]
    for k in range(ROUNDS + 1):
        steps.append(f"""
  a{k} AS MATERIALIZED (
    SELECT i, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
      SELECT p.i, p.part, b.entry,
             CAST(list_sum(list_transform(list_zip(p.x, b.c), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS BIGINT))) AS BIGINT) AS d
      FROM p JOIN book{k} b USING (part)) GROUP BY 1, 2)""")
        if k < ROUNDS:
            steps.append(f"""
  m{k} AS MATERIALIZED (
    SELECT part, entry, list(m ORDER BY j) AS c FROM (
      SELECT part, entry, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
        SELECT p.part, a.entry, j, sum(p.x[j + 1]) AS s, count(*) AS n
        FROM p JOIN a{k} a ON a.i = p.i AND a.part = p.part, range(p.w) AS t(j) GROUP BY 1, 2, 3)) GROUP BY 1, 2),
  book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN m{k} m USING (part, entry))""")
    steps.append(f"""
  coded AS (
    SELECT i, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM a{ROUNDS} GROUP BY i),
  digest AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS}),
  per_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM v JOIN coded USING (i) GROUP BY 1)""")
    return "WITH" + ",".join(steps) + """
SELECT v.vec_id, code, error, label_error, codebooks_sha256
FROM v JOIN coded USING (i) JOIN per_label l ON l.label IS NOT DISTINCT FROM v.label, digest"""


ORACLE_SQL = _oracle()
