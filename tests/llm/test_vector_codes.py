"""Operator 11 against k-means in plain whole numbers, and against its SQL."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from outcomelake.llm import vector_codes
from outcomelake.llm.queries import op11_vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    w = len(kept[0][1]) // parts
    cut = [[r[1][p * w:(p + 1) * w] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(nearest(p, c[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(own[k]) for col in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])]
    out, by_label = [], {}
    for (i, _, lab), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, lab))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[lab]) for i, code, error, lab in out), key=repr), digest


def run(df, **settings):
    rows = vector_codes.digests(df, **settings).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows), key=repr), {r.codebooks_sha256 for r in rows}


def random_rows(rng, n, dims, spread=0.1):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(9)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([1, 1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("dims,spread,block", [(16, 0.05, 1 << 20), (16, 1.0, 160), (24, 0.3, 64)])
def test_codes(spark, monkeypatch, dims, spread, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = random_rows(random.Random(dims), 150, dims, spread)
    want, digest = brute(rows)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(3)) == (want, {digest})


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(1)
    rows = [(1, None, 1), (2, [nan] * 8, 1), (3, [inf] + [0.0] * 7, 1), (4, [None] + [0.0] * 7, 2), (None, [0.5] * 8, None)]
    rows += [(5, [-0.0001] * 8, 1)] * 3 + [(5, [0.25] * 8, 2), (6, [1e9] * 8, 2), (7, [-3e9] + [0.0] * 7, 2)]  # ties, copies, beyond 32 bits
    rows += [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(8)], 3) for i in range(10, 60)]  # many ties
    want, digest = brute(rows)
    assert run(spark.createDataFrame(rows, SCHEMA)) == (want, {digest})
    few, digest = brute(rows[4:8])
    assert run(spark.createDataFrame(rows[4:8], SCHEMA)) == (few, {digest})  # fewer vectors than entries
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _x", "'a' AS codes", "2 AS error", "3 AS change")
    assert run(more) == (want, {brute(rows)[1]})


def test_other_settings_and_errors(spark):
    rows = random_rows(random.Random(8), 60, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    settings = {"parts": 3, "entries": 5, "rounds": 2, "scale": 100}
    want, digest = brute(rows, **settings)
    assert run(df, **settings) == (want, {digest})
    assert run(df.where("false")) == ([], set()) and run(df.where("false").coalesce(1), rounds=0) == ([], set())
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(df, parts=5)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(df.unionByName(spark.createDataFrame([(1, [1.0] * 24, 1)], SCHEMA)), parts=3)
    with pytest.raises(Exception, match="leaves 64 bits"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_far_vectors_are_not_compared():
    """Two far balls: every vector keeps its entry although a wrong distance would be smaller."""
    x = np.array([[0], [1], [1000], [1001]])
    found, error = vector_codes.assign(x, np.array([0, 0, 1, 1], np.uint8), np.array([[0], [1000]]))
    assert found.tolist() == [0, 0, 1, 1] and error.tolist() == [0, 1, 0, 1]
    for homes in ([0, 0, 0, 0], [1, 1, 1, 1], [1, 1, 0, 0]):  # any ball is a right start
        again, _ = vector_codes.assign(x, np.array(homes, np.uint8), np.array([[0], [1000]]))
        assert again.tolist() == found.tolist()


def test_given_embeddings_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.sql(vector_codes.ORACLE_SQL)
    got = op11_vector_codes(spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
