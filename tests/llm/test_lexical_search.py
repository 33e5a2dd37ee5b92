"""Operator 12 against scores of all pairs, and against its SQL."""

from __future__ import annotations

import math
import random
import re

import duckdb
import numpy as np
import pytest

from outcomelake.llm import lexical_search
from outcomelake.llm.queries import op12_lexical_search
from llm_fixtures import make_docs, no_docs, odd_docs, prose  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(SMALL))


def brute(docs, items, k):
    """(item, rank, id, score) of all pairs, plainly."""
    counted = [(i, words(t)) for i, t in docs]
    N, L = sum(bool(w) for _, w in counted), sum(len(w) for _, w in counted)
    df = {}
    for _, w in counted:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, w in counted:
            m = 50 + (50 * len(w) * N) // L if w else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in set(words(text)) if t in w)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def run(docs, items, **settings):
    return sorted((tuple(r) for r in lexical_search.rank(docs, items, **settings).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture
def small_trees(monkeypatch):
    for name, value in (("FAN", 2), ("ITEMS", 8), ("BATCH", 32), ("LEAF", 2), ("WINDOW", 50)):
        monkeypatch.setattr(lexical_search, name, value)


def case(rng, n_docs, n_items):
    common = [prose(rng, 1) for _ in range(12)]
    passages = [prose(rng, 12) for _ in range(5)]
    text = lambda n: " ".join(rng.choice([rng.choice(common), prose(rng, 1).upper(), rng.choice(["é", "x-1", "漢"])]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 30)) + (" " + rng.choice(passages) if rng.random() < 0.3 else "")) for i in range(n_docs)]
    return docs + [(1000 + i, docs[3][1]) for i in range(40)], [(i, text(8) + " " + rng.choice(passages)) for i in range(n_items)]


@pytest.mark.parametrize("k,parts", [(3, 1), (7, 3), (200, 2)])
def test_ranks(spark, make_docs, small_trees, k, parts):
    docs, items = case(random.Random(k), 150, 30)
    table = make_docs([(i, t, "en", "s", 0) for i, t in docs]).repartition(parts)
    assert run(table, spark.createDataFrame(items, "item_id bigint, text string"), k=k) == brute(docs, items, k)


def test_items_in_groups_and_exact_sums_in_parts(spark, make_docs, small_trees, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 300)
    monkeypatch.setattr(lexical_search, "EXACT", 5)
    docs, items = case(random.Random(2), 60, 20)
    items += [items[0], (77, items[1][1]), (None, items[2][1]), (78, None), (79, "!!"), (80, "nowhere")]
    want = brute(docs, items[:20], 5) + brute(docs, [items[0], (77, items[1][1]), (None, items[2][1])], 5)
    assert run(make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string"), k=5) == sorted(want, key=repr)


def test_odd_documents(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, docs[2][1]), (2, "A é 漢 ll"), (3, "X" * 5000), (4, docs[9][1][:4000])]
    table = spark.createDataFrame(items, "item_id int, text string")
    assert run(odd_docs, table) == brute(docs, items, 50)
    clash = odd_docs.selectExpr("*", "1 AS n", "'a' AS terms", "2 AS times", "3 AS item", "4 AS score", "5 AS _text")
    assert run(clash, table.selectExpr("*", "7 AS rank", "8 AS doc_id")) == brute(docs, items, 50)
    assert run(no_docs, table) == [] and run(odd_docs, table.where("false")) == []
    assert run(odd_docs.where("text is null or trim(text) = ''"), table) == []
    named = spark.createDataFrame([("b", "one two"), ("a", "two one"), (None, "one two")], "key string, body string")
    found = run(named, spark.createDataFrame([("q", "two")], "name string, body string"), text="body", doc_id="key", item_text="body", item_id="name")
    assert [r[2] for r in found] == ["a", "b", None] and len({r[3] for r in found}) == 1


def test_tree_nodes_are_full_and_bounds_hold():
    rng = np.random.default_rng(4)
    rows = [np.flatnonzero(rng.random(20) < 0.3) for _ in range(101)]
    order = lexical_search.tree_order(lexical_search.sparse(rows), 4)
    assert sorted(order.tolist()) == list(range(101))
    tree = lexical_search.item_trees(rows)[0]
    docs = rng.random((50, len(tree.vocabulary))).round(3) * 1000
    weakest = np.full(101, 3000)
    found = {(d, tree.numbers[i]) for ds, its, _ in lexical_search.search(tree, docs, weakest) for d, i in zip(ds.tolist(), its.tolist())}
    want = set()
    for d in range(50):
        for i, r in enumerate(rows):
            if len(r) and np.rint(docs[d][np.searchsorted(tree.vocabulary, r)].sum()) >= 3000:
                want.add((d, i))
    assert found == want


def test_lengths_beyond_64_bits():
    lengths = np.array([10**12, 5])
    m = [50 + 50 * n * 10**9 // 10**15 for n in lengths.tolist()]
    want = [7 * (10**9 * 3 // (3000 + 20 * x)) for x in m]
    assert lexical_search.contributions(np.array([3, 3]), lengths, np.array([7, 7]), 10**9, 10**15).tolist() == want


def test_given_tables_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(lexical_search.ORACLE_SQL)
    got = op12_lexical_search(spark, sf).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
