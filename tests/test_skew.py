"""Sliced ordered work on hot keys equals brute force, at a limit low enough to slice everything."""

from __future__ import annotations

import random

import pytest

from outcomelake.operators import backtest
from outcomelake.functions.skew import SLICE, SkewPolicy, hot_keys, running_sum, slice_rows
from outcomelake.operators.asof import asof_forward
from outcomelake.operators.backtest import _slots, admit_by_capital

LOW = SkewPolicy(limit=5, bucket=1)
SLICED = SkewPolicy(limit=40, bucket=5)


def _rows(n, seed):
    rng = random.Random(seed)
    # A third of the rows under one key, many ties in time, some keys with a single row.
    return [("hot" if rng.random() < 0.33 else f"k{rng.randrange(12)}", rng.randrange(400), i, rng.randrange(-5, 6))
            for i in range(n)]


def test_running_sum_matches_brute_force_with_hot_keys(spark):
    rows = _rows(600, 1)
    df = spark.createDataFrame(rows, "k string, ts long, id long, v long")
    hot = hot_keys(df, ["k"], "ts", LOW)
    assert hot is not None and hot.where("k = 'hot'").count() == 1
    got = {r.id: r.s for r in running_sum(df, ["k"], ("ts", "id"), {"s": "v"}, LOW).collect()}
    want, totals = {}, {}
    for k, ts, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        totals[k] = totals.get(k, 0) + v
        want[i] = totals[k]
    assert got == want


def test_plain_window_without_hot_keys(spark):
    df = spark.createDataFrame(_rows(100, 2), "k string, ts long, id long, v long")
    assert hot_keys(df, ["k"], "ts") is None
    plan = running_sum(df, ["k"], ("ts", "id"), {"s": "v"})._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" not in plan


def test_slices_of_rows_that_cluster_in_time(spark):
    day = 86_400
    df = spark.range(100_000).selectExpr(
        "'m' AS k", f"IF(id % 10 = 0, id * {99 * day} DIV 100000, {99 * day} + id * 3600 DIV 100000) AS ts", "id")
    policy = SkewPolicy(limit=1000)
    hot = hot_keys(df, ["k"], "ts", policy)
    sizes = [r["count"] for r in slice_rows(df, hot, ["k"], "ts").groupBy(SLICE).count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) <= 2 * policy.limit


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("policy", [LOW, SkewPolicy()])
def test_asof_forward_matches_brute_force(spark, strict, policy):
    rng = random.Random(3)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(6)}"
    signals = [(key(), rng.randrange(300), i) for i in range(200)]
    prints = [(key(), rng.randrange(300), i, rng.random()) for i in range(250)]
    s = spark.createDataFrame(signals, "k string, ts long, sid long")
    p = spark.createDataFrame(prints, "k string, ts long, pid long, price double")
    out = asof_forward(s, p, ["k"], "ts", "ts", "pid", {"fts": "ts", "fid": "pid"}, strict, policy)
    got = {r.sid: (r.fts, r.fid) for r in out.collect()}
    for k, ts, sid in signals:
        later = [(pt, pid) for pk, pt, pid, _ in prints if pk == k and (pt > ts if strict else pt >= ts)]
        assert got[sid] == (min(later) if later else (None, None))
    assert len(got) == len(signals)


def _admit_reference(rows, slots):
    """One bet after the other with a list of reservations."""
    out, busy = set(), {}
    for owner, signal, settles, i in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        mine = [t for t in busy.get(owner, []) if t > signal]
        if len(mine) < slots:
            mine.append(settles)
            out.add(i)
        busy[owner] = mine
    return out


def test_admission_in_slices_matches_the_single_walk(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        ts = rng.randrange(500)
        rows.append((rng.choice(["a", "a", "b", f"c{i % 7}"]), ts, ts + rng.choice([-3, 1, 10, 60, 200]), i))
    df = spark.createDataFrame(rows, "leader string, signal_ts long, settled_ts long, orderfilled_id long")
    want = _admit_reference(rows, 3)
    for policy in (SLICED, SkewPolicy()):
        out = admit_by_capital(df, 300.0, 1 / 3, ["leader"], policy)
        assert out.columns == df.columns
        assert {r.orderfilled_id for r in out.collect()} == want
    single = [("x", *r[1:]) for r in rows]
    want_one = _admit_reference(single, 3)
    for policy in (SLICED, SkewPolicy()):
        got = admit_by_capital(df, 300.0, 1 / 3, policy=policy)
        assert {r.orderfilled_id for r in got.collect()} == want_one


def _count_rounds(monkeypatch):
    rounds, walk = [], backtest._walk_blocks

    def counted(hot, keys, slots, blocks, opening, known):
        rounds.append(len(blocks))
        return walk(hot, keys, slots, blocks, opening, known)

    monkeypatch.setattr(backtest, "_walk_blocks", counted)
    return rounds


@pytest.mark.parametrize("kind", ["tied", "mixed"])
def test_a_hundred_slices_settle_in_eight_rounds(spark, monkeypatch, kind):
    """Reservations that outlast many slices, so no slice starts as it would alone."""
    rounds, rng = _count_rounds(monkeypatch), random.Random(9)
    hold = {"tied": lambda: rng.choice([7, 95, 310]), "mixed": lambda: rng.choice([1, 2, 40])}[kind]
    rows = [("x", k, k + hold(), k) for k in range(1000)]
    df = spark.createDataFrame(rows, "leader string, signal_ts long, settled_ts long, orderfilled_id long")
    policy = SkewPolicy(limit=10, bucket=10, most_slices=1000)
    got = admit_by_capital(df, 300.0, 1 / 3, policy=policy)
    assert {r.orderfilled_id for r in got.collect()} == _admit_reference(rows, 3)
    assert rounds[0] == 100 and len(rounds) <= 8


def test_slots_follow_the_ledger():
    assert _slots(10_000.0, 200.0) == 50
    assert _slots(100.0, 150.0) == 0
