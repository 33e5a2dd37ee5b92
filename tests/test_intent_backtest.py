"""Taker intent, bars, copy fills and the bar back-test."""

from __future__ import annotations

import math
import random

import pytest

from outcomelake.functions.ranks import distinct_index, quantile_nearest
from outcomelake.operators import backtest as B
from outcomelake.operators import intent as I
from outcomelake.operators.asof import align_to_clock

from conftest import BASE


def test_punter_view_drops_noise(make_trades):
    t = make_trades([
        (BASE, "A", "m", "t", "token1", "BUY", 0.5),
        (BASE, "A", "t", "t", "token1", "BUY", 0.5),
        (BASE, "A", "m", "t", "token1", "BUY", 0.01),
        (BASE, "A", "m", "t", "token1", "BUY", 0.99),
        (BASE, "A", "m", "t", "token1", "BUY", 0.5, 1.0),
        (BASE, "A", I.PLATFORM_WALLETS[0], "t", "token1", "BUY", 0.5),
    ])
    assert [r.orderfilled_id for r in I.punter_view(t).collect()] == ["f0000"]
    assert I.punter_view(t, drop_platform_wallets=False).count() == 2


def test_timeline_kinds(make_trades):
    moves = [("BUY", 100.0), ("BUY", 50.0), ("SELL", 20.0), ("SELL", 200.0), ("BUY", 70.0)]
    t = make_trades([(BASE + i, "A", "m", "t", "token1", d, 0.5, n) for i, (d, n) in enumerate(moves)])
    got = {r.orderfilled_id: (r.event_kind, r.cum_position) for r in I.position_timeline(t).collect()}
    assert [got[k] for k in sorted(got)] == [
        ("entry", 100.0), ("add", 150.0), ("reduce", 130.0), ("flip", -70.0), ("exit", 0.0)]
    assert I.entries_only(I.position_timeline(t)).count() == 1


def test_fractional_amounts_close_to_exactly_zero(make_trades):
    t = make_trades([(BASE + i, "A", "m", "t", "token1", d, 0.5, n)
                     for i, (d, n) in enumerate([("BUY", 0.1), ("BUY", 0.2), ("SELL", 0.3)])])
    kinds = {r.orderfilled_id: r.event_kind for r in I.position_timeline(t).collect()}
    assert kinds["f0002"] == "exit"


def test_quantile_and_index(spark):
    rng = random.Random(9)
    values = [rng.randrange(300_000) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for q in (0.0, 0.25, 0.7, 1.0):
        assert quantile_nearest(df, "v", q) == sorted(values)[math.floor(q * 500 + 0.5)]
    got = {r.v: r.idx for r in distinct_index(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(set(values)))}
    assert quantile_nearest(df.where("v < 0"), "v", 0.5) is None


def test_cohorts(spark):
    entries = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), ("b", 9), ("c", 4)], "taker string, timestamp long")
    assert [r.taker for r in I.leader_cohort(entries, 5, n=2).collect()] == ["a", "b"]
    one, same = (I.random_cohort(entries, seed=7, n=2).collect() for _ in range(2))
    assert one == same and len(one) == 2
    assert I.random_cohort(entries, seed=7, n=9).count() == 3


def test_bars(spark):
    t = spark.createDataFrame([(1, 0.2, 2.0, 1), (8, 0.3, 3.0, 2), (12, 0.4, 4.0, 3)],
                              "timestamp long, price double, usd_amount double, orderfilled_id long")
    got = sorted((r.timestamp, r.close, r.usd_volume, r.n_trades) for r in B.transaction_bars(t, 10).collect())
    assert got == [(0, 0.3, 5.0, 2), (10, 0.4, 4.0, 1)]
    with pytest.raises(ValueError):
        B.transaction_bars(t, 0)
    with pytest.raises(ValueError, match="usd_amount"):
        B.transaction_bars(t.drop("usd_amount"), 10)


def test_signal_needs_a_full_window(spark):
    bars = spark.createDataFrame([(i, c) for i, c in enumerate([0.7, 0.7, 0.7, 0.9])], "timestamp long, close double")
    got = [(r.timestamp, r.signal) for r in B.sma_signal(bars, keys=[]).orderBy("timestamp").collect()]
    assert got == [(2, 0), (3, 1)]


def test_fill_happens_one_bar_later(spark):
    bars = spark.createDataFrame([(1, 0.4, 0), (2, 0.6, 1), (3, 0.7, 1)], "timestamp long, close double, signal int")
    out = B.next_observation_pnl(bars, fee_bps=10, slippage_bps=20, keys=[])
    (f,) = out.fills.collect()
    assert (f.signal_timestamp, f.fill_timestamp, f.target_shares) == (2, 3, 1)
    assert f.fill_price == pytest.approx(0.7 * 1.002) and f.fee == pytest.approx(0.7 * 1.002 * 0.001)
    with pytest.raises(ValueError):
        B.next_observation_pnl(bars, fee_bps=-1, slippage_bps=0)
    with pytest.raises(ValueError, match="signal"):
        B.next_observation_pnl(bars.drop("signal"), fee_bps=0, slippage_bps=0)


def _event_loop(bars, fee, slip):
    """The account, one bar after the other."""
    cash = shares = peak = turnover = worst = 0.0
    pending, before, rows = None, 0, []
    for close, signal in bars:
        if pending is not None and pending != shares:
            delta = pending - shares
            price = close * (1 + math.copysign(slip, delta))
            cash -= delta * price + abs(delta) * price * fee
            turnover += abs(delta) * price
            shares = pending
        pending = signal if signal != before else None
        before = signal
        equity = cash + shares * close
        peak = max(peak, equity)
        worst = max(worst, (peak - equity) / peak if peak > 0 else 0.0)
        rows.append((cash, shares, equity))
    return rows, turnover, worst


def test_relational_backtest_equals_the_event_loop(spark):
    rng = random.Random(11)
    series = {f"m{i}": [(round(rng.uniform(0.05, 0.95), 2), rng.randrange(2)) for _ in range(40)] for i in range(8)}
    rows = [(m, t, c, s) for m, bars in series.items() for t, (c, s) in enumerate(bars)]
    df = spark.createDataFrame(rows, "market_id string, timestamp long, close double, signal int")
    out = B.next_observation_pnl(df, fee_bps=10, slippage_bps=20)
    equity = {(r.market_id, r.timestamp): (r.cash, r.shares, r.marked_equity) for r in out.equity.collect()}
    summary = {r.market_id: r for r in out.summary.collect()}
    for m, bars in series.items():
        want, turnover, worst = _event_loop(bars, 0.001, 0.002)
        for t, row in enumerate(want):
            assert equity[m, t] == pytest.approx(row)
        assert summary[m].turnover == pytest.approx(turnover)
        assert summary[m].max_drawdown == pytest.approx(worst)


OUTCOME = "market_id string, winner_token string, resolved_at long"


def test_copy_sell_settles_at_resolution(spark, make_trades):
    prints = make_trades([
        (BASE + 10, "A", "m", "lead", "token1", "SELL", 0.6),
        (BASE + 20, "A", "m", "x", "token1", "BUY", 0.5),
    ])
    entries = I.entries_only(I.position_timeline(prints.where("taker = 'lead'")))
    outcomes = spark.createDataFrame([("A", "token2", BASE + 90)], OUTCOME)
    leaders = spark.createDataFrame([("lead",)], "taker string")
    out = B.simulate_copy_bet(entries, prints, outcomes, leaders, BASE, BASE + 100)
    (bet,) = out.bets.collect()
    assert (bet.fill_ts, bet.settled_ts, bet.fill_price) == (BASE + 20, BASE + 90, 0.5)
    assert bet.pnl_usd == pytest.approx(200.0)
    flows = sorted((r.timestamp, r.amount_usd) for r in out.cashflows.collect())
    assert flows == [(BASE + 20, -200.0), (BASE + 90, pytest.approx(400.0))]
    late = spark.createDataFrame([("A", "token2", BASE + 101)], OUTCOME)
    assert B.simulate_copy_bet(entries, prints, late, leaders, BASE, BASE + 100).bets.count() == 0


@pytest.mark.parametrize("direction", ["BUY", "SELL"])
def test_cash_flows_sum_to_the_result(spark, make_trades, direction):
    other = "SELL" if direction == "BUY" else "BUY"
    prints = make_trades([
        (BASE + 10, "A", "m", "lead", "token1", direction, 0.6),
        (BASE + 20, "A", "m", "x", "token1", other, 0.5),
    ])
    entries = I.entries_only(I.position_timeline(prints.where("taker = 'lead'")))
    outcomes = spark.createDataFrame([("A", "token1", BASE + 90)], OUTCOME)
    bets = B.copy_fill_asof(entries, prints, outcomes, BASE + 100, fee_bps=50)
    total = sum(r.amount_usd for r in B.cash_ledger(bets).collect())
    assert total == pytest.approx(bets.first().pnl_usd)


def test_next_print_is_strictly_later_and_within_the_window(spark, make_trades):
    prints = make_trades([
        (BASE, "A", "m", "lead", "token1", "BUY", 0.4),
        (BASE, "A", "m", "x", "token1", "BUY", 0.45),
        (BASE + 50, "A", "m", "x", "token1", "BUY", 0.5),
    ])
    resolutions = spark.createDataFrame([("A", "token1")], "market_id string, winner_token string")
    signals = prints.where("taker = 'lead'")
    (bet,) = B.next_print_asof(signals, prints, resolutions).collect()
    assert (bet.fill_ts, bet.fill_price, bet.payoff_usd) == (BASE + 50, 0.5, 400.0)
    assert B.next_print_asof(signals, prints, resolutions, tolerance_secs=49).count() == 0
    empty = B.next_print_summary(B.next_print_asof(signals, prints, resolutions, tolerance_secs=49)).first()
    assert (empty.n_bets, empty.total_pnl_usd, empty.win_rate) == (0, 0.0, 0.0)


def test_alignment_carries_rows_not_values(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("a", 0, 1.0), ("a", 100_000, nan), ("b", 50_000, 5.0), ("b", 200_000, 6.0)],
        "series string, timestamp long, value double")
    plain = align_to_clock(df, ["a", "b"]).orderBy("timestamp").collect()
    assert [r.timestamp for r in plain] == [0, 50_000, 100_000, 200_000]
    assert plain[0].a == 1.0 and math.isnan(plain[1].a) and math.isnan(plain[0].b)
    filled = align_to_clock(df, ["a", "b"], forward_fill=True).orderBy("timestamp").collect()
    assert filled[1].a == 1.0 and math.isnan(filled[2].a) and math.isnan(filled[3].a)
    assert [r.b for r in filled[1:]] == [5.0, 5.0, 6.0] and math.isnan(filled[0].b)
