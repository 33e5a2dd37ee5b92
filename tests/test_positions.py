"""Positions, outcomes, rankings and wallets on a small golden set of fills."""

from __future__ import annotations

import math

import pytest

from outcomelake.operators import positions as P
from outcomelake.operators import wallets as V

from conftest import BASE

# Market A: token1 ends at .99; market B: token2 ends at .99; market C stays open.
ROWS = [
    (BASE + 1, "A", "P1", "P3", "token1", "BUY", 0.60),
    (BASE + 2, "A", "P1", "P4", "token1", "BUY", 0.80),
    (BASE + 3, "A", "P3", "P1", "token1", "SELL", 0.50),
    (BASE + 9, "A", "P2", "P3", "token1", "BUY", 0.99),
    (BASE + 1, "B", "P5", "P3", "token1", "BUY", 0.55),
    (BASE + 2, "B", "P1", "P5", "token2", "BUY", 0.70),
    (BASE + 9, "B", "P1", "P4", "token2", "BUY", 0.99),
    (BASE + 5, "C", "P2", "P1", "token1", "BUY", 0.50),
    (BASE + 6, "C", "P3", "P2", "token1", "BUY", 0.55),
]


@pytest.fixture(scope="module")
def trades(make_trades):
    return make_trades(ROWS)


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_expansion_signs_and_roles(trades):
    both = P.expand_to_positions(trades)
    assert both.count() == 2 * len(ROWS)
    assert P.expand_to_positions(trades, "maker").count() == len(ROWS)
    sums = both.groupBy("market_id").sum("signed_tokens", "signed_usd").collect()
    assert all(abs(r[1]) < 1e-9 and abs(r[2]) < 1e-9 for r in sums)
    with pytest.raises(ValueError):
        P.expand_to_positions(trades, "broker")


def test_resolution(trades):
    r = by(P.market_resolution(trades), "market_id")
    assert (r["A",].winner_token, r["B",].winner_token, r["C",].winner_token) == ("token1", "token2", "open")
    assert r["A",].token2 is None and r["B",].token1 == 0.55


def test_last_price_breaks_ties_by_id(make_trades):
    t = make_trades([(BASE, "A", "x", "y", "token1", "BUY", p) for p in (0.3, 0.2, 0.9)])
    assert P.last_price_per_side(t).first().last_price == 0.9
    numeric = t.selectExpr("*", "CAST(substring(orderfilled_id, 2) AS bigint) AS n").drop("orderfilled_id")
    assert P.last_price_per_side(numeric.withColumnRenamed("n", "orderfilled_id")).first().last_price == 0.9


def test_labels_and_pnl(trades):
    last = P.last_price_per_side(trades)
    labelled = by(
        P.label_outcomes(P.positions_table(trades), P.resolution_from_last(last), last),
        "player", "market_id", "token_side",
    )
    won = labelled["P3", "A", "token1"]
    assert (won.outcome, won.net_tokens, won.net_usd) == ("won", 300.0, -209.0)
    assert won.pnl_usd == pytest.approx(91.0)
    assert labelled["P3", "B", "token1"].outcome == "lost"
    assert labelled["P3", "B", "token1"].pnl_usd == pytest.approx(-55.0)
    short = labelled["P1", "B", "token2"]
    assert (short.outcome, short.pnl_usd) == ("flat", pytest.approx(169.0))
    opened = labelled["P1", "C", "token1"]
    assert (opened.outcome, opened.pnl_usd) == ("open", pytest.approx(-50 + 55))
    assert labelled["P2", "C", "token1"].outcome == "flat"


def test_player_stats_agree_with_their_steps(trades):
    stats = by(P.compute_player_stats(trades), "player")
    p3 = stats["P3",]
    assert (p3.n_won, p3.n_lost, p3.n_bets, p3.win_rate) == (1, 1, 2, 0.5)
    assert p3.total_won_usd == pytest.approx(91.0) and p3.total_lost_usd == pytest.approx(55.0)
    assert p3.score_c == pytest.approx(0.5 * math.log(91.0))
    for r in stats.values():
        assert r.n_bets == r.n_won + r.n_lost
        assert r.net_usd_pnl == pytest.approx(r.total_won_usd - r.total_lost_usd)


def test_official_outcomes_let_shorts_win(spark, trades):
    outcomes = spark.createDataFrame([("A", "token2"), ("B", None)], "market_id string, winner_token string")
    labelled = by(P.label_official(P.positions_table(trades), outcomes), "player", "market_id", "token_side")
    assert labelled["P2", "A", "token1"].outcome == "won"
    assert labelled["P3", "A", "token1"].outcome == "lost"
    assert labelled["P3", "B", "token1"].outcome == "open"
    assert labelled["P3", "B", "token1"].pnl_usd is None


def test_top_n_filters_orders_and_puts_nulls_last(spark):
    rows = [("a", 0.9, 30, 10.0, 1.0), ("b", 0.5, 30, 99.0, 1.0), ("c", 0.8, 30, 50.0, 0.0),
            ("d", 0.7, 10, 80.0, 1.0), ("e", 0.6, 40, None, 1.0)]
    stats = spark.createDataFrame(
        rows, "player string, win_rate double, n_bets long, total_won_usd double, total_lost_usd double")
    top = P.select_top_n(stats, score_fn=P.score_total_won)
    assert [r.player for r in top.collect()] == ["c", "a", "e"]
    ratio = P.select_top_n(stats.where("player = 'c'"), score_fn=P.score_money_ratio).first()
    assert ratio.score == 50.0


def test_wallet_metrics(spark, trades):
    markets = spark.createDataFrame([("A", "qa"), ("B", "qb"), ("C", "qc")], "id string, question string")
    m = by(V.wallet_market_metrics(trades, markets), "maker", "market_id", "side")
    p1 = m["P1", "A", "token1"]
    assert (p1.trades, p1.sell_usd, p1.buy_usd, p1.last_price) == (2, 140.0, 0.0, 1.0)
    assert p1.avg_sold_price_only == pytest.approx(0.7) and p1.avg_buy_price is None and p1.pct_change is None
    assert p1.total_pnl_usd == pytest.approx(140 - 200)
    p3 = m["P3", "A", "token1"]
    assert p3.avg_buy_price == 0.5 and p3.pct_change == pytest.approx(100.0)
    cards = by(V.trader_scorecard(V.combine_sides(V.wallet_market_metrics(trades, markets))), "wallet")
    assert cards["P3",].markets_traded == 2 and cards["P3",].big_wins_count == 1
    pool = V.candidate_pool(trades.withColumnRenamed("maker", "m").selectExpr(
        "*", f"if(m = 'P1', '{V.PLATFORM_WALLETS[0]}', m) AS maker"))
    assert "P1" not in {r.maker for r in pool.collect()} and pool.count() == 3
