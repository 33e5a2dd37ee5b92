"""Queries of §A: positions, resolutions, profit and loss, wallets."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelake.operators import positions as P
from outcomelake.operators import wallets as V
from outcomelake.plans.fixtures import market_outcomes, markets, trades
from outcomelake.plans.registry import query

_STATS = """SELECT player, n_won, n_lost, total_won_usd, total_lost_usd, net_usd_pnl, n_bets,
  round(win_rate, 6) AS win_rate, round(score_c, 6) AS score_c FROM {view}"""


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("a01_expand_to_positions", """
  SELECT timestamp, market_id, player, token_side, signed_tokens, signed_usd, direction, price
  FROM positions""", ("positions",))
def _(spark, sf):
    return P.expand_to_positions(trades(spark, sf))


@query("a02_positions_table", "SELECT * FROM position_totals", ("position_totals",))
def _(spark, sf):
    return P.positions_table(trades(spark, sf))


@query("a03_last_price_per_side", "SELECT * FROM last_prices", ("last_prices",))
def _(spark, sf):
    return P.last_price_per_side(trades(spark, sf))


@query("a04_market_resolution", "SELECT * FROM resolutions", ("resolutions",))
def _(spark, sf):
    return P.market_resolution(trades(spark, sf))


@query("a05_label_outcomes", """
  SELECT player, market_id, token_side, net_tokens, net_usd, n_buys, n_sells, first_ts, last_ts,
         winner_token, last_price, outcome, round(pnl_usd, 6) AS pnl_usd FROM labelled""", ("labelled",))
def _(spark, sf):
    t = trades(spark, sf)
    last = P.last_price_per_side(t)
    out = P.label_outcomes(P.positions_table(t), P.resolution_from_last(last), last)
    return rounded(out, "pnl_usd")


@query("a06_player_aggregates", _STATS.format(view="stats"), ("stats",))
def _(spark, sf):
    t = trades(spark, sf)
    last = P.last_price_per_side(t)
    labelled = P.label_outcomes(P.positions_table(t), P.resolution_from_last(last), last)
    return rounded(P.player_aggregates(labelled), "win_rate", "score_c")


@query("a07_player_stats", _STATS.format(view="stats"), ("stats",))
def _(spark, sf):
    return rounded(P.compute_player_stats(trades(spark, sf)), "win_rate", "score_c")


@query("a08_player_stats_from_outcomes", _STATS.format(view="official_stats"), ("official_stats",))
def _(spark, sf):
    stats = P.compute_player_stats_from_outcomes(trades(spark, sf), market_outcomes(spark, sf))
    return rounded(stats, "win_rate", "score_c")


@query("a09_scores", """
  SELECT player, round(score_c, 6) AS score_c,
         round(total_won_usd / greatest(total_lost_usd, 1.0), 6) AS money_ratio,
         round(win_rate, 6) AS win_rate, total_won_usd AS total_won FROM stats""", ("stats",))
def _(spark, sf):
    stats = P.compute_player_stats(trades(spark, sf))
    return stats.select(
        "player",
        F.round(P.score_c(F.col), 6).alias("score_c"),
        F.round(P.score_money_ratio(F.col), 6).alias("money_ratio"),
        F.round(P.score_win_rate(F.col), 6).alias("win_rate"),
        P.score_total_won(F.col).alias("total_won"),
    )


@query("a10_top_n", """
  SELECT player, n_bets, round(win_rate, 6) AS win_rate, total_won_usd, round(score_c, 6) AS score
  FROM stats WHERE win_rate > 0.4 AND n_bets >= 5 ORDER BY score_c DESC NULLS LAST, player LIMIT 10""",
       ("stats",))
def top_wallets(spark, sf):
    top = P.select_top_n(P.compute_player_stats(trades(spark, sf)), n=10, min_win_rate=0.4, min_n_bets=5)
    return top.select("player", "n_bets", F.round("win_rate", 6).alias("win_rate"), "total_won_usd",
                      F.round("score", 6).alias("score"))


@query("a11_wallet_inventory", """
  SELECT p.player, p.market_id, m.question, p.token_side, p.net_tokens, p.net_usd AS net_cash_flow,
         p.last_ts AS last_trade_at, l.last_price AS mark_price,
         round(p.net_tokens * l.last_price + p.net_usd, 6) AS estimated_value, o.winner_token,
         coalesce(o.resolved_at, -1) AS resolved_at
  FROM position_totals p LEFT JOIN last_prices l ON l.market_id = p.market_id AND l.token_side = p.token_side
  LEFT JOIN market_outcomes o ON o.market_id = p.market_id JOIN markets m ON m.id = p.market_id""",
       ("position_totals", "last_prices", "market_outcomes", "markets"))
def _(spark, sf):
    out = P.wallet_inventory(trades(spark, sf), market_outcomes(spark, sf), markets(spark, sf))
    return rounded(out, "estimated_value").withColumn("resolved_at", F.coalesce("resolved_at", F.lit(-1)))


@query("a12_last_price_vs_outcome", """
  SELECT o.market_id, o.winner_token, o.resolved_at, l.last_observed_price, m.question
  FROM market_outcomes o LEFT JOIN (
    SELECT market_id, arg_max(price, (timestamp, orderfilled_id)) AS last_observed_price
    FROM trades GROUP BY 1) l USING (market_id) JOIN markets m ON m.id = o.market_id""",
       ("trades", "market_outcomes", "markets"))
def _(spark, sf):
    return P.last_price_vs_outcome(trades(spark, sf), market_outcomes(spark, sf), markets(spark, sf))


_METRICS = """
  SELECT maker, market_id, side, question, trades, buy_notional / nullif(buy_tokens, 0) AS avg_buy_price,
         sell_notional / nullif(sell_tokens, 0) AS avg_sold_price_only,
         CASE WHEN sell_tokens + held > 0 THEN (sell_notional + held * last_price) / (sell_tokens + held) END
           AS avg_sell_price,
         last_price, sell_usd - buy_usd + held * last_price AS total_pnl_usd, last_trade_ts, buy_usd, sell_usd,
         buy_tokens, sell_tokens, buy_notional, sell_notional
  FROM (SELECT s.*, buy_tokens - sell_tokens AS held, m.question,
               CASE WHEN l.last_price > 0.98 THEN 1.0::DOUBLE WHEN l.last_price < 0.02 THEN 0.0::DOUBLE
                    ELSE l.last_price END AS last_price
        FROM (SELECT maker, market_id, nonusdc_side AS side, count(*) AS trades, max(timestamp) AS last_trade_ts,
                     usd_(coalesce(sum(micro_(usd_amount)) FILTER (maker_direction = 'BUY'), 0)) AS buy_usd,
                     usd_(coalesce(sum(micro_(usd_amount)) FILTER (maker_direction = 'SELL'), 0)) AS sell_usd,
                     usd_(coalesce(sum(micro_(token_amount)) FILTER (maker_direction = 'BUY'), 0)) AS buy_tokens,
                     usd_(coalesce(sum(micro_(token_amount)) FILTER (maker_direction = 'SELL'), 0)) AS sell_tokens,
                     usd_(coalesce(sum(micro_(price * token_amount)) FILTER (maker_direction = 'BUY'), 0))
                       AS buy_notional,
                     usd_(coalesce(sum(micro_(price * token_amount)) FILTER (maker_direction = 'SELL'), 0))
                       AS sell_notional
              FROM trades GROUP BY 1, 2, 3) s
        LEFT JOIN last_prices l ON l.market_id = s.market_id AND l.token_side = s.side
        LEFT JOIN markets m ON m.id = s.market_id)"""
_PCT = f"""
  SELECT *, (avg_sell_price - avg_buy_price) / nullif(avg_buy_price, 0) * 100 AS pct_change FROM ({_METRICS})"""
_COMBINED = f"""
  SELECT maker, market_id, max(question) AS question, CAST(sum(trades) AS BIGINT) AS trades,
         usd_(sum(micro_(total_pnl_usd))) AS total_pnl_usd, usd_(sum(micro_(buy_usd))) AS buy_usd_total,
         usd_(sum(micro_(sell_usd))) AS sell_usd_total, max(last_trade_ts) AS last_trade_ts,
         CASE WHEN sum(micro_(w)) > 0 THEN usd_(sum(micro_(x))) / usd_(sum(micro_(w))) END AS pct_change
  FROM (SELECT *, CASE WHEN pct_change IS NULL THEN 0.0::DOUBLE ELSE buy_usd END AS w,
               coalesce(pct_change * buy_usd, 0.0::DOUBLE) AS x FROM ({_PCT})) GROUP BY 1, 2"""
_CARDS = f"""
  SELECT *, wins / CAST(markets_traded AS DOUBLE) AS win_rate,
         big_wins_count / CAST(markets_traded AS DOUBLE) AS big_win_rate_overall,
         big_wins_count / CAST(nullif(wins, 0) AS DOUBLE) AS big_win_rate_among_wins
  FROM (SELECT maker AS wallet, count(*) AS markets_traded, max(last_trade_ts) AS last_trade,
               count(*) FILTER (total_pnl_usd > 0) AS wins,
               count(*) FILTER (total_pnl_usd > 0 AND pct_change >= 70.0) AS big_wins_count,
               median(pct_change) FILTER (total_pnl_usd > 0) AS median_win_pct,
               median(pct_change) FILTER (total_pnl_usd <= 0) AS median_loss_pct,
               median(total_pnl_usd) FILTER (total_pnl_usd > 0) AS median_win_usd,
               median(total_pnl_usd) FILTER (total_pnl_usd <= 0) AS median_loss_usd,
               usd_(sum(micro_(total_pnl_usd))) AS total_pnl_usd
        FROM ({_COMBINED}) GROUP BY 1)"""
_WALLET_VIEWS = ("trades", "last_prices", "markets")
_A13 = ("avg_buy_price", "avg_sold_price_only", "avg_sell_price", "total_pnl_usd", "pct_change")
_A15 = ("median_win_pct", "median_loss_pct", "median_win_usd", "median_loss_usd", "win_rate",
        "big_win_rate_overall", "big_win_rate_among_wins")


def _rounding(sql: str, columns: tuple[str, ...]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 9) AS {c}' for c in columns)}) FROM ({sql})"


@query("a13_wallet_market_metrics", _rounding(_PCT, _A13), _WALLET_VIEWS)
def _(spark, sf):
    return rounded(V.wallet_market_metrics(trades(spark, sf), markets(spark, sf)), *_A13, digits=9)


@query("a14_combine_sides", _rounding(_COMBINED, ("pct_change",)), _WALLET_VIEWS)
def _(spark, sf):
    return rounded(
        V.combine_sides(V.wallet_market_metrics(trades(spark, sf), markets(spark, sf))), "pct_change", digits=9
    )


@query("a15_trader_scorecard", f"SELECT * EXCLUDE (wins) FROM ({_rounding(_CARDS, _A15)})", _WALLET_VIEWS)
def _(spark, sf):
    metrics = V.wallet_market_metrics(trades(spark, sf), markets(spark, sf))
    return rounded(V.trader_scorecard(V.combine_sides(metrics)), *_A15, digits=9)


@query("a16_candidate_pool", """
  SELECT maker, usd_(sum(micro_(usd_amount))) AS volume_usd, count(*) AS fills
  FROM trades GROUP BY 1 ORDER BY volume_usd DESC, maker LIMIT 100""", ("trades",))
def _(spark, sf):
    return V.candidate_pool(trades(spark, sf))


@query("a16_ranked_traders", _rounding(f"""
  SELECT wallet, markets_traded, last_trade, win_rate * 100 AS win_rate_pct,
         big_win_rate_overall * 100 AS big_win_rate_overall_pct,
         big_win_rate_among_wins * 100 AS big_win_rate_among_wins_pct, median_win_pct, median_loss_pct,
         median_win_usd, median_loss_usd, big_wins_count, total_pnl_usd
  FROM ({_CARDS}) WHERE markets_traded >= 20
  ORDER BY big_win_rate_among_wins DESC NULLS LAST, median_win_pct DESC NULLS LAST,
           total_pnl_usd DESC NULLS LAST, wallet LIMIT 50""",
    ("median_win_pct", "median_loss_pct", "median_win_usd", "median_loss_usd"),
).replace("REPLACE (", "REPLACE (round(win_rate_pct, 2) AS win_rate_pct, "
          "round(big_win_rate_overall_pct, 2) AS big_win_rate_overall_pct, "
          "round(big_win_rate_among_wins_pct, 2) AS big_win_rate_among_wins_pct, "), _WALLET_VIEWS)
def _(spark, sf):
    out = V.ranked_traders(trades(spark, sf), markets(spark, sf), min_markets=20, active_after=0)
    return rounded(out, "median_win_pct", "median_loss_pct", "median_win_usd", "median_loss_usd", digits=9)
