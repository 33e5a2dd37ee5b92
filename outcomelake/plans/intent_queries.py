"""Queries of §W: taker intent, as-of fills, bars and back-tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelake.operators import backtest as B
from outcomelake.operators import intent as I
from outcomelake.operators.asof import align_to_clock
from outcomelake.operators.positions import market_resolution
from outcomelake.plans.fixtures import market_outcomes, trades
from outcomelake.plans.positions_queries import _STATS, rounded
from outcomelake.plans.registry import query
from outcomelake.session import materialize


def _timeline(spark, sf):
    return I.position_timeline(I.punter_view(trades(spark, sf)))


def _entries(spark, sf, prints=None):
    """Stored once: the cutoff, the cohort and the signals all read them."""
    timeline = _timeline(spark, sf) if prints is None else I.position_timeline(prints)
    return materialize(I.entries_only(timeline), "entries")


def _stored_prints(spark, sf):
    """Trades and the taker's view of them, as a lake stores them; timelines and as-of joins read them twice."""
    stored = materialize(trades(spark, sf), "trades")
    return stored, I.punter_view(stored)


@query("w01_punter_view", "SELECT * FROM punter", ("punter",))
def _(spark, sf):
    return I.punter_view(trades(spark, sf))


@query("w02_timeline", "SELECT * FROM timeline", ("timeline",))
def _(spark, sf):
    return _timeline(spark, sf)


@query("w03_entries_only", "SELECT * FROM entries", ("entries",))
def _(spark, sf):
    return I.entries_only(_timeline(spark, sf))


_PUNTER_TABLES = """
  SELECT player, market_id, token_side, usd_(sum(micro_(tok))) AS net_tokens, usd_(sum(micro_(usd))) AS net_usd
  FROM (SELECT taker AS player, market_id, nonusdc_side AS token_side,
               CASE WHEN taker_direction = 'BUY' THEN token_amount ELSE -token_amount END AS tok,
               CASE WHEN taker_direction = 'BUY' THEN -usd_amount ELSE usd_amount END AS usd FROM punter)
  GROUP BY 1, 2, 3"""
_PUNTER_WINNERS = """
  SELECT market_id, CASE WHEN t1 >= 0.98 THEN 'token1' WHEN t2 >= 0.98 THEN 'token2' ELSE 'open' END AS winner
  FROM (SELECT market_id, max(p) FILTER (s = 'token1') AS t1, max(p) FILTER (s = 'token2') AS t2
        FROM (SELECT market_id, nonusdc_side AS s, arg_max(price, (timestamp, orderfilled_id)) AS p
              FROM punter GROUP BY 1, 2) GROUP BY 1)"""


@query("w04_punter_stats", f"""
  SELECT player, count(*) FILTER (won) AS n_won, count(*) FILTER (NOT won) AS n_lost,
         usd_(coalesce(sum(micro_(net_usd + net_tokens)) FILTER (won), 0)) AS total_won_usd,
         abs(usd_(coalesce(sum(micro_(net_usd)) FILTER (NOT won), 0))) AS total_lost_usd, count(*) AS n_bets
  FROM (SELECT p.*, token_side = winner AS won FROM ({_PUNTER_TABLES}) p JOIN ({_PUNTER_WINNERS}) USING (market_id)
        WHERE net_tokens > 0 AND winner <> 'open') GROUP BY 1""", ("punter",))
def _(spark, sf):
    # The view's price ceiling would leave no proxy winner strictly above 0.98; 0.98 itself counts.
    stats = I.punter_player_stats(I.punter_view(trades(spark, sf)))
    return stats.select("player", "n_won", "n_lost", "total_won_usd", "total_lost_usd", "n_bets")


@query("w05_leader_cohort", "SELECT * FROM leaders", ("leaders",))
def _(spark, sf):
    entries = _entries(spark, sf)
    return I.leader_cohort(entries, I.entry_cutoff(entries))


@query("w06_random_cohort", """
  SELECT taker FROM (SELECT DISTINCT taker FROM entries) ORDER BY md5('7:' || taker), taker LIMIT 5""", ("entries",))
def _(spark, sf):
    return I.random_cohort(I.entries_only(_timeline(spark, sf)), seed=7, n=5)


_NEXT_PRINT = """
  SELECT e.taker AS leader, e.market_id, e.nonusdc_side AS token_side, e.price AS leader_price, f.price AS fill_price,
         e.timestamp AS leader_ts, f.timestamp AS fill_ts, f.price - e.price AS slippage, 200.0::DOUBLE AS bet_usd,
         200.0::DOUBLE / f.price AS tokens,
         CASE WHEN r.winner_token IS NULL OR r.winner_token = 'open' THEN NULL
              WHEN r.winner_token = e.nonusdc_side THEN 200.0::DOUBLE / f.price ELSE 0.0::DOUBLE END AS payoff_usd,
         e.orderfilled_id
  FROM (SELECT e.*, (SELECT min((p.timestamp, p.orderfilled_id)) FROM punter p
                     WHERE p.market_id = e.market_id AND p.nonusdc_side = e.nonusdc_side
                       AND p.timestamp > e.timestamp AND p.timestamp <= e.timestamp + 7200) AS nxt
        FROM entries e WHERE e.timestamp >= (SELECT cutoff FROM cutoff)) e
  JOIN punter f ON f.orderfilled_id = e.nxt[2]
  LEFT JOIN resolutions r ON r.market_id = e.market_id"""
_W07_VIEWS = ("entries", "punter", "cutoff", "resolutions")


def _next_prints(spark, sf):
    t, prints = _stored_prints(spark, sf)
    entries = _entries(spark, sf, prints)
    test = entries.where(F.col("timestamp") >= I.entry_cutoff(entries))
    return B.next_print_asof(test, prints, market_resolution(t), tolerance_secs=7200)


@query("w07_next_print", f"""
  SELECT leader, market_id, token_side, leader_price, fill_price, leader_ts, fill_ts, round(slippage, 6) AS slippage,
         bet_usd, round(tokens, 6) AS tokens, round(payoff_usd, 6) AS payoff_usd,
         round(payoff_usd - 200.0::DOUBLE, 6) AS pnl_usd, payoff_usd IS NOT NULL AS resolved, orderfilled_id
  FROM ({_NEXT_PRINT})""", _W07_VIEWS)
def _(spark, sf):
    return rounded(_next_prints(spark, sf), "slippage", "tokens", "payoff_usd", "pnl_usd")


@query("w07_next_print_summary", f"""
  SELECT count(*) AS n_bets, count(payoff_usd) AS n_resolved, count(*) FILTER (payoff_usd > 0) AS n_won,
         usd_(coalesce(sum(micro_(payoff_usd - 200.0::DOUBLE)), 0)) AS total_pnl_usd,
         round(avg(slippage), 6) AS mean_slippage,
         round(coalesce(count(*) FILTER (payoff_usd > 0) / nullif(CAST(count(payoff_usd) AS DOUBLE), 0), 0), 6)
           AS win_rate
  FROM ({_NEXT_PRINT})""", _W07_VIEWS)
def _(spark, sf):
    return rounded(B.next_print_summary(_next_prints(spark, sf)), "mean_slippage", "win_rate")


def _copy_candidates(spark, sf, fee_bps=10.0):
    t, prints = _stored_prints(spark, sf)
    entries = _entries(spark, sf, prints)
    cutoff = I.entry_cutoff(entries)
    end = t.agg(F.max("timestamp")).first()[0] + 1
    signals = B.leader_signals(entries, I.leader_cohort(entries, cutoff), cutoff, end)
    return B.copy_fill_asof(
        signals, prints, market_outcomes(spark, sf), end, latency_secs=60, fee_bps=fee_bps
    )


_COPY = """
  SELECT taker AS leader, market_id, nonusdc_side AS token_side, taker_direction AS direction,
         timestamp AS signal_ts, fill_ts, settled_ts, 200.0::DOUBLE AS capital_reserved, 0.2::DOUBLE AS fee_usd,
         fill_price, CASE WHEN taker_direction = 'BUY' THEN
             CASE WHEN hit THEN 200.0::DOUBLE / fill_price ELSE 0.0::DOUBLE END
           ELSE 200.0::DOUBLE + 200.0::DOUBLE / greatest(1 - fill_price, 1e-9::DOUBLE)
                * (fill_price - CASE WHEN hit THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) - 0.2::DOUBLE END AS payoff_usd,
         orderfilled_id
  FROM (SELECT e.*, f.timestamp AS fill_ts, f.price AS fill_price, o.resolved_at AS settled_ts,
               o.winner_token = e.nonusdc_side AS hit
        FROM (SELECT e.*, (SELECT min((p.timestamp, p.orderfilled_id)) FROM punter p
                           WHERE p.market_id = e.market_id AND p.nonusdc_side = e.nonusdc_side
                             AND p.taker_direction <> e.taker_direction
                             AND p.timestamp >= e.timestamp + 60) AS nxt
              FROM entries e JOIN leaders USING (taker)
              WHERE e.timestamp >= (SELECT cutoff FROM cutoff)
                AND e.timestamp < (SELECT max(timestamp) + 1 FROM trades)) e
        JOIN punter f ON f.orderfilled_id = e.nxt[2]
        JOIN market_outcomes o ON o.market_id = e.market_id
        WHERE f.timestamp < (SELECT max(timestamp) + 1 FROM trades)
          AND o.resolved_at <= (SELECT max(timestamp) + 1 FROM trades))"""
_COPY_VIEWS = ("entries", "punter", "cutoff", "leaders", "market_outcomes")


@query("w08_copy_fills", f"""
  SELECT * REPLACE (round(payoff_usd, 6) AS payoff_usd), round(CASE WHEN direction = 'BUY'
         THEN payoff_usd - 200.0::DOUBLE - 0.2::DOUBLE ELSE payoff_usd - 200.0::DOUBLE END, 6) AS pnl_usd
  FROM ({_COPY})""", _COPY_VIEWS)
def _(spark, sf):
    return rounded(_copy_candidates(spark, sf), "payoff_usd", "pnl_usd")


# The admission walk as a recursion over the signals in time order, its state the
# list of settlement times still holding capital; each leader is a portfolio of 2 slots.
_ADMITTED = f"""
  c AS ({_COPY}),
  n AS (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY signal_ts, orderfilled_id) AS i FROM c),
  walk AS (
    SELECT leader, i, orderfilled_id, TRUE AS fits, [settled_ts] AS busy FROM n WHERE i = 1
    UNION ALL
    SELECT n.leader, n.i, n.orderfilled_id, len(list_filter(w.busy, lambda s: s > n.signal_ts)) < 2,
           CASE WHEN len(list_filter(w.busy, lambda s: s > n.signal_ts)) < 2
                THEN list_append(list_filter(w.busy, lambda s: s > n.signal_ts), n.settled_ts)
                ELSE list_filter(w.busy, lambda s: s > n.signal_ts) END
    FROM walk w JOIN n ON n.leader = w.leader AND n.i = w.i + 1)"""


def _admitted_sql(tail: str) -> str:
    from outcomelake.plans.fixtures import with_ctes

    return with_ctes(f"SELECT 1, {_ADMITTED}", *_COPY_VIEWS).replace("WITH ", "WITH RECURSIVE ", 1).replace(
        "\nSELECT 1, ", ",\n"
    ) + tail


@query("w09_capital_admission", _admitted_sql(
    " SELECT leader, orderfilled_id FROM walk WHERE fits"))
def _(spark, sf):
    admitted = B.admit_by_capital(
        materialize(_copy_candidates(spark, sf), "candidates"), bankroll=10_000.0, per_bet_frac=0.5, portfolio=["leader"]
    )
    return admitted.select("leader", "orderfilled_id")


def _one_bankroll_sql(slots: int, tail: str) -> str:
    """The walk with all leaders on one bankroll of so many reservations."""
    whole = _admitted_sql(tail).replace("PARTITION BY leader ORDER BY", "ORDER BY").replace(
        "n.leader = w.leader AND n.i = w.i + 1", "n.i = w.i + 1")
    return whole.replace("< 2", f"< {slots}")


@query("w09_single_bankroll", _one_bankroll_sql(50, " SELECT leader, orderfilled_id FROM walk WHERE fits"))
def _(spark, sf):
    admitted = B.admit_by_capital(materialize(_copy_candidates(spark, sf), "candidates"))
    return admitted.select("leader", "orderfilled_id")


def _admitted(spark, sf):
    """Bets of 200 that a bankroll of 1000 can fund, all leaders on one account."""
    return B.admit_by_capital(materialize(_copy_candidates(spark, sf), "candidates"), bankroll=1_000.0, per_bet_frac=0.2)


_BET = "c JOIN walk w ON w.orderfilled_id = c.orderfilled_id AND w.fits"


@query("w10_cash_ledger", _one_bankroll_sql(5, f"""
  SELECT orderfilled_id, timestamp, round(amount_usd, 6) AS amount_usd FROM (
    SELECT c.orderfilled_id, fill_ts AS timestamp,
           -200.0::DOUBLE - CASE WHEN direction = 'BUY' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS amount_usd
    FROM {_BET} UNION ALL SELECT c.orderfilled_id, settled_ts, payoff_usd FROM {_BET})"""))
def _(spark, sf):
    return rounded(B.cash_ledger(materialize(_admitted(spark, sf), "bets")), "amount_usd")


@query("w10_copy_summary", _one_bankroll_sql(5, f"""
  SELECT count(*) AS n_bets, usd_(coalesce(sum(micro_(CASE WHEN direction = 'BUY'
    THEN payoff_usd - 200.0::DOUBLE - 0.2::DOUBLE ELSE payoff_usd - 200.0::DOUBLE END)), 0)) AS total_pnl_usd
  FROM {_BET}"""))
def _(spark, sf):
    return B.copy_summary(_admitted(spark, sf))


def _bars(spark, sf):
    return B.transaction_bars(trades(spark, sf), 86_400)


@query("w11_transaction_bars", "SELECT * FROM bars", ("bars",))
def _(spark, sf):
    return _bars(spark, sf)


@query("w12_sma_signal", "SELECT * REPLACE (CAST(signal AS BIGINT) AS signal) FROM signals", ("signals",))
def _(spark, sf):
    return B.sma_signal(_bars(spark, sf)).withColumn("signal", F.col("signal").cast("long"))


_TEST_BARS = """
  SELECT * FROM signals WHERE timestamp > (
    SELECT timestamp FROM (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS r, count(*) OVER () AS n
                           FROM signals) WHERE r = CAST(floor(0.7 * (n - 1) + 0.5) AS BIGINT))"""


def _test_bars(spark, sf):
    return B.walk_forward_test(materialize(B.sma_signal(_bars(spark, sf)), "signals"))


@query("w13_buy_and_hold", f"""
  SELECT market_id, nonusdc_side, arg_max(close, timestamp) - arg_min(close, timestamp) AS one_share_price_change
  FROM ({_TEST_BARS}) GROUP BY 1, 2""", ("signals",))
def _(spark, sf):
    return B.buy_and_hold(_test_bars(spark, sf))


_STEPS = f"""
  SELECT *, CASE WHEN peak > 0 THEN (peak - marked_equity) / peak ELSE 0.0::DOUBLE END AS drawdown
  FROM (SELECT *, greatest(0.0::DOUBLE, max(marked_equity) OVER w) AS peak
        FROM (SELECT *, cash + shares * close AS marked_equity, shares * close AS exposure
              FROM (SELECT *, -sum(delta * fill_price + abs(delta) * fill_price * (10.0::DOUBLE / 10000)) OVER w AS cash
                    FROM (SELECT *, close * (1 + sign(delta) * (20.0::DOUBLE / 10000)) AS fill_price
                          FROM (SELECT *, CAST(lag(signal, 1, 0) OVER w AS DOUBLE) AS shares,
                                       CAST(lag(signal, 1, 0) OVER w - lag(signal, 2, 0) OVER w AS DOUBLE) AS delta,
                                       lag(timestamp, 1) OVER w AS signal_timestamp
                                FROM ({_TEST_BARS})
                                WINDOW w AS (PARTITION BY market_id, nonusdc_side ORDER BY timestamp)))
                    WINDOW w AS (PARTITION BY market_id, nonusdc_side ORDER BY timestamp
                                 ROWS UNBOUNDED PRECEDING)))
        WINDOW w AS (PARTITION BY market_id, nonusdc_side ORDER BY timestamp ROWS UNBOUNDED PRECEDING))"""


def _backtest(spark, sf):
    return B.next_observation_pnl(_test_bars(spark, sf), fee_bps=10, slippage_bps=20)


@query("w14_backtest_equity", f"""
  SELECT market_id, nonusdc_side, timestamp, round(cash, 9) + 0.0 AS cash, shares,
         round(marked_equity, 9) + 0.0 AS marked_equity, round(exposure, 9) AS exposure, round(drawdown, 9) AS drawdown
  FROM ({_STEPS})""", ("signals",))
def _(spark, sf):
    out = rounded(_backtest(spark, sf).equity, "cash", "marked_equity", "exposure", "drawdown", digits=9)
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("cash", "marked_equity")})


@query("w14_backtest_fills", f"""
  SELECT market_id, nonusdc_side, signal_timestamp, timestamp AS fill_timestamp,
         CAST(shares AS BIGINT) AS target_shares, delta AS delta_shares, round(fill_price, 9) AS fill_price,
         round(abs(delta) * fill_price * (10.0::DOUBLE / 10000), 9) AS fee,
         round(abs(delta) * fill_price, 9) AS notional FROM ({_STEPS}) WHERE delta <> 0""", ("signals",))
def _(spark, sf):
    return rounded(_backtest(spark, sf).fills, "fill_price", "fee", "notional", digits=9)


@query("w14_backtest_summary", f"""
  SELECT market_id, nonusdc_side, round(sum(abs(delta) * fill_price), 9) AS turnover,
         round(max(drawdown), 9) AS max_drawdown, round(arg_max(marked_equity, timestamp), 9) + 0.0 AS final_equity
  FROM ({_STEPS}) GROUP BY 1, 2""", ("signals",))
def _(spark, sf):
    out = rounded(_backtest(spark, sf).summary, "turnover", "max_drawdown", "final_equity", digits=9)
    return out.withColumn("final_equity", F.col("final_equity") + F.lit(0.0))


# Four series on hourly clocks; the value is the highest price of the hour.
_SERIES = """
  SELECT nonusdc_side || '_' || taker_direction AS series, timestamp // 3600 * 3600 AS timestamp, max(price) AS value
  FROM trades GROUP BY 1, 2"""
_NAMES = ["token1_BUY", "token1_SELL", "token2_BUY", "token2_SELL"]
_WIDE = "SELECT timestamp, " + ", ".join(
    f"max(value) FILTER (series = '{n}') AS {n}" for n in _NAMES) + f" FROM ({_SERIES}) GROUP BY 1"


def _series(spark, sf):
    return (
        trades(spark, sf).groupBy(F.concat_ws("_", "nonusdc_side", "taker_direction").alias("series"),
                 (F.floor(F.col("timestamp") / 3600) * 3600).alias("timestamp"))
        .agg(F.max("price").alias("value"))
    )


@query("w15_align_to_clock", "SELECT timestamp, " + ", ".join(
    f"coalesce({n}, -1.0::DOUBLE) AS {n}" for n in _NAMES) + f" FROM ({_WIDE})", ("trades",))
def _(spark, sf):
    out = align_to_clock(_series(spark, sf), _NAMES)
    return out.withColumns({n: F.nanvl(n, F.lit(-1.0)) for n in _NAMES})


@query("w15_align_forward_fill", "SELECT timestamp, " + ", ".join(
    f"coalesce(last_value({n} IGNORE NULLS) OVER (ORDER BY timestamp), -1.0::DOUBLE) AS {n}" for n in _NAMES)
    + f" FROM ({_WIDE})", ("trades",))
def _(spark, sf):
    out = align_to_clock(_series(spark, sf), _NAMES, forward_fill=True)
    return out.withColumns({n: F.nanvl(n, F.lit(-1.0)) for n in _NAMES})
