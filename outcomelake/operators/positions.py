"""A01–A12 — signed positions, resolutions, profit and loss, wallet rankings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelake.functions import order_key, signed, sum_micros

ROLES = ("both", "maker", "taker")
WIN_THRESHOLD = 0.98


def expand_to_positions(trades: DataFrame, player_side: str = "both") -> DataFrame:
    """A01 — one signed row per participant of a fill, in a single pass over it."""
    if player_side not in ROLES:
        raise ValueError(f"player_side must be one of {sorted(ROLES)}, got {player_side!r}")
    roles = ("maker", "taker") if player_side == "both" else (player_side,)
    rows = [
        F.struct(
            F.col(role).alias("player"),
            signed(f"{role}_direction", "token_amount").alias("signed_tokens"),
            signed(f"{role}_direction", "usd_amount", buy=-1).alias("signed_usd"),
            F.col(f"{role}_direction").alias("direction"),
        )
        for role in roles
    ]
    shared = ["timestamp", "market_id", F.col("nonusdc_side").alias("token_side"), "price"]
    out = trades.select(*shared, F.inline(F.array(*rows)))
    return out.select(
        "timestamp", "market_id", "player", "token_side", "signed_tokens", "signed_usd", "direction", "price"
    )


def positions_table(trades: DataFrame, player_side: str = "both") -> DataFrame:
    """A02 — net tokens and cash per (player, market, side), combined map-side."""
    return (
        expand_to_positions(trades, player_side)
        .groupBy("player", "market_id", "token_side")
        .agg(
            sum_micros("signed_tokens").alias("net_tokens"),
            sum_micros("signed_usd").alias("net_usd"),
            F.count_if(F.col("direction") == "BUY").alias("n_buys"),
            F.count_if(F.col("direction") == "SELL").alias("n_sells"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
        )
    )


def last_price_per_side(trades: DataFrame) -> DataFrame:
    """A03 — price of the last fill per (market, side), ties broken by fill id."""
    key = order_key(trades, "timestamp", "orderfilled_id")
    return trades.groupBy("market_id", F.col("nonusdc_side").alias("token_side")).agg(
        F.max_by("price", key).alias("last_price")
    )


def resolution_from_last(last: DataFrame, win_threshold: float = WIN_THRESHOLD) -> DataFrame:
    """Both sides' last prices in one row per market, and the price-implied winner."""
    side = {t: F.max(F.when(F.col("token_side") == t, F.col("last_price"))) for t in ("token1", "token2")}
    return (
        last.groupBy("market_id")
        .agg(*[v.alias(t) for t, v in side.items()])
        .withColumn(
            "winner_token",
            F.when(F.col("token1") >= win_threshold, "token1")
            .when(F.col("token2") >= win_threshold, "token2")
            .otherwise("open"),
        )
    )


def market_resolution(trades: DataFrame, win_threshold: float = WIN_THRESHOLD) -> DataFrame:
    """A04 — market_id, token1, token2 (last prices) and winner_token."""
    return resolution_from_last(last_price_per_side(trades), win_threshold)


def _proxy_outcome() -> Column:
    held = F.col("net_tokens") > 0
    same = F.col("token_side") == F.col("winner_token")
    return (
        F.when(F.col("net_tokens") == 0, "flat")
        .when(F.col("winner_token") == "open", "open")
        .when(same & held, "won")
        .when(~same & held, "lost")
        .otherwise("flat")
    )


def _proxy_pnl() -> Column:
    cash, tokens = F.col("net_usd"), F.col("net_tokens")
    return (
        F.when(F.col("outcome") == "won", cash + tokens)
        .when(F.col("outcome") == "open", cash + tokens * F.col("last_price"))
        .otherwise(cash)
    )


def label_outcomes(positions: DataFrame, resolutions: DataFrame, last_prices: DataFrame) -> DataFrame:
    """A05 — flat, open, won or lost, and profit and loss, per position.

    A net short is ``flat`` here and its result is the cash already taken.
    """
    return (
        positions.join(resolutions.select("market_id", "winner_token"), "market_id", "left")
        .join(last_prices, ["market_id", "token_side"], "left")
        .withColumn("outcome", _proxy_outcome())
        .withColumn("pnl_usd", _proxy_pnl())
    )


def player_aggregates(labelled: DataFrame) -> DataFrame:
    """A06 — decided bets per player: counts, won and lost amounts, win rate, score."""
    decided = labelled.where(F.col("outcome").isin("won", "lost"))
    won, lost = F.col("outcome") == "won", F.col("outcome") == "lost"
    return (
        decided.groupBy("player")
        .agg(
            F.count_if(won).alias("n_won"),
            F.count_if(lost).alias("n_lost"),
            sum_micros(F.when(won, F.col("pnl_usd"))).alias("total_won_usd"),
            F.abs(sum_micros(F.when(lost, F.col("pnl_usd")))).alias("total_lost_usd"),
            sum_micros("pnl_usd").alias("net_usd_pnl"),
        )
        .withColumn("n_bets", F.col("n_won") + F.col("n_lost"))
        .withColumn("win_rate", F.col("n_won") / F.col("n_bets").cast("double"))
        .withColumn("score_c", score_c(F.col))
    )


def compute_player_stats(
    trades: DataFrame, player_side: str = "both", win_threshold: float = WIN_THRESHOLD
) -> DataFrame:
    """A07 — A01 to A06 in one lineage.

    The resolution row already carries both last prices, so positions meet the
    market level once instead of once for the winner and once for the price.
    """
    markets = market_resolution(trades, win_threshold)
    labelled = (
        positions_table(trades, player_side)
        .join(markets, "market_id", "left")
        .withColumn(
            "last_price", F.when(F.col("token_side") == "token1", F.col("token1")).otherwise(F.col("token2"))
        )
        .withColumn("outcome", _proxy_outcome())
        .withColumn("pnl_usd", _proxy_pnl())
    )
    return player_aggregates(labelled)


def label_official(positions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Official labels: shorts can win; without a winner the position is open."""
    winner, side, net = F.col("winner_token"), F.col("token_side"), F.col("net_tokens")
    right = ((net > 0) & (side == winner)) | ((net < 0) & (side != winner))
    return (
        positions.join(outcomes.select("market_id", "winner_token"), "market_id", "left")
        .withColumn(
            "outcome",
            F.when(winner.isNull(), "open").when(net == 0, "flat").when(right, "won").otherwise("lost"),
        )
        .withColumn("pnl_usd", F.col("net_usd") + net * (side == winner).cast("double"))
    )


def compute_player_stats_from_outcomes(
    trades: DataFrame, outcomes: DataFrame, player_side: str = "both"
) -> DataFrame:
    """A08 — the same statistics from official winners, never from last prices."""
    return player_aggregates(label_official(positions_table(trades, player_side), outcomes))


ScoreFn = Callable[[Callable[[str], Column]], Column]


def score_c(c: Callable[[str], Column]) -> Column:
    """A09 — win rate times the log of the amount won, floored at 1."""
    return c("win_rate") * F.ln(F.greatest(c("total_won_usd"), F.lit(1.0)))


def score_money_ratio(c: Callable[[str], Column]) -> Column:
    """A09 — amount won over amount lost, the latter floored at one dollar."""
    return c("total_won_usd") / F.greatest(c("total_lost_usd"), F.lit(1.0))


def score_win_rate(c: Callable[[str], Column]) -> Column:
    return c("win_rate")


def score_total_won(c: Callable[[str], Column]) -> Column:
    return c("total_won_usd")


def select_top_n(
    stats: DataFrame,
    n: int = 128,
    min_win_rate: float = 0.5,
    min_n_bets: int = 20,
    score_fn: ScoreFn = score_c,
) -> DataFrame:
    """A10 — the n best players by score (nulls last, player breaks ties), as a top-k."""
    return (
        stats.where(F.col("win_rate") > min_win_rate)
        .where(F.col("n_bets") >= min_n_bets)
        .withColumn("score", score_fn(F.col))
        .orderBy(F.desc_nulls_last("score"), "player")
        .limit(n)
    )


def wallet_inventory(
    trades: DataFrame, outcomes: DataFrame, markets: DataFrame, wallet: str | None = None
) -> DataFrame:
    """A11 — inventory marked at the last price with the official winner, for one or all wallets.

    Marks come from all fills of the market, the inventory from the wallet's.
    """
    own = trades
    if wallet is not None:
        own = trades.where((F.col("maker") == wallet) | (F.col("taker") == wallet))
    net = positions_table(own)
    if wallet is not None:
        net = net.where(F.col("player") == wallet)
    marks = last_price_per_side(trades).withColumnRenamed("last_price", "mark_price")
    return (
        net.join(marks, ["market_id", "token_side"], "left")
        .join(outcomes.select("market_id", "winner_token", "resolved_at"), "market_id", "left")
        .join(markets.select(F.col("id").alias("market_id"), "question"), "market_id")
        .select(
            "player", "market_id", "question", "token_side", "net_tokens",
            F.col("net_usd").alias("net_cash_flow"), F.col("last_ts").alias("last_trade_at"), "mark_price",
            (F.col("net_tokens") * F.col("mark_price") + F.col("net_usd")).alias("estimated_value"),
            "winner_token", "resolved_at",
        )
    )


def last_price_vs_outcome(trades: DataFrame, outcomes: DataFrame, markets: DataFrame) -> DataFrame:
    """A12 — last price of any side per resolved market, next to its official outcome."""
    key = order_key(trades, "timestamp", "orderfilled_id")
    last = trades.groupBy("market_id").agg(F.max_by("price", key).alias("last_observed_price"))
    return (
        outcomes.select("market_id", "winner_token", "resolved_at")
        .join(last, "market_id", "left")
        .join(markets.select(F.col("id").alias("market_id"), "question"), "market_id")
    )


