"""A13–A16 — maker-side wallet metrics, scorecards and the ranked report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelake.functions import clamp_mark, sum_micros
from outcomelake.operators.positions import last_price_per_side

# Platform routers and liquidity wallets, never discretionary traders.
PLATFORM_WALLETS = (
    "0xc5d563a36ae78145c45a50134d48a1215220f80a",
    "0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e",
)
BIG_WIN_PCT = 70.0


def _per_unit(total: str, units: str) -> Column:
    return F.when(F.col(units) > 0, F.col(total) / F.col(units))


def wallet_market_metrics(
    trades: DataFrame, markets: DataFrame, marks: DataFrame | None = None
) -> DataFrame:
    """A13 — buy and sell totals, VWAPs and P&L per (maker, market, side), for all makers at once.

    ``marks`` are last prices per (market, side); by default those of ``trades``.
    Aggregating before the join shuffles one row per wallet and side.
    """
    marks = last_price_per_side(trades) if marks is None else marks
    buy, sell = F.col("maker_direction") == "BUY", F.col("maker_direction") == "SELL"
    notional = F.col("price") * F.col("token_amount")

    def total(which: Column, amount: str | Column) -> Column:
        value = F.col(amount) if isinstance(amount, str) else amount
        return sum_micros(F.when(which, value))

    sums = trades.groupBy("maker", "market_id", F.col("nonusdc_side").alias("side")).agg(
        F.count(F.lit(1)).alias("trades"),
        F.max("timestamp").alias("last_trade_ts"),
        total(buy, "usd_amount").alias("buy_usd"),
        total(sell, "usd_amount").alias("sell_usd"),
        total(buy, "token_amount").alias("buy_tokens"),
        total(sell, "token_amount").alias("sell_tokens"),
        total(buy, notional).alias("buy_notional"),
        total(sell, notional).alias("sell_notional"),
    )
    priced = sums.join(
        marks.select(
            "market_id", F.col("token_side").alias("side"), clamp_mark("last_price").alias("last_price")
        ),
        ["market_id", "side"],
        "left",
    ).join(markets.select(F.col("id").alias("market_id"), "question"), "market_id", "left")
    held = F.col("buy_tokens") - F.col("sell_tokens")
    exits = (
        priced.withColumn("_held_usd", held * F.col("last_price"))
        .withColumn("_exit_tokens", F.col("sell_tokens") + held)
        .withColumn("_exit_notional", F.col("sell_notional") + F.col("_held_usd"))
        .withColumn("avg_buy_price", _per_unit("buy_notional", "buy_tokens"))
        .withColumn("avg_sold_price_only", _per_unit("sell_notional", "sell_tokens"))
        .withColumn("avg_sell_price", _per_unit("_exit_notional", "_exit_tokens"))
    )
    gain = F.try_divide(F.col("avg_sell_price") - F.col("avg_buy_price"), F.col("avg_buy_price"))
    return exits.select(
        "maker", "market_id", "side", "question", "trades", "avg_buy_price", "avg_sold_price_only",
        "avg_sell_price", "last_price",
        (F.col("sell_usd") - F.col("buy_usd") + F.col("_held_usd")).alias("total_pnl_usd"),
        "last_trade_ts", "buy_usd", "sell_usd", "buy_tokens", "sell_tokens", "buy_notional",
        "sell_notional", (gain * 100).alias("pct_change"),
    )


def combine_sides(metrics: DataFrame) -> DataFrame:
    """A14 — one row per (maker, market): sides weighted by the money spent buying them."""
    weight = F.when(F.col("pct_change").isNotNull(), F.col("buy_usd")).otherwise(0.0)
    weighted = F.coalesce(F.col("pct_change") * F.col("buy_usd"), F.lit(0.0))
    return (
        # The question belongs to the market; as a key it keeps the aggregate hash-based.
        metrics.groupBy("maker", "market_id", "question")
        .agg(
            F.sum("trades").alias("trades"),
            sum_micros(weighted).alias("_num"),
            sum_micros(weight).alias("_den"),
            sum_micros("total_pnl_usd").alias("total_pnl_usd"),
            sum_micros("buy_usd").alias("buy_usd_total"),
            sum_micros("sell_usd").alias("sell_usd_total"),
            F.max("last_trade_ts").alias("last_trade_ts"),
        )
        .withColumn("pct_change", _per_unit("_num", "_den"))
        .drop("_num", "_den")
    )


def trader_scorecard(per_market: DataFrame, big_win_pct: float = BIG_WIN_PCT) -> DataFrame:
    """A15 — win rates, big-win rates, median results and total P&L per wallet.

    A median holds one value per market of the wallet, so it is bounded by the
    number of markets rather than by the number of fills.
    """
    pnl, pct = F.col("total_pnl_usd"), F.col("pct_change")
    win, loss = pnl > 0, pnl <= 0
    n, wins, big = F.col("markets_traded"), F.col("_wins"), F.col("big_wins_count")
    return (
        per_market.groupBy(F.col("maker").alias("wallet"))
        .agg(
            F.count(F.lit(1)).alias("markets_traded"),
            F.max("last_trade_ts").alias("last_trade"),
            F.count_if(win).alias("_wins"),
            F.count_if(win & (pct >= big_win_pct)).alias("big_wins_count"),
            F.median(F.when(win, pct)).alias("median_win_pct"),
            F.median(F.when(loss, pct)).alias("median_loss_pct"),
            F.median(F.when(win, pnl)).alias("median_win_usd"),
            F.median(F.when(loss, pnl)).alias("median_loss_usd"),
            sum_micros("total_pnl_usd").alias("total_pnl_usd"),
        )
        .withColumn("win_rate", wins / n)
        .withColumn("big_win_rate_overall", big / n)
        .withColumn("big_win_rate_among_wins", F.try_divide(big, wins))
        .drop("_wins")
    )


def candidate_pool(trades: DataFrame, n: int = 100) -> DataFrame:
    """A16 — the n makers with the largest volume, platform wallets left out."""
    return (
        trades.where(~F.col("maker").isin(*PLATFORM_WALLETS))
        .groupBy("maker")
        .agg(sum_micros("usd_amount").alias("volume_usd"), F.count(F.lit(1)).alias("fills"))
        .orderBy(F.desc("volume_usd"), "maker")
        .limit(n)
    )


def ranked_traders(
    trades: DataFrame,
    markets: DataFrame,
    pool_size: int = 100,
    top: int = 50,
    min_markets: int = 300,
    active_after: int = 1759276800,
    min_big_wins: int = 0,
    big_win_pct: float = BIG_WIN_PCT,
) -> DataFrame:
    """A16 — scorecards of the candidate pool, filtered for breadth and recency, best first.

    Marks come from all fills.  The pool holds ``pool_size`` rows by its limit,
    so broadcasting it is bounded.  The default recency cut is 2025-10-01 UTC.
    """
    pool = F.broadcast(candidate_pool(trades, pool_size).select("maker"))
    own = trades.join(pool, "maker", "left_semi")
    cards = trader_scorecard(
        combine_sides(wallet_market_metrics(own, markets, last_price_per_side(trades))), big_win_pct
    )
    kept = cards.where(
        (F.col("markets_traded") >= min_markets)
        & (F.col("last_trade") > active_after)
        & (F.col("big_wins_count") >= min_big_wins)
    )
    shares = ("win_rate", "big_win_rate_overall", "big_win_rate_among_wins")
    return (
        kept.withColumns({f"{c}_pct": F.round(F.col(c) * 100, 2) for c in shares})
        .orderBy(
            F.desc_nulls_last("big_win_rate_among_wins"),
            F.desc_nulls_last("median_win_pct"),
            F.desc_nulls_last("total_pnl_usd"),
            "wallet",
        )
        .limit(top)
        .select(
            "wallet", "markets_traded", "last_trade", *[f"{c}_pct" for c in shares],
            "median_win_pct", "median_loss_pct", "median_win_usd", "median_loss_usd",
            "big_wins_count", "total_pnl_usd",
        )
    )
