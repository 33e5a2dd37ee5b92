"""W01–W06 — the taker's view: real bets, position timelines, leader cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelake.functions import from_micros, micros, signed
from outcomelake.functions.ranks import quantile_nearest
from outcomelake.functions.skew import DEFAULT_POLICY, SkewPolicy, running_sum
from outcomelake.operators.positions import compute_player_stats
from outcomelake.operators.wallets import PLATFORM_WALLETS


def punter_view(
    trades: DataFrame,
    min_usd: float = 1.0,
    price_floor: float = 0.02,
    price_ceiling: float = 0.98,
    drop_platform_wallets: bool = True,
) -> DataFrame:
    """W01 — fills that are discretionary bets; a null in a tested column drops the row."""
    keep = (
        (F.col("maker") != F.col("taker"))
        & (F.col("usd_amount") >= min_usd)
        & (F.col("price") >= price_floor)
        & (F.col("price") <= price_ceiling)
    )
    if drop_platform_wallets:
        keep &= ~F.col("maker").isin(*PLATFORM_WALLETS) & ~F.col("taker").isin(*PLATFORM_WALLETS)
    return trades.where(keep)


def _event_kind(before: Column, after: Column) -> Column:
    same_sign = F.signum(before) == F.signum(after)
    return (
        F.when(before == 0, "entry")
        .when(same_sign & (F.abs(after) > F.abs(before)), "add")
        .when(~same_sign & (after != 0), "flip")
        .when(after == 0, "exit")
        .otherwise("reduce")
    )


def position_timeline(bets: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """W02 — running position per (taker, market, side) and what each fill did to it.

    Summed in exact 1e-6 units, so "closed" means exactly zero.
    """
    units = signed("taker_direction", micros("token_amount"))
    summed = running_sum(
        bets.withColumn("_units", units),
        ["taker", "market_id", "nonusdc_side"],
        ("timestamp", "orderfilled_id"),
        {"_after": "_units"},
        policy,
    )
    before = F.col("_after") - F.col("_units")
    return summed.select(
        *bets.columns,
        from_micros("_units").alias("signed_tokens"),
        from_micros("_after").alias("cum_position"),
        from_micros(before).alias("prev_position"),
        _event_kind(before, F.col("_after")).alias("event_kind"),
    )


def entries_only(timeline: DataFrame) -> DataFrame:
    """W03 — the fills that opened a position."""
    return timeline.where(F.col("event_kind") == "entry")


def punter_player_stats(bets: DataFrame, win_threshold: float = 0.98) -> DataFrame:
    """W04 — player statistics over the takers' bets only."""
    return compute_player_stats(bets, player_side="taker", win_threshold=win_threshold)


def entry_cutoff(entries: DataFrame, q: float = 0.7) -> int | None:
    """The entry time at quantile ``q``."""
    return quantile_nearest(entries, "timestamp", q)


def leader_cohort(entries: DataFrame, cutoff: int, n: int = 5) -> DataFrame:
    """W05 — the takers with the most entries before the cutoff."""
    return (
        entries.where(F.col("timestamp") < cutoff)
        .groupBy("taker")
        .agg(F.count(F.lit(1)).alias("n_entries"))
        .orderBy(F.desc("n_entries"), "taker")
        .limit(n)
    )


def random_cohort(entries: DataFrame, seed: int, n: int = 1) -> DataFrame:
    """W06 — a control sample of distinct takers, the same for the same seed and takers."""
    return (
        entries.select("taker")
        .distinct()
        .orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("taker")).cast("binary")), "taker")
        .limit(n)
    )
