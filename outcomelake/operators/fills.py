"""D01–D05, D13–D18 — raw fills to trades, gates, de-duplication, profiles and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outcomelake.functions import opposite
from outcomelake.functions.exprs import MICRO

CASH_ASSET = "0"

# Exchange contracts, which must never appear as a party of a trade.
EXCHANGE_ADDRESSES = (
    "0xe111180000d2663c0091e4f400237545b87b996b",
    "0xe2222d279d744050d28e00520010520000310f59",
)

TRADE_COLUMNS = (
    "timestamp", "market_id", "maker", "taker", "nonusdc_side", "maker_direction", "taker_direction",
    "price", "usd_amount", "token_amount", "transactionHash", "orderfilled_id",
)

# What a trade is made of; the other columns of a raw fill need not be shuffled for it.
TRADE_FIELDS = (
    "id", "block_timestamp", "user_id", "counterparty_id", "asset", "side", "price", "amount_usdc", "amount_shares", "transaction_hash",
)


class UnresolvedAssetsError(RuntimeError):
    """Eligible fills whose asset has no market; nothing was written."""


class TradeModelError(RuntimeError):
    """Normalised trades with an exchange contract as a party; nothing was written."""


def dedupe(df: DataFrame, keys: list[str], order: list[str | Column], keep: str = "last") -> DataFrame:
    """D13 — one row per key, the first or last by ``order``, which must be total.

    Filtering a row number on 1 makes
    Spark cut each map task's rows to one per key before the shuffle, so a key
    with very many copies costs one row per task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, got {keep!r}")
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranked = [c.desc_nulls_last() if keep == "last" else c.asc_nulls_first() for c in cols]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedupe_guarded(df: DataFrame, keys: list[str], order: list[str | Column], keep: str = "last") -> DataFrame:
    """D13 — ``dedupe``, or all rows as they are where any row lacks a key, since those would collapse into one.

    Looks at once, and only until the first row without a key.
    """
    lacking = df.where(" OR ".join(f"`{k}` IS NULL" for k in keys))
    return dedupe(df, keys, order, keep) if lacking.isEmpty() else df


def normalize_fills_v1(orders: DataFrame, assets: DataFrame) -> DataFrame:
    """D01 — first-generation fills to trades.

    ``assets`` is the asset dimension (asset, market_id, token_side).  Fills of
    two outcome tokens, of unknown assets, with a price outside [0, 1] or a
    non-positive amount are dropped.
    """
    maker_pays = F.col("makerAssetId") == CASH_ASSET
    taker_pays = F.col("takerAssetId") == CASH_ASSET
    cash = F.when(taker_pays, F.col("takerAmountFilled")).otherwise(F.col("makerAmountFilled"))
    tokens = F.when(taker_pays, F.col("makerAmountFilled")).otherwise(F.col("takerAmountFilled"))
    sided = orders.where(maker_pays | taker_pays).select(
        "timestamp", "maker", "taker", "transactionHash", F.col("id").alias("orderfilled_id"),
        F.when(maker_pays, F.col("takerAssetId")).otherwise(F.col("makerAssetId")).alias("asset"),
        F.when(taker_pays, "BUY").otherwise("SELL").alias("taker_direction"),
        F.when(taker_pays, "SELL").otherwise("BUY").alias("maker_direction"),
        cash.cast("double").alias("_cash"), tokens.cast("double").alias("_tokens"),
    )
    # On whole units a price within [0, 1] is cash <= tokens, and no division precedes the filter.
    return (
        sided.where((F.col("_cash") > 0) & (F.col("_tokens") > 0) & (F.col("_cash") <= F.col("_tokens")))
        .withColumn("usd_amount", F.col("_cash") / MICRO)
        .withColumn("token_amount", F.col("_tokens") / MICRO)
        .withColumn("price", F.col("usd_amount") / F.col("token_amount"))
        .join(assets.select("asset", "market_id", F.col("token_side").alias("nonusdc_side")), "asset")
        .select(*TRADE_COLUMNS)
    )


def valid_maker_fills(fills: DataFrame, ingest_order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """D02 — the latest version of each fill, if it is a well-formed maker fill.

    De-duplication comes before the filter, so a maker row later corrected to a
    taker row does not survive.  With ``columns`` the others are left behind before the shuffle, and versions that
    the filter would drop bring none but their id; all of it still counts in the choice of the version.
    """
    spelled = fills.withColumns({"side": F.upper(F.col("side").cast("string")), "order_type": F.lower(F.col("order_type").cast("string"))})
    order = ingest_order or [c for c in ("ingest_seq", "block_timestamp") if c in fills.columns]
    # Of versions that nothing else orders the taker's stands, then the one of the greater hash: a total order.
    content = F.xxhash64(*sorted(spelled.columns))
    valid = (
        F.col("side").isin("BUY", "SELL")
        & (F.col("order_type") == "maker")
        & F.col("price").cast("double").between(0, 1)
        & (F.col("amount_usdc").cast("double") > 0)
        & (F.col("amount_shares").cast("double") > 0)
    )
    if columns is None:
        return dedupe(spelled, ["id"], [*order, "order_type", content], keep="last").where(valid)
    ranked = dict.fromkeys([*order, "order_type"])
    narrow = spelled.select("*", content.alias("_content"), F.coalesce(valid, F.lit(False)).alias("_valid")).select(
        "id", *ranked, "_content", "_valid", *[F.when(F.col("_valid"), F.col(c)).alias(c) for c in columns if c != "id" and c not in ranked])
    return dedupe(narrow, ["id"], [*order, "order_type", "_content"], keep="last").where("_valid").select(*columns)


def _as_trades(joined: DataFrame, *more: str) -> DataFrame:
    return joined.select(
        F.col("block_timestamp").cast("long").alias("timestamp"), "market_id",
        F.col("user_id").alias("maker"), F.col("counterparty_id").alias("taker"),
        F.col("token_side").alias("nonusdc_side"), F.col("side").alias("maker_direction"),
        opposite("side").alias("taker_direction"), F.col("price").cast("double").alias("price"),
        F.col("amount_usdc").cast("double").alias("usd_amount"),
        F.col("amount_shares").cast("double").alias("token_amount"),
        F.col("transaction_hash").alias("transactionHash"),
        F.concat(F.lit("v2:"), F.col("id").cast("string")).alias("orderfilled_id"), *more,
    )


def with_markets(valid: DataFrame, assets: DataFrame) -> DataFrame:
    """Valid fills with market and side, null where the asset is unknown.

    No broadcast is forced: the dimension grows with the number of markets, and
    the planner broadcasts it while its measured size allows.
    """
    return valid.join(assets.select("asset", "market_id", "token_side"), "asset", "left")


def normalize_fills_v2(fills: DataFrame, assets: DataFrame) -> DataFrame:
    """D03 — second-generation fills to trades: maker is the user, taker the counterparty."""
    return _as_trades(
        valid_maker_fills(fills).join(assets.select("asset", "market_id", "token_side"), "asset")
    )


def unresolved_assets(fills: DataFrame, assets: DataFrame) -> DataFrame:
    """D04 — assets of valid fills without a market: rows and first time seen.

    Counted per asset first, so the anti-join sees one row per asset.
    """
    return (
        valid_maker_fills(fills)
        .groupBy("asset")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("block_timestamp").alias("first_timestamp"))
        .join(assets.select("asset"), "asset", "left_anti")
    )


def is_exchange(*columns: str) -> Column:
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(c).cast("string")).isin(*EXCHANGE_ADDRESSES), F.lit(False))
    return hit


def exchange_address_rows(trades: DataFrame) -> DataFrame:
    """D05 — trades with an exchange contract as maker or taker."""
    return trades.where(is_exchange("maker", "taker")).select("orderfilled_id", "maker", "taker")


def exchange_address_guard(trades: DataFrame) -> DataFrame:
    """D05 — the trades, or an error naming up to five offending rows."""
    bad = exchange_address_rows(trades).limit(5).collect()
    if bad:
        raise TradeModelError(f"trades with an exchange contract as a party: {[r.asDict() for r in bad]}")
    return trades


def mark_taker_orders(fills: DataFrame, matches: DataFrame) -> DataFrame:
    """D14 — a fill is a taker fill if its (transaction, order) appears among the matches."""
    matched = matches.select("transaction_hash", "order_hash").distinct().withColumn("_hit", F.lit(True))
    return (
        fills.join(matched, ["transaction_hash", "order_hash"], "left")
        .withColumn("order_type", F.when(F.col("_hit"), "taker").otherwise("maker"))
        .drop("_hit")
    )


def partition_tail(df: DataFrame, ts: str = "block_timestamp", tie: str = "id") -> DataFrame:
    """D15 — one row with the greatest (timestamp, id)."""
    return df.agg(F.max(F.struct(F.col(ts), F.col(tie))).alias("t")).where("t IS NOT NULL").select("t.*")


def raw_profile(fills: DataFrame) -> DataFrame:
    """D17 — events, first and last block and distinct assets of a raw source."""
    return fills.agg(
        F.count(F.lit(1)).alias("events"), F.min("block_number").alias("first_block"),
        F.max("block_number").alias("last_block"), F.countDistinct("asset").alias("assets"),
    )


def event_provenance(fills: DataFrame, assets: DataFrame) -> DataFrame:
    """D17 — each raw event with the market and side its asset resolves to."""
    return fills.select("id", "timestamp", "asset", "price", "side").join(
        assets.select("asset", "market_id", "token_side"), "asset", "left"
    )


def sample_fixture(orders: DataFrame, markets: DataFrame, n_markets: int) -> tuple[DataFrame, DataFrame]:
    """D18 — n markets traded in ``orders`` and the orders touching their tokens.

    Semi-joins throughout; token sets never reach the driver.
    """
    traded = (
        orders.select(F.explode(F.array("makerAssetId", "takerAssetId")).alias("asset"))
        .where(F.col("asset") != CASH_ASSET)
        .distinct()
    )
    tokens = markets.select("id", F.explode(F.array("token1", "token2")).alias("asset"))
    picked = tokens.join(traded, "asset", "left_semi").select("id").distinct().orderBy("id").limit(n_markets)
    sample = markets.join(picked, "id", "left_semi")
    wanted = sample.select(F.explode(F.array("token1", "token2")).alias("asset")).distinct()
    # Two tokens per sampled market, so the planner broadcasts this list.
    maker = orders.join(wanted, orders.makerAssetId == wanted.asset, "left_semi")
    taker = orders.join(wanted, orders.makerAssetId == wanted.asset, "left_anti").join(
        wanted, orders.takerAssetId == wanted.asset, "left_semi"
    )
    return sample, maker.unionByName(taker)
