"""D06–D12 — market dimensions, versions, official outcomes and missing metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelake.functions import epoch_from_iso, observed_seconds
from outcomelake.operators.fills import CASH_ASSET, dedupe

MARKET_SOURCES = ("markets", "missing_markets", "market_refreshes")

# The columns a market row is compared and stored on.
MARKET_COLUMNS = (
    "createdAt", "id", "question", "answer1", "answer2", "neg_risk", "market_slug", "token1", "token2",
    "condition_id", "volume", "ticker", "closedTime", "timestamp", "category", "outcomePrices", "closed",
    "resolutionSource", "umaResolutionStatus",
)


def asset_dimension(markets: DataFrame) -> DataFrame:
    """D06 — one row per outcome asset: asset, market_id, token_side, timestamp."""
    keep = [c for c in ("id", "timestamp") if c in markets.columns]
    return (
        markets.unpivot(keep, ["token1", "token2"], "token_side", "asset")
        .withColumnRenamed("id", "market_id")
        .withColumn("asset", F.col("asset").cast("string"))
        .where(F.col("asset") != "")
    )


def latest_version(sources: dict[str, DataFrame]) -> DataFrame:
    """D08 — one row per market id over canonical, discovered and refreshed rows.

    The highest source wins, then the latest observation (null counts as 0),
    then the rows' own content, so the result does not depend on file order.
    """
    parts = []
    for priority, name in enumerate(MARKET_SOURCES):
        df = sources.get(name)
        if df is None:
            continue
        types = {"neg_risk": "boolean", "timestamp": "long", "observed_at": "long"}
        text = [c for c in df.columns if c not in (*types, "closed", "year", "month")]
        df = df.withColumns({c: F.col(c).cast("string") for c in text})
        df = df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})
        parts.append(df.withColumn("_priority", F.lit(priority)))
    if not parts:
        raise ValueError(f"none of {MARKET_SOURCES} given")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    seen = F.coalesce("observed_at", F.lit(0)) if "observed_at" in merged.columns else F.lit(0)
    content = F.xxhash64(*sorted(c for c in merged.columns if c != "_priority"))
    return dedupe(merged, ["id"], ["_priority", seen, content], keep="last").drop("_priority")


def markets_current(sources: dict[str, DataFrame]) -> DataFrame:
    """D07 — the latest version of each market, stamped with when it was observed."""
    latest = latest_version(sources)
    missing = {"id", "token1", "token2", "timestamp"} - set(latest.columns)
    if missing:
        raise ValueError(f"market rows lack columns: {sorted(missing)}")
    stamp = F.col("timestamp").cast("long")
    if "observed_at" in latest.columns:
        stamp = F.coalesce(observed_seconds("observed_at"), stamp)
    category = F.coalesce("category", F.lit("")) if "category" in latest.columns else F.lit("")
    return latest.withColumns({"timestamp": stamp, "category": category}).drop("observed_at")


def official_outcomes(markets: DataFrame) -> DataFrame:
    """D09 — the winner of each closed market whose prices are exactly one 1 and one 0.

    Prices are a JSON list of numbers as text; anything else gives no row.
    """
    raw = F.from_json("outcomePrices", "array<string>")
    prices = F.transform(raw, lambda p: p.try_cast("decimal(38,18)"))
    ones = F.size(F.filter(prices, lambda p: p == 1))
    zeros = F.size(F.filter(prices, lambda p: p == 0))
    winner = F.when(F.element_at(prices, 1) == 1, "token1").otherwise("token2")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in markets.columns else F.lit("")

    observed = F.col("timestamp") if "timestamp" in markets.columns else F.col("resolved_at")
    return (
        markets.where(F.col("closed") & (F.size(prices) == 2) & (ones == 1) & (zeros == 1))
        .withColumn("resolved_at", epoch_from_iso("closedTime"))
        .where(F.col("resolved_at") > 0)
        .select(
            F.col("id").alias("market_id"), winner.alias("winner_token"), "resolved_at",
            observed.cast("long").alias("observed_at"),
            text("resolutionSource").alias("resolution_source"),
            text("umaResolutionStatus").alias("resolution_status"),
            F.col("resolved_at").alias("timestamp"),
        )
    )


def new_outcomes(current: DataFrame, known: DataFrame) -> DataFrame:
    """D10 — official outcomes of markets that have none yet."""
    fresh = current.join(known.select(F.col("market_id").alias("id")), "id", "left_anti")
    return official_outcomes(fresh)


def outcome_counts(current: DataFrame, known: DataFrame) -> DataFrame:
    """D10 — how many markets would be added and how many are not final yet."""
    fresh = current.join(known.select(F.col("market_id").alias("id")), "id", "left_anti")
    added = official_outcomes(fresh).select(F.col("market_id").alias("id"), F.lit(1).alias("_added"))
    return fresh.select("id").join(added, "id", "left").agg(
        F.count("_added").alias("added"), F.count_if(F.col("_added").isNull()).alias("skipped")
    )


def classify_changes(batch: DataFrame, current: DataFrame, observed_at: Column | int) -> DataFrame:
    """D11 — new rows for ``markets``, changed rows for ``market_refreshes``; unchanged rows drop.

    ``target`` names where each row belongs.
    """
    cols = [c for c in MARKET_COLUMNS if c in batch.columns and c in current.columns]
    known = current.select("id", F.struct(*cols).alias("_known"))
    stamp = F.lit(observed_at) if isinstance(observed_at, int) else observed_at
    return (
        batch.join(known, "id", "left")
        .withColumn(
            "target",
            F.when(F.col("_known").isNull(), "markets").when(
                ~F.struct(*cols).eqNullSafe(F.col("_known")), "market_refreshes"
            ),
        )
        .where(F.col("target").isNotNull())
        .drop("_known")
        .withColumn("observed_at", stamp.cast("long"))
    )


def missing_assets(
    references: list[tuple[DataFrame, str]],
    markets: list[DataFrame],
    known_empty: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """D12 — assets referenced by fills but unknown to the metadata, sorted.

    ``references`` are (frame, asset column).  Every source is reduced to its
    distinct assets map-side before anything is shuffled: known and wanted ones meet in one
    aggregate, since the planner moves an anti-join below the distinct, to every fill.  A frame with
    several columns is read once.  ``known_empty`` lists
    assets looked up in vain before; ``limit`` is how many to look up at once.
    """
    frames: dict[int, tuple[DataFrame, list[str]]] = {}
    for df, c in references:
        frames.setdefault(id(df), (df, []))[1].append(c)

    def assets(df: DataFrame, columns: list[str], known: bool) -> DataFrame:
        texts = [F.col(c).cast("string") for c in columns]
        return df.select((texts[0] if len(texts) == 1 else F.explode(F.array(*texts))).alias("asset"), F.lit(known).alias("known"))

    parts = [assets(df, columns, False) for df, columns in frames.values()]
    parts += [assets(m, ["token1", "token2"], True) for m in markets]
    if known_empty is not None:
        parts.append(assets(known_empty, ["asset"], True))
    found = reduce(DataFrame.unionByName, parts).where(F.col("asset").isNotNull() & ~F.col("asset").isin(CASH_ASSET, ""))
    ordered = found.groupBy("asset").agg(F.bool_or("known").alias("known")).where("NOT known").select("asset").orderBy("asset")
    return ordered if limit is None else ordered.limit(limit)
