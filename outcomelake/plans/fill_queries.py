"""Queries of §D: raw fills to trades, market dimensions, outcomes, missing metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelake.operators import dims as M
from outcomelake.operators import fills as D
from outcomelake.plans.fixtures import fills_v1, fills_v2, market_versions, part_markets, raw_markets
from outcomelake.plans.registry import query
from outcomelake.session import materialize
from outcomelake.sources.readers import flatten_market_metadata

V1_SQL = """
  SELECT b.timestamp, market_id, maker, taker, token_side AS nonusdc_side, maker_direction, taker_direction,
         usd_amount / token_amount AS price, usd_amount, token_amount, "transactionHash", orderfilled_id
  FROM (SELECT timestamp, maker, taker, "transactionHash", id AS orderfilled_id,
               CASE WHEN "makerAssetId" = '0' THEN "takerAssetId" ELSE "makerAssetId" END AS asset,
               CASE WHEN "takerAssetId" = '0' THEN 'BUY' ELSE 'SELL' END AS taker_direction,
               CASE WHEN "takerAssetId" = '0' THEN 'SELL' ELSE 'BUY' END AS maker_direction,
               CAST(CASE WHEN "takerAssetId" = '0' THEN "takerAmountFilled" ELSE "makerAmountFilled" END AS DOUBLE)
                 / 1000000 AS usd_amount,
               CAST(CASE WHEN "takerAssetId" = '0' THEN "makerAmountFilled" ELSE "takerAmountFilled" END AS DOUBLE)
                 / 1000000 AS token_amount
        FROM fills_v1 WHERE "makerAssetId" = '0' OR "takerAssetId" = '0') b JOIN assets a USING (asset)
  WHERE usd_amount > 0 AND token_amount > 0 AND usd_amount / token_amount BETWEEN 0 AND 1"""
V2_SQL = """
  SELECT f.block_timestamp AS timestamp, market_id, user_id AS maker, counterparty_id AS taker,
         token_side AS nonusdc_side, side AS maker_direction,
         CASE WHEN side = 'BUY' THEN 'SELL' ELSE 'BUY' END AS taker_direction, price, amount_usdc AS usd_amount,
         amount_shares AS token_amount, transaction_hash AS "transactionHash", 'v2:' || id AS orderfilled_id
  FROM maker_fills f JOIN assets a USING (asset)"""


def _assets(spark, sf):
    return M.asset_dimension(part_markets(spark, sf))


@query("d01_normalize_fills_v1", V1_SQL, ("fills_v1", "assets"))
def _(spark, sf):
    # Read once, so not landed first: writing raw fills cost a third of all bytes moved.
    return D.normalize_fills_v1(fills_v1(spark, sf), _assets(spark, sf))


@query("d02_valid_maker_fills", "SELECT * FROM maker_fills", ("maker_fills",))
def _(spark, sf):
    return D.valid_maker_fills(fills_v2(spark, sf))


@query("d03_normalize_fills_v2", V2_SQL, ("maker_fills", "assets"))
def _(spark, sf):
    return D.normalize_fills_v2(fills_v2(spark, sf), _assets(spark, sf))


@query("d04_unresolved_assets", """
  SELECT asset, count(*) AS rows, min(block_timestamp) AS first_timestamp
  FROM maker_fills WHERE asset NOT IN (SELECT asset FROM assets) GROUP BY 1""", ("maker_fills", "assets"))
def _(spark, sf):
    return D.unresolved_assets(fills_v2(spark, sf), _assets(spark, sf))


@query("d05_exchange_address_rows", """
  SELECT orderfilled_id, maker, taker FROM (SELECT orderfilled_id, maker,
         CASE WHEN taker = 'S7' THEN '0xE2222d279d744050d28e00520010520000310F59' ELSE taker END AS taker
         FROM (SELECT id AS orderfilled_id, maker, taker FROM fills_v1)) WHERE taker LIKE '0x%'""", ("fills_v1",))
def _(spark, sf):
    # One supplier acts as the exchange contract, in mixed case.
    exchange = F.lit("0xE2222d279d744050d28e00520010520000310F59")
    rows = fills_v1(spark, sf).select(
        F.col("id").alias("orderfilled_id"), "maker",
        F.when(F.col("taker") == "S7", exchange).otherwise(F.col("taker")).alias("taker"),
    )
    return D.exchange_address_rows(rows)


@query("d06_asset_dimension", "SELECT * FROM assets", ("assets",))
def _(spark, sf):
    return _assets(spark, sf)


_LATEST = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY prio DESC, coalesce(observed_at, 0) DESC) AS rn
                 FROM market_versions) WHERE rn = 1"""


CURRENT_SQL = f"""
  SELECT id, token1, token2, question, coalesce(category, '') AS category,
         coalesce(CASE WHEN observed_at > 10000000000 THEN observed_at // 1000000000 ELSE observed_at END,
                  timestamp) AS timestamp FROM ({_LATEST})"""


@query("d07_markets_current", CURRENT_SQL, ("market_versions",))
def _(spark, sf):
    return M.markets_current(market_versions(spark, sf))


@query("d08_latest_version", f"""
  SELECT id, token1, token2, question, category, timestamp, coalesce(observed_at, 0) AS observed_at
  FROM ({_LATEST})""", ("market_versions",))
def _(spark, sf):
    return M.latest_version(market_versions(spark, sf)).withColumn(
        "observed_at", F.coalesce("observed_at", F.lit(0))
    )


# Metadata rows of the raw objects, without those that have fewer than two tokens.
RAW_SQL = """
  SELECT strftime(to_timestamp(1600000000 + p_partkey) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS "createdAt",
         'P' || p_partkey AS id, CASE WHEN p_size % 6 <> 0 THEN p_name ELSE 'title ' || p_partkey END AS question,
         'Yes' AS answer1, 'No' AS answer2, p_partkey % 8 = 0 OR p_partkey % 12 = 0 AS neg_risk,
         'slug-' || p_partkey AS market_slug, 'p' || p_partkey || 'a' AS token1, 'p' || p_partkey || 'b' AS token2,
         '0xc' || p_partkey AS condition_id, CAST(p_size AS VARCHAR) AS volume, p_brand AS ticker,
         CASE WHEN p_partkey % 10 = 0 THEN 'soon' ELSE
           strftime(to_timestamp(1650000000 + p_partkey) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS "closedTime",
         1600000000 + p_partkey AS timestamp, CASE WHEN p_size % 3 = 0 THEN p_type ELSE lower(p_type) END AS category,
         CASE p_partkey % 4 WHEN 0 THEN '["1","0"]' WHEN 1 THEN '["0","1.0"]' WHEN 2 THEN '["0.5","0.5"]'
              ELSE 'broken' END AS "outcomePrices",
         p_partkey % 5 <> 0 AS closed, '' AS "resolutionSource", '' AS "umaResolutionStatus"
  FROM part WHERE p_partkey % 37 <> 0 AND p_partkey % 43 <> 0"""
_OUTCOMES = f"""
  SELECT id AS market_id, CASE WHEN "outcomePrices" = '["1","0"]' THEN 'token1' ELSE 'token2' END AS winner_token,
         timestamp + 50000000 AS resolved_at, timestamp AS observed_at, '' AS resolution_source,
         '' AS resolution_status, timestamp + 50000000 AS timestamp
  FROM ({RAW_SQL}) WHERE closed AND "closedTime" <> 'soon' AND "outcomePrices" IN ('["1","0"]', '["0","1.0"]')"""


def _metadata(spark, sf):
    return flatten_market_metadata(raw_markets(spark, sf))


@query("d09_official_outcomes", _OUTCOMES)
def _(spark, sf):
    return M.official_outcomes(_metadata(spark, sf))


def _current_and_known(spark, sf):
    """Flattened metadata, parsed once and stored; outcomes of the markets in one category were stored before."""
    rows = materialize(_metadata(spark, sf), "metadata")
    return rows, M.official_outcomes(rows.where("category = 'economy'"))


@query("d10_refresh_outcomes", f"""
  SELECT * FROM ({_OUTCOMES}) WHERE market_id NOT IN (
    SELECT o.market_id FROM ({_OUTCOMES}) o JOIN ({RAW_SQL}) r ON r.id = o.market_id WHERE r.category = 'economy')""")
def _(spark, sf):
    return M.new_outcomes(*_current_and_known(spark, sf))


@query("d10_outcome_counts", f"""
  SELECT count(*) FILTER (id IN (SELECT market_id FROM ({_OUTCOMES}))) AS added,
         count(*) FILTER (id NOT IN (SELECT market_id FROM ({_OUTCOMES}))) AS skipped
  FROM ({RAW_SQL}) WHERE NOT (category = 'economy' AND id IN (SELECT market_id FROM ({_OUTCOMES})))""")
def _(spark, sf):
    return M.outcome_counts(*_current_and_known(spark, sf))


@query("d11_classify_changes", f"""
  SELECT id, question, ticker, target, CAST(1720000000000000000 AS BIGINT) AS observed_at FROM (
    SELECT *, CASE WHEN ticker = 'Brand#1' THEN 'markets' WHEN neg_risk THEN 'market_refreshes' END AS target
    FROM ({RAW_SQL})) WHERE target IS NOT NULL""")
def _(spark, sf):
    batch = _metadata(spark, sf)
    # Known before: all but one brand, and under another question where negative risk applies.
    current = batch.where("ticker <> 'Brand#1'").withColumn(
        "question", F.when(F.col("neg_risk"), F.lit("old")).otherwise(F.col("question"))
    )
    changes = M.classify_changes(batch, current, 1_720_000_000_000_000_000)
    return changes.select("id", "question", "ticker", "target", "observed_at")


_MISSING = """
  SELECT DISTINCT asset FROM (SELECT "makerAssetId" AS asset FROM fills_v1 UNION ALL
    SELECT "takerAssetId" FROM fills_v1 UNION ALL SELECT asset FROM fills_v2)
  WHERE asset NOT IN ('0', '') AND asset NOT IN (SELECT asset FROM assets)"""


@query("d12_missing_assets", _MISSING, ("fills_v1", "fills_v2", "assets"))
def _(spark, sf):
    v1, v2 = fills_v1(spark, sf), fills_v2(spark, sf)
    return M.missing_assets(
        [(v1, "makerAssetId"), (v1, "takerAssetId"), (v2, "asset")], [part_markets(spark, sf)]
    )


@query("d12_missing_assets_fresh", f"""
  SELECT asset FROM ({_MISSING}) WHERE asset NOT LIKE '%b' ORDER BY asset LIMIT 20""",
       ("fills_v1", "fills_v2", "assets"))
def _(spark, sf):
    v1, v2 = fills_v1(spark, sf), fills_v2(spark, sf)
    tried = v2.where("asset LIKE '%b'").select("asset").distinct()
    return M.missing_assets(
        [(v1, "makerAssetId"), (v1, "takerAssetId"), (v2, "asset")], [part_markets(spark, sf)],
        known_empty=tried, limit=20,
    )


@query("d13_dedupe", "SELECT * FROM latest_fills_v2", ("latest_fills_v2",))
def _(spark, sf):
    return D.dedupe(fills_v2(spark, sf), ["id"], ["ingest_seq"], keep="last")


@query("d14_mark_taker_orders", """
  SELECT id, order_hash, transaction_hash,
         CASE WHEN EXISTS (SELECT 1 FROM latest_fills_v2 m WHERE m.transaction_hash = f.transaction_hash
                             AND m.order_hash = f.order_hash AND m.side = 'SELL' AND m.log_index > 5)
              THEN 'taker' ELSE 'maker' END AS order_type FROM latest_fills_v2 f""", ("latest_fills_v2",))
def _(spark, sf):
    # Fills are read twice, so their latest versions are stored, with the columns that count.
    versions = fills_v2(spark, sf).select("id", "ingest_seq", "transaction_hash", "order_hash", "side", "log_index")
    fills = materialize(D.dedupe(versions, ["id"], ["ingest_seq"], keep="last").drop("ingest_seq"), "latest-fills")
    matches = fills.where("side = 'SELL' AND log_index > 5")
    return D.mark_taker_orders(fills, matches).select("id", "order_hash", "transaction_hash", "order_type")


@query("d15_partition_tail", """
  SELECT block_timestamp, id FROM fills_v2 ORDER BY block_timestamp DESC, id DESC LIMIT 1""", ("fills_v2",))
def _(spark, sf):
    return D.partition_tail(fills_v2(spark, sf))


@query("d17_raw_profile", """
  SELECT count(*) AS events, min(block_number) AS first_block, max(block_number) AS last_block,
         count(DISTINCT asset) AS assets FROM fills_v2""", ("fills_v2",))
def _(spark, sf):
    return D.raw_profile(fills_v2(spark, sf))


@query("d17_event_provenance", """
  SELECT f.id, f.timestamp, f.asset, f.price, f.side, a.market_id, a.token_side
  FROM fills_v2 f LEFT JOIN assets a ON a.asset = f.asset""", ("fills_v2", "assets"))
def _(spark, sf):
    return D.event_provenance(fills_v2(spark, sf), _assets(spark, sf))


@query("d18_sample_fixture", """
  SELECT o.* FROM fills_v1 o WHERE "makerAssetId" IN (SELECT asset FROM chosen)
     OR "takerAssetId" IN (SELECT asset FROM chosen)""".replace("chosen", """(
    SELECT asset FROM assets WHERE market_id IN (
      SELECT market_id FROM assets WHERE asset IN (SELECT "makerAssetId" FROM fills_v1 UNION ALL
                                                   SELECT "takerAssetId" FROM fills_v1)
      GROUP BY 1 ORDER BY 1 LIMIT 40))"""), ("fills_v1", "assets"))
def _(spark, sf):
    return D.sample_fixture(fills_v1(spark, sf), part_markets(spark, sf), 40)[1]
