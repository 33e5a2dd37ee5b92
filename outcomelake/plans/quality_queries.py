"""Queries of §Q: contracts, references, status and analyst questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomelake.operators import quality as Q
from outcomelake.operators.dims import asset_dimension
from outcomelake.operators.fills import normalize_fills_v2
from outcomelake.operators.positions import compute_player_stats
from outcomelake.plans.fill_queries import V2_SQL
from outcomelake.plans.fixtures import fills_v2, fills_v2_of, month_lines, part_markets, trades
from outcomelake.plans.positions_queries import rounded
from outcomelake.plans.registry import query
from outcomelake.session import materialize, scratch, shared_folder
from outcomelake.sources import storage
from outcomelake.sources.lake import Lake
from outcomelake.schemas import contract

# Rules of the raw fill contract that the fixture can break.
_RULES = {
    ("amount_usdc", "exclusive_min"): "amount_usdc <= 0",
    ("side", "allowed"): "side NOT IN ('BUY', 'SELL')",
    ("order_type", "allowed"): "order_type NOT IN ('maker', 'taker')",
}


def _union(rows) -> str:
    return " UNION ALL ".join(rows)


def _rule_rows() -> list[str]:
    out = []
    for rule in contract("order_filled_v2").columns:
        codes = (["null"] if not rule.nullable else []) + (["min"] if rule.minimum is not None else [])
        codes += ["exclusive_min"] if rule.exclusive_min is not None else []
        codes += (["max"] if rule.maximum is not None else []) + (["allowed"] if rule.allowed else [])
        if rule.name == "metadata":
            continue
        for code in codes:
            test = _RULES.get((rule.name, code), "FALSE")
            out.append(f"SELECT '{rule.name}' AS \"column\", '{code}' AS code, count(*) FILTER ({test}) AS count "
                       "FROM fills_v2")
    return out


@query("q02_value_counts", _union(_rule_rows()), ("fills_v2",))
def _(spark, sf):
    return Q.value_counts(fills_v2(spark, sf), contract("order_filled_v2"))


@query("q03_validate_store", f"""
  SELECT source, "check", CASE WHEN count > 0 THEN severity ELSE 'ok' END AS status, "column", code,
         CASE WHEN count > 0 THEN severity ELSE 'info' END AS severity, CAST(count AS BIGINT) AS count FROM (
    SELECT 'order_filled_v2' AS source, 'contract_values' AS "check", "column", code, 'error' AS severity, count
    FROM ({_union(_rule_rows())})
    UNION ALL SELECT 'order_filled_v2', 'unique_keys', 'id', 'duplicate', 'error',
      (SELECT sum(n) FROM (SELECT count(*) AS n FROM fills_v2 GROUP BY id) WHERE n > 1)
    UNION ALL SELECT 'order_filled_v2', 'references', 'asset', 'unknown', 'error',
      (SELECT count(DISTINCT asset) FROM fills_v2 WHERE asset NOT IN (SELECT asset FROM assets))
    UNION ALL SELECT 'order_filled_v2', 'contract_schema', '', '', 'error', 0
    UNION ALL SELECT 'market_outcomes', 'source_presence', '', 'no_files', 'warning', 1)""",
       ("fills_v2", "assets"))
def _(spark, sf):
    report = Q.validate_store(
        {"order_filled_v2": fills_v2(spark, sf), "market_outcomes": None}, spark, full=True,
        markets=part_markets(spark, sf),
    )
    gone = F.when(F.col("check") == "source_presence", 1).otherwise(0)
    return report.withColumns(
        {"column": F.coalesce("column", F.lit("")), "code": F.coalesce("code", F.lit("")),
         "count": F.coalesce("count", gone).cast("long")}
    )


@query("q03_report_status", """
  SELECT 'order_filled_v2' AS source, CASE WHEN count(*) FILTER (amount_usdc <= 0) > 0 THEN 'error' ELSE 'ok' END
    AS status FROM fills_v2 UNION ALL SELECT 'market_outcomes', 'warning'""", ("fills_v2",))
def _(spark, sf):
    frames = {"order_filled_v2": fills_v2(spark, sf), "market_outcomes": None}
    return Q.report_status(Q.validate_store(frames, spark))


_BAD_MONTH = "year(make_timestamp(timestamp * 1000000)) = 1998 AND month(make_timestamp(timestamp * 1000000)) = 5"


@query("q03_validate_lake", f"""
  SELECT * FROM (WITH good AS (SELECT * FROM fills_v2 WHERE NOT ({_BAD_MONTH})),
  files AS (SELECT year(make_timestamp(timestamp * 1000000)) AS y, month(make_timestamp(timestamp * 1000000)) AS m FROM fills_v2 GROUP BY 1, 2)
  SELECT 'order_filled_v2' AS source, "check", "column", code, count FROM (
    SELECT 'source_stats' AS "check", 'rows' AS "column", '' AS code, count(*) AS count FROM fills_v2 UNION ALL
    SELECT 'source_stats', 'files', '', count(*) FROM files UNION ALL
    SELECT 'source_stats', 'min_timestamp', '', min(timestamp) FROM fills_v2 UNION ALL
    SELECT 'source_stats', 'max_timestamp', '', max(timestamp) FROM fills_v2 UNION ALL
    SELECT 'file_read', '', 'unreadable', 1 UNION ALL SELECT 'file_read', '', 'row_count', 0 UNION ALL
    SELECT 'contract_values', 'amount_usdc', 'exclusive_min', count(*) FILTER (amount_usdc <= 0) FROM good UNION ALL
    SELECT 'contract_values', 'side', 'allowed', count(*) FILTER (side NOT IN ('BUY', 'SELL')) FROM good UNION ALL
    SELECT 'contract_values', 'order_type', 'allowed', count(*) FILTER (order_type NOT IN ('maker', 'taker')) FROM good UNION ALL
    SELECT 'unique_keys', 'id', 'duplicate', (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM good GROUP BY id) WHERE n > 1) UNION ALL
    SELECT 'references', 'asset', 'unknown', (SELECT count(DISTINCT asset) FROM good WHERE asset NOT IN (SELECT asset FROM assets))
  ) UNION ALL SELECT 'trades', 'source_presence', '', 'no_files', 1)""", ("fills_v2", "assets"))
def _(spark, sf):
    """A lake of which one file, that of May 1998, is damaged."""
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.write_partitioned("markets", part_markets(spark, sf).drop("p_size", "p_partkey"))
    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        bad = (F.col("year") == 1998) & (F.col("month") == 5)
        lake.write_partitioned("order_filled_v2", fills_v2_of(lines.where(~bad)), dealt=True)
        # The damaged month is one file, so that one file is unreadable: one of the calendar's months, as narrow rows, in one task.
        lake.write_partitioned("order_filled_v2", fills_v2_of(lines.where(bad).repartition(1)), dealt=True)
    for r in lake.read_outcomes("order_filled_v2").where("year = 1998 AND month = 5").collect():
        storage.write_text(spark, r.path, "damaged")
    report = Q.validate_lake(lake, ["order_filled_v2", "trades"], full=True)
    told = F.col("check").isin("source_stats", "file_read", "unique_keys", "references", "source_presence") | F.concat_ws(".", "column", "code").isin(
        "amount_usdc.exclusive_min", "side.allowed", "order_type.allowed")
    gone = F.when(F.col("check") == "source_presence", 1).otherwise(F.col("count"))
    return report.where(told).select(
        "source", "check", F.coalesce("column", F.lit("")).alias("column"), F.coalesce("code", F.lit("")).alias("code"), gone.cast("long").alias("count"))


@query("q04_duplicate_count", """
  SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS count FROM (SELECT count(*) AS n FROM fills_v2 GROUP BY id)
  WHERE n > 1""", ("fills_v2",))
def _(spark, sf):
    return Q.duplicate_count(fills_v2(spark, sf), ["id"])


_LOST = "SELECT DISTINCT asset AS value FROM fills_v2 WHERE asset NOT IN (SELECT asset FROM assets)"


@query("q05_unknown_references", _LOST, ("fills_v2", "assets"))
def _(spark, sf):
    known = asset_dimension(part_markets(spark, sf))
    return Q.unknown_references(fills_v2(spark, sf), "asset", known, "asset")


@query("q05_reference_summary", f"""
  SELECT count(*) AS unknown_count, array_to_string((SELECT list(value ORDER BY value) FROM (
    SELECT value FROM ({_LOST}) ORDER BY value LIMIT 5)), ',') AS samples FROM ({_LOST})""", ("fills_v2", "assets"))
def _(spark, sf):
    known = asset_dimension(part_markets(spark, sf))
    lost = Q.unknown_references(fills_v2(spark, sf), "asset", known, "asset")
    return Q.reference_summary(lost).withColumn("samples", F.concat_ws(",", "samples"))


@query("q06_ingest_status", f"""
  SELECT count(*) AS raw_rows, count(DISTINCT id) AS raw_unique_ids,
         count(*) - count(DISTINCT id) AS raw_duplicate_ids, max(block_timestamp) AS raw_max_timestamp,
         (SELECT count(*) FROM ({V2_SQL})) AS trades_rows, (SELECT max(timestamp) FROM ({V2_SQL}))
           AS trades_max_timestamp FROM fills_v2""", ("fills_v2", "maker_fills", "assets"))
def _(spark, sf):
    raw = fills_v2(spark, sf)
    return Q.ingest_status(raw, normalize_fills_v2(raw, asset_dimension(part_markets(spark, sf))))


@query("q07_market_volume", """
  SELECT market_id, nonusdc_side, count(*) AS n_trades, usd_(sum(micro_(usd_amount))) AS usd_volume
  FROM trades GROUP BY 1, 2""", ("trades",))
def _(spark, sf):
    return Q.market_volume(trades(spark, sf))


def _stats(spark, sf):
    return materialize(compute_player_stats(trades(spark, sf)), "stats")


_SHOWN = {"total_won": "total_won_usd", "n_won": "n_won", "win_rate": "win_rate", "score": "score_c"}
_HALF = "(SELECT * FROM stats WHERE n_bets >= (SELECT median(n_bets) FROM stats))"


def _value(column: str) -> str:
    return f"round({column}, 6) AS {column}" if column in ("win_rate", "score_c") else column


def _top(source: str, column: str) -> str:
    return (f"SELECT player, {_value(column)} FROM (SELECT * FROM {source} "
            f"ORDER BY {column} DESC NULLS LAST, player LIMIT 20)")


def _register(name: str, column: str, half: bool) -> None:
    key = f"q08_top_half_{name}" if half else f"q08_top_{name}"

    @query(key, _top(_HALF if half else "stats", column), ("stats",))
    def _(spark, sf):
        found = Q.analyst_queries(_stats(spark, sf))[f"top_half_{name}" if half else name]
        out = found.select("player", column)
        return rounded(out, column) if column in ("win_rate", "score_c") else out


for _name, _column in _SHOWN.items():
    _register(_name, _column, half=False)
    _register(_name, _column, half=True)


@query("q08_bet_distribution", """
  SELECT n_bets, count(*) AS players, round((SELECT avg(n_bets) FROM stats), 6) AS mean_n_bets
  FROM stats GROUP BY 1""", ("stats",))
def _(spark, sf):
    return rounded(Q.bet_distribution(_stats(spark, sf)), "mean_n_bets")


@query("q09_fingerprint", """
  SELECT count(*) AS rows, CAST(sum(('0x' || substr(md5(concat_ws('|', maker, maker_direction, market_id, nonusdc_side,
           orderfilled_id, printf('%.9f', price), taker, taker_direction, CAST(timestamp AS VARCHAR), printf('%.9f', token_amount),
           "transactionHash", printf('%.9f', usd_amount))), 1, 15))::BIGINT::HUGEINT) AS VARCHAR) AS content_hash
  FROM trades""", ("trades",))
def _(spark, sf):
    return Q.fingerprint(trades(spark, sf))
