"""The given tables read as prediction-market data: Spark views and the same views as SQL.

``events`` plays the fills, ``lineitem`` joined to ``orders`` plays the raw fill
logs of both generations, and ``part`` plays the market metadata.  Each builder
here has a CTE of the same name in ``CTES``, so a query and its check share one
definition of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelake.session import use_utc


# The columns used, so that a read needs no footer for its schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type IN ('error', 'signup') AS sells",
        "unix_seconds(CAST(ts AS timestamp)) AS timestamp",
        "CAST(get_json_object(props, '$.k') AS int) AS k",
        "CAST(floor(least(value, 60.0D) * 100 / 60) AS int) AS ticks", "1 + event_id % 5 AS tok",
    )
    return ev.where("ticks > 0").selectExpr(
        "timestamp", "concat('M', k) AS market_id",
        "concat('U', (user_id + event_id % 13) % 20) AS maker", "concat('U', user_id % 20) AS taker",
        "if(event_id % 2 = 0, 'token1', 'token2') AS nonusdc_side",
        "if(sells, 'BUY', 'SELL') AS maker_direction", "if(sells, 'SELL', 'BUY') AS taker_direction",
        "ticks / 100.0D AS price", "ticks * tok / 100.0D AS usd_amount",
        "CAST(tok AS double) AS token_amount", "concat('x', event_id div 3) AS transactionHash",
        "event_id AS orderfilled_id",
    )


def _market_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(get_json_object(props, '$.k') AS int) AS k"
    ).distinct().selectExpr("k", "1704844800 + (k % 15) * 86400 AS resolved")


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = "date_format(timestamp_seconds(resolved), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    return _market_numbers(spark, sf_dir).selectExpr(
        "concat('M', k) AS id", "concat('t', k, 'a') AS token1", "concat('t', k, 'b') AS token2",
        "if(k % 2 = 1, 'Politics', 'Sports') AS category", "concat('tick', k) AS ticker",
        "concat('Question ', k) AS question", f"if(k % 5 <> 0, {iso}, '') AS closedTime",
    )


def market_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _market_numbers(spark, sf_dir).where("k % 5 <> 0").selectExpr(
        "concat('M', k) AS market_id", "if(k % 2 = 0, 'token1', 'token2') AS winner_token",
        "CAST(resolved AS bigint) AS resolved_at",
    )


_FILL_ID = (
    "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS int), "
    "CAST(rint(l_extendedprice * 100) AS bigint), day)"
)
_ASSET = "concat('p', l_partkey, if(l_linenumber % 2 = 1, 'a', 'b'))"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    line = table(spark, sf_dir, "lineitem")
    return line.join(orders, line.l_orderkey == orders.o_orderkey).selectExpr(
        "*", "unix_seconds(CAST(l_shipdate AS timestamp)) AS ship", "rint(l_discount * 100) / 10.0D AS px"
    ).selectExpr("*", "ship div 86400 AS day", "ship + l_orderkey % 86400 AS at")


def month_lines(spark: SparkSession, sf_dir: str, keep) -> DataFrame:
    """What fills derive from, dealt by month of the fill and stored with ``keep`` of ``scratch``.

    Narrow rows are shuffled, once for the join and once by month; fills of either generation are derived from
    a scan of them, task by task, and written without another shuffle.
    """
    line = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "CAST(rint(l_extendedprice * 100) AS bigint) AS cents",
        "rint(l_discount * 100) AS disc", "l_tax", "l_returnflag = 'R' AS returned", "l_linestatus = 'O' AS is_open",
        "unix_seconds(CAST(l_shipdate AS timestamp)) AS ship",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    at = F.timestamp_seconds(F.expr("ship + l_orderkey % 86400"))
    lines = line.join(orders, line.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    dealt = lines.withColumns({"year": F.year(at), "month": F.month(at)}).hint("rebalance", "year", "month")
    # In the order of keys, neighbours share most of their ids, which then take few bytes wherever they are written or shuffled.
    dealt = dealt.sortWithinPartitions("year", "month", "l_orderkey")
    return keep(dealt, "month-lines", "year", "month")


def _derived(lines: DataFrame) -> DataFrame:
    """The columns of ``_lines`` that fills derive from, of rows in order of month."""
    return lines.sortWithinPartitions("year", "month", "l_orderkey").selectExpr(
        "*", "if(is_open, 'O', 'F') AS l_linestatus", "disc / 10.0D AS px", "ship div 86400 AS day", "ship + l_orderkey % 86400 AS at")


_CENTS = "CAST(rint(l_extendedprice * 100) AS bigint)"
_SEQ = "explode(if({}, array(0, 1), array(0))) AS ingest_seq"


def fills_v2(spark: SparkSession, sf_dir: str, seq: int | None = None) -> DataFrame:
    """Raw second-generation fills, all or those of one ``ingest_seq``; returned lines were fetched again later, corrected to taker fills."""
    lines = _lines(spark, sf_dir)
    if seq is None:
        return _fills_v2(lines.selectExpr("*", _SEQ.format("l_returnflag = 'R'")))
    return _fills_v2((lines.where("l_returnflag = 'R'") if seq else lines).withColumn("ingest_seq", F.lit(seq)))


def fills_v2_of(lines: DataFrame, seq: int | None = None) -> DataFrame:
    """``fills_v2`` of ``month_lines``, all or those of one ``ingest_seq``, with ``year`` and ``month``."""
    if seq is None:
        placed = lines.selectExpr("*", _SEQ.format("returned"))
    else:
        placed = (lines.where("returned") if seq else lines).withColumn("ingest_seq", F.lit(seq))
    return _fills_v2(_derived(placed), "cents", ["year", "month"])


def _fills_v2(lines: DataFrame, cents: str = _CENTS, more: list[str] = []) -> DataFrame:
    return lines.selectExpr(
        f"{_FILL_ID.replace(_CENTS, cents)} AS id", "'0xabc' AS exchange", "CAST(l_linenumber AS bigint) AS log_index",
        "at AS timestamp", "day * 1000 + l_orderkey % 1000 AS block_number", "at AS block_timestamp",
        "concat('tx', l_orderkey) AS transaction_hash", "concat('C', o_custkey) AS user_id",
        f"{_ASSET} AS asset", "px * l_quantity AS amount_usdc", "l_quantity AS amount_shares",
        "px AS price", "if(l_linestatus = 'O', 'buy', 'SELL') AS side",
        "concat('o', l_orderkey) AS order_hash", "concat('S', l_suppkey) AS counterparty_id",
        "CASE WHEN ingest_seq = 1 THEN 'taker' WHEN l_linenumber <= 5 THEN 'maker' ELSE 'TAKER' END "
        "AS order_type",
        "l_tax AS fee", "concat('b', l_suppkey % 10) AS builder", "ingest_seq", *more,
    )


def fills_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw first-generation fills: amounts as text in 1e-6 units, asset "0" is the cash side."""
    return _fills_v1(_lines(spark, sf_dir))


def fills_v1_of(lines: DataFrame) -> DataFrame:
    """``fills_v1`` of ``month_lines``, with ``year`` and ``month``."""
    return _fills_v1(_derived(lines), "cents", ["year", "month"])


def _fills_v1(lines: DataFrame, cents: str = _CENTS, more: list[str] = []) -> DataFrame:
    usd = "CAST(CAST(rint(px * l_quantity * 1000000) AS bigint) AS string)"
    tokens = "CAST(CAST(rint(l_quantity * 1000000) AS bigint) AS string)"
    return lines.selectExpr(
        f"{_FILL_ID.replace(_CENTS, cents)} AS id", "at AS timestamp", "concat('C', o_custkey) AS maker",
        f"if(l_linestatus = 'O' AND l_linenumber <> 7, '0', {_ASSET}) AS makerAssetId",
        f"if(l_linestatus = 'O', {usd}, {tokens}) AS makerAmountFilled",
        "concat('S', l_suppkey) AS taker",
        f"if(l_linestatus = 'O' OR l_linenumber = 7, {_ASSET}, '0') AS takerAssetId",
        f"if(l_linestatus = 'O', {tokens}, {usd}) AS takerAmountFilled",
        "concat('tx', l_orderkey) AS transactionHash", *more,
    )


def part_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market metadata from ``part``; the largest parts have no metadata."""
    return table(spark, sf_dir, "part").where("p_size < 50").selectExpr(
        "concat('P', p_partkey) AS id", "concat('p', p_partkey, 'a') AS token1",
        "if(p_partkey % 41 = 0, '', concat('p', p_partkey, 'b')) AS token2", "p_name AS question",
        "if(p_size % 4 = 0, CAST(NULL AS string), p_type) AS category",
        "1577836800 + p_partkey * 60 AS timestamp", "p_partkey", "p_size",
    )


_MARKET_COLUMNS = ("id", "token1", "token2", "question", "category", "timestamp")


def market_versions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Canonical, discovered and refreshed rows; only some of them carry ``observed_at``."""
    base = part_markets(spark, sf_dir)
    return {
        "markets": base.selectExpr(
            *_MARKET_COLUMNS,
            "if(p_size BETWEEN 10 AND 20, CAST(NULL AS bigint), "
            "(1700000000 + p_partkey % 1000) * 1000000000) AS observed_at",
        ),
        "missing_markets": base.where("p_size <= 7").selectExpr(
            "id", "token1", "token2", "concat('found ', question) AS question", "timestamp"
        ),
        "market_refreshes": base.where("p_size % 5 = 0")
        .selectExpr("*", "explode(array(1, 2)) AS version")
        .selectExpr(
            "id", "token1", "token2", "concat('new ', question, ' v', version) AS question", "category",
            "timestamp", "CAST(1710000000 + version AS bigint) AS observed_at",
        ),
    }


def raw_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metadata objects as JSON lines (column ``value``)."""
    fields = {
        "id": "concat('P', p_partkey)",
        "question": "if(p_size % 6 <> 0, p_name, NULL)",
        "title": "concat('title ', p_partkey)",
        "outcomes": "'[\"Yes\", \"No\"]'",
        "clobTokenIds": "CASE WHEN p_partkey % 37 = 0 THEN concat('[\"p', p_partkey, 'a\"]') "
                        "WHEN p_partkey % 43 = 0 THEN 'not json' "
                        "ELSE concat('[\"p', p_partkey, 'a\", \"p', p_partkey, 'b\"]') END",
        "negRiskAugmented": "p_partkey % 8 = 0",
        "negRiskOther": "p_partkey % 12 = 0",
        "category": "if(p_size % 3 = 0, p_type, NULL)",
        "events": "array(named_struct('ticker', p_brand, 'category', lower(p_type)))",
        "createdAt": "date_format(timestamp_seconds(1600000000 + p_partkey), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
        "closedTime": "if(p_partkey % 10 = 0, 'soon', "
                      "date_format(timestamp_seconds(1650000000 + p_partkey), 'yyyy-MM-dd HH:mm:ss'))",
        "closed": "p_partkey % 5 <> 0",
        "outcomePrices": "CASE p_partkey % 4 WHEN 0 THEN '[\"1\",\"0\"]' WHEN 1 THEN '[\"0\",\"1.0\"]' "
                         "WHEN 2 THEN '[\"0.5\",\"0.5\"]' ELSE 'broken' END",
        "slug": "concat('slug-', p_partkey)",
        "conditionId": "concat('0xc', p_partkey)",
        "volume": "CAST(p_size AS string)",
    }
    inner = ", ".join(f"'{name}', {expr}" for name, expr in fields.items())
    # The table is a few row groups: without a shuffle of its short rows as few tasks would do all that follows.
    return table(spark, sf_dir, "part").repartition("p_partkey").selectExpr(f"to_json(named_struct({inner})) AS value")


def raw_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hex-encoded fill logs, match logs and block times built from ``lineitem``."""
    fills = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "CAST(l_linenumber AS bigint) AS log",
        "CAST(l_quantity AS bigint) * 1000000 AS shares",
        "CAST(l_quantity AS bigint) * CAST(rint(l_discount * 100) AS bigint) * 100000 AS usd",
        "CAST(rint(l_discount * 100) AS bigint) AS disc",
        "CAST(rint(l_extendedprice * 100) AS bigint) AS cents",
        "unix_seconds(CAST(l_shipdate AS timestamp)) div 86400 AS day",
    ).selectExpr(
        "*", "log % 2 AS sells", "concat_ws('-', '0xTX', l_orderkey, l_partkey, cents, day) AS tx"
    )

    def word(expr: str) -> str:
        return f"lpad(lower(hex({expr})), 64, '0')"

    # Token ids beyond 64 bits: 2^96 plus the part key.
    token = "lpad(concat('1', lpad(lower(hex(l_partkey)), 24, '0')), 64, '0')"
    order = f"concat('0xA', {word('l_orderkey')})"
    data = ", ".join([
        word("sells"), token, word("if(sells = 0, usd, shares)"), word("if(sells = 0, shares, usd)"),
        word("disc"), word("l_suppkey"), word("day"),
    ])
    logs = fills.selectExpr(
        "'0xEXCHANGE' AS address", "concat('0x', hex(day)) AS blockNumber", "tx AS transactionHash",
        "concat('0x', hex(l_suppkey)) AS transactionIndex", "concat('0x', hex(log)) AS logIndex",
        f"array('0xfill', {order}, concat('0x', {word('l_suppkey')}), concat('0x', {word('l_partkey')})) AS topics",
        f"concat('0x', {data}) AS data",
    )
    matches = fills.where("l_linestatus = 'F'").selectExpr(
        "upper(tx) AS transactionHash", f"array('0xmatch', {order}, '0x00') AS topics"
    )
    blocks = fills.selectExpr("day AS block_number", "day * 86400 AS block_timestamp").distinct()
    return logs, matches, blocks


_LINE = """
  SELECT l.*, o.o_custkey,
         epoch_us(l_shipdate) // 1000000 AS ship_s,
         epoch_us(l_shipdate) // 86400000000 AS ship_day,
         round_even(l_discount * 100, 0) / CAST(10 AS DOUBLE) AS px,
         concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER),
                   CAST(round_even(l_extendedprice * 100, 0) AS BIGINT), epoch_us(l_shipdate) // 86400000000) AS fill_id,
         'p' || l_partkey || CASE WHEN l_linenumber % 2 = 1 THEN 'a' ELSE 'b' END AS token
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
"""

# Each CTE names the ones it needs; ``with_ctes`` assembles them in order.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trades": ((), """
  SELECT timestamp, 'M' || k AS market_id,
         'U' || ((user_id + event_id % 13) % 20) AS maker, 'U' || (user_id % 20) AS taker,
         CASE WHEN event_id % 2 = 0 THEN 'token1' ELSE 'token2' END AS nonusdc_side,
         CASE WHEN event_type IN ('error', 'signup') THEN 'BUY' ELSE 'SELL' END AS maker_direction,
         CASE WHEN event_type IN ('error', 'signup') THEN 'SELL' ELSE 'BUY' END AS taker_direction,
         ticks / CAST(100 AS DOUBLE) AS price, (ticks * tok) / CAST(100 AS DOUBLE) AS usd_amount,
         CAST(tok AS DOUBLE) AS token_amount, 'x' || (event_id // 3) AS "transactionHash",
         event_id AS orderfilled_id
  FROM (SELECT event_id, epoch_us(ts) // 1000000 AS timestamp,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(floor(least(value, 60.0) * 100 / 60) AS INTEGER) AS ticks,
               1 + event_id % 5 AS tok, user_id, event_type FROM events) WHERE ticks > 0"""),
    "ks": ((), "SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "markets": (("ks",), """
  SELECT 'M' || k AS id, 't' || k || 'a' AS token1, 't' || k || 'b' AS token2,
         CASE WHEN k % 2 = 1 THEN 'Politics' ELSE 'Sports' END AS category,
         'tick' || k AS ticker, 'Question ' || k AS question,
         CASE WHEN k % 5 <> 0 THEN 1704844800 + (k % 15) * 86400 END AS closed_ts FROM ks"""),
    "market_outcomes": (("ks",), """
  SELECT 'M' || k AS market_id, CASE WHEN k % 2 = 0 THEN 'token1' ELSE 'token2' END AS winner_token,
         CAST(1704844800 + (k % 15) * 86400 AS BIGINT) AS resolved_at FROM ks WHERE k % 5 <> 0"""),
    "line": ((), _LINE),
    "fills_v2": (("line",), """
  SELECT fill_id AS id, '0xabc' AS exchange, CAST(l_linenumber AS BIGINT) AS log_index,
         ship_s + l_orderkey % 86400 AS timestamp, ship_day * 1000 + l_orderkey % 1000 AS block_number,
         ship_s + l_orderkey % 86400 AS block_timestamp, 'tx' || l_orderkey AS transaction_hash,
         'C' || o_custkey AS user_id, token AS asset, px * l_quantity AS amount_usdc,
         l_quantity AS amount_shares, px AS price,
         CASE WHEN l_linestatus = 'O' THEN 'buy' ELSE 'SELL' END AS side, 'o' || l_orderkey AS order_hash,
         'S' || l_suppkey AS counterparty_id,
         CASE WHEN seq = 1 THEN 'taker' WHEN l_linenumber <= 5 THEN 'maker' ELSE 'TAKER' END AS order_type,
         l_tax AS fee, 'b' || (l_suppkey % 10) AS builder, seq AS ingest_seq
  FROM line JOIN (VALUES (0), (1)) AS s(seq) ON seq = 0 OR l_returnflag = 'R'"""),
    "fills_v1": (("line",), """
  SELECT fill_id AS id, ship_s + l_orderkey % 86400 AS timestamp, 'C' || o_custkey AS maker,
         CASE WHEN l_linestatus = 'O' AND l_linenumber <> 7 THEN '0' ELSE token END AS "makerAssetId",
         CASE WHEN l_linestatus = 'O' THEN usd ELSE tokens END AS "makerAmountFilled",
         'S' || l_suppkey AS taker,
         CASE WHEN l_linestatus = 'O' OR l_linenumber = 7 THEN token ELSE '0' END AS "takerAssetId",
         CASE WHEN l_linestatus = 'O' THEN tokens ELSE usd END AS "takerAmountFilled",
         'tx' || l_orderkey AS "transactionHash"
  FROM (SELECT *, CAST(CAST(round_even(px * l_quantity * 1000000, 0) AS BIGINT) AS VARCHAR) AS usd,
               CAST(CAST(round_even(l_quantity * 1000000, 0) AS BIGINT) AS VARCHAR) AS tokens FROM line)"""),
    "part_markets": ((), """
  SELECT 'P' || p_partkey AS id, 'p' || p_partkey || 'a' AS token1,
         CASE WHEN p_partkey % 41 = 0 THEN '' ELSE 'p' || p_partkey || 'b' END AS token2,
         p_name AS question, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS category,
         1577836800 + p_partkey * 60 AS timestamp, p_partkey, p_size
  FROM part WHERE p_size < 50"""),
    "assets": (("part_markets",), """
  SELECT id AS market_id, 'token1' AS token_side, token1 AS asset, timestamp FROM part_markets
  UNION ALL SELECT id, 'token2', token2, timestamp FROM part_markets WHERE token2 <> ''"""),
    "market_versions": (("part_markets",), """
  SELECT id, token1, token2, question, category, timestamp, 0 AS prio,
         CASE WHEN p_size BETWEEN 10 AND 20 THEN NULL ELSE (1700000000 + p_partkey % 1000) * 1000000000 END AS observed_at
  FROM part_markets
  UNION ALL SELECT id, token1, token2, 'found ' || question, NULL, timestamp, 1, NULL
  FROM part_markets WHERE p_size <= 7
  UNION ALL SELECT id, token1, token2, 'new ' || question || ' v' || v, category, timestamp, 2, 1710000000 + v
  FROM part_markets JOIN (VALUES (1), (2)) AS t(v) ON p_size % 5 = 0"""),
    "latest_fills_v2": (("fills_v2",), """
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_seq DESC) AS rn
                 FROM fills_v2) WHERE rn = 1"""),
    "maker_fills": (("latest_fills_v2",), """
  SELECT * REPLACE (upper(side) AS side, lower(order_type) AS order_type) FROM latest_fills_v2
  WHERE upper(side) IN ('BUY', 'SELL') AND lower(order_type) = 'maker' AND price BETWEEN 0 AND 1
    AND amount_usdc > 0 AND amount_shares > 0"""),
    "positions": (("trades",), """
  SELECT timestamp, market_id, player, nonusdc_side AS token_side,
         CASE WHEN direction = 'BUY' THEN token_amount ELSE -token_amount END AS signed_tokens,
         CASE WHEN direction = 'BUY' THEN -usd_amount ELSE usd_amount END AS signed_usd, direction, price,
         orderfilled_id, role
  FROM (SELECT *, maker AS player, maker_direction AS direction, 'maker' AS role FROM trades
        UNION ALL SELECT *, taker, taker_direction, 'taker' FROM trades)"""),
    "last_prices": (("trades",), """
  SELECT market_id, nonusdc_side AS token_side, arg_max(price, (timestamp, orderfilled_id)) AS last_price
  FROM trades GROUP BY ALL"""),
    "resolutions": (("last_prices",), """
  SELECT market_id, token1, token2, CASE WHEN token1 >= 0.98 THEN 'token1' WHEN token2 >= 0.98 THEN 'token2'
         ELSE 'open' END AS winner_token
  FROM (SELECT market_id, max(CASE WHEN token_side = 'token1' THEN last_price END) AS token1,
               max(CASE WHEN token_side = 'token2' THEN last_price END) AS token2
        FROM last_prices GROUP BY 1)"""),
    "position_totals": (("positions",), """
  SELECT player, market_id, token_side, usd_(sum(micro_(signed_tokens))) AS net_tokens,
         usd_(sum(micro_(signed_usd))) AS net_usd, count(*) FILTER (direction = 'BUY') AS n_buys,
         count(*) FILTER (direction = 'SELL') AS n_sells, min(timestamp) AS first_ts, max(timestamp) AS last_ts
  FROM positions GROUP BY 1, 2, 3"""),
    "labelled": (("position_totals", "resolutions", "last_prices"), """
  SELECT *, CASE outcome WHEN 'won' THEN net_usd + net_tokens WHEN 'lost' THEN net_usd
                 WHEN 'open' THEN net_usd + net_tokens * last_price ELSE net_usd END AS pnl_usd
  FROM (SELECT p.*, l.last_price, r.winner_token,
               CASE WHEN net_tokens = 0 THEN 'flat' WHEN winner_token = 'open' THEN 'open'
                    WHEN p.token_side = winner_token AND net_tokens > 0 THEN 'won'
                    WHEN p.token_side <> winner_token AND net_tokens > 0 THEN 'lost' ELSE 'flat' END AS outcome
        FROM position_totals p LEFT JOIN resolutions r USING (market_id)
        LEFT JOIN last_prices l ON l.market_id = p.market_id AND l.token_side = p.token_side)"""),
    "official_labelled": (("position_totals", "market_outcomes"), """
  SELECT p.*, CASE WHEN winner_token IS NULL THEN 'open' WHEN net_tokens = 0 THEN 'flat'
         WHEN (net_tokens > 0) = (token_side = winner_token) THEN 'won' ELSE 'lost' END AS outcome,
         net_usd + net_tokens * CASE WHEN token_side = winner_token THEN 1.0::DOUBLE
                                     WHEN winner_token IS NULL THEN NULL ELSE 0.0::DOUBLE END AS pnl_usd
  FROM position_totals p LEFT JOIN market_outcomes USING (market_id)"""),
}

STATS_SQL = """
  SELECT *, n_won + n_lost AS n_bets, n_won / CAST(n_won + n_lost AS DOUBLE) AS win_rate,
         n_won / CAST(n_won + n_lost AS DOUBLE) * ln(greatest(total_won_usd, 1.0)) AS score_c
  FROM (SELECT player, count(*) FILTER (outcome = 'won') AS n_won, count(*) FILTER (outcome = 'lost') AS n_lost,
               usd_(coalesce(sum(micro_(pnl_usd)) FILTER (outcome = 'won'), 0)) AS total_won_usd,
               abs(usd_(coalesce(sum(micro_(pnl_usd)) FILTER (outcome = 'lost'), 0))) AS total_lost_usd,
               usd_(sum(micro_(pnl_usd))) AS net_usd_pnl
        FROM {source} WHERE outcome IN ('won', 'lost') GROUP BY player)"""
CTES["stats"] = (("labelled",), STATS_SQL.format(source="labelled"))
CTES["official_stats"] = (("official_labelled",), STATS_SQL.format(source="official_labelled"))
CTES["punter"] = (("trades",), """
  SELECT * FROM trades WHERE maker <> taker AND usd_amount >= 1.0 AND price >= 0.02 AND price <= 0.98""")
CTES["timeline"] = (("punter",), """
  SELECT *, CASE WHEN prev_position = 0 THEN 'entry'
       WHEN sign(prev_position) = sign(cum_position) AND abs(cum_position) > abs(prev_position) THEN 'add'
       WHEN sign(prev_position) <> sign(cum_position) AND cum_position <> 0 THEN 'flip'
       WHEN cum_position = 0 THEN 'exit' ELSE 'reduce' END AS event_kind
  FROM (SELECT *, cum_position - signed_tokens AS prev_position
        FROM (SELECT *, sum(signed_tokens) OVER (PARTITION BY taker, market_id, nonusdc_side
                                                 ORDER BY timestamp, orderfilled_id) AS cum_position
              FROM (SELECT *, CASE WHEN taker_direction = 'BUY' THEN token_amount ELSE -token_amount END
                       AS signed_tokens FROM punter)))""")
CTES["entries"] = (("timeline",), "SELECT * FROM timeline WHERE event_kind = 'entry'")
CTES["cutoff"] = (("entries",), """
  SELECT timestamp AS cutoff FROM (SELECT timestamp, row_number() OVER (ORDER BY timestamp, orderfilled_id) - 1 AS r,
         count(*) OVER () AS n FROM entries) WHERE r = CAST(floor(0.7 * (n - 1) + 0.5) AS BIGINT)""")
CTES["leaders"] = (("entries", "cutoff"), """
  SELECT taker, count(*) AS n_entries FROM entries WHERE timestamp < (SELECT cutoff FROM cutoff)
  GROUP BY taker ORDER BY n_entries DESC, taker LIMIT 5""")
CTES["bars"] = (("trades",), """
  SELECT market_id, nonusdc_side, timestamp // 86400 * 86400 AS timestamp,
         arg_max(price, (timestamp, orderfilled_id)) AS close, usd_(sum(micro_(usd_amount))) AS usd_volume,
         count(*) AS n_trades
  FROM trades GROUP BY 1, 2, 3""")
CTES["signals"] = (("bars",), """
  SELECT * EXCLUDE (c3, m3), CAST(c3 > m3 AS INTEGER) AS signal
  FROM (SELECT market_id, nonusdc_side, timestamp, close, usd_volume, n_trades, 3 * micro_(close) AS c3, m3,
               CASE WHEN n3 = 3 THEN m3 / 1000000 / 3 END AS moving_average
        FROM (SELECT *, sum(micro_(close)) OVER w AS m3, count(*) OVER w AS n3 FROM bars
              WINDOW w AS (PARTITION BY market_id, nonusdc_side ORDER BY timestamp
                           ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)))
  WHERE moving_average IS NOT NULL""")


def _needs(name: str, done: list[str]) -> None:
    for dep in CTES[name][0]:
        if dep not in done:
            _needs(dep, done)
    if name not in done:
        done.append(name)


def with_ctes(sql: str, *names: str) -> str:
    """``sql`` preceded by the named views and what they depend on."""
    done: list[str] = []
    for name in names:
        _needs(name, done)
    body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in done)
    text = f"WITH {body}\n{sql}" if done else sql
    return expand_macros(text)


def expand_macros(text: str) -> str:
    """``micro_(x)`` is an exact 1e-6 integer and ``usd_(x)`` turns a sum of them into DOUBLE."""
    for name, head, tail in (
        ("micro_(", "CAST(round_even((", ") * 1000000, 0) AS BIGINT)"),
        ("usd_(", "(CAST(CAST(", " AS BIGINT) AS DOUBLE) / 1000000)"),
    ):
        while (start := text.find(name)) >= 0:
            depth, i = 1, start + len(name)
            while depth:
                depth += {"(": 1, ")": -1}.get(text[i], 0)
                i += 1
            inner = text[start + len(name): i - 1]
            text = f"{text[:start]}{head}{inner}{tail}{text[i:]}"
    return text
