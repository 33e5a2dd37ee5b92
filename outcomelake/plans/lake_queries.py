"""Queries of §L: the lake written from the given tables and read back, landing formats, streaming twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelake.functions import sum_micros
from outcomelake.operators.dims import asset_dimension
from outcomelake.operators.fills import UnresolvedAssetsError
from outcomelake.plans.fill_queries import CURRENT_SQL, RAW_SQL, V1_SQL, V2_SQL
from outcomelake.plans.fixtures import (
    fills_v1_of,
    fills_v2,
    fills_v2_of,
    market_versions,
    month_lines,
    part_markets,
    raw_logs,
    raw_markets,
    table,
    trades,
)
from outcomelake.plans.registry import query
from outcomelake.session import freed_shuffles, materialize, scratch, shared_folder
from outcomelake.sources import readers as R
from outcomelake.sources.lake import Lake
from outcomelake.streaming.incremental import current_bars, fills_to_trades, read_fill_stream, trades_to_bars

_MONTH = """CAST(year(make_timestamp(timestamp * 1000000)) AS INTEGER) AS year,
  CAST(month(make_timestamp(timestamp * 1000000)) AS INTEGER) AS month"""


def _lake(spark) -> Lake:
    return Lake(spark, shared_folder(spark, "lake"))


def _monthly(df: DataFrame, amount: str) -> DataFrame:
    return df.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), sum_micros(amount).alias("amount"),
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
    )


def _monthly_sql(view: str, amount: str, where: str = "") -> str:
    return f"""SELECT {_MONTH}, count(*) AS rows, usd_(sum(micro_({amount}))) AS amount,
      min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM {view} {where} GROUP BY 1, 2"""


def _fill_lake(spark, sf, runs: int = 1) -> Lake:
    """Raw fills landed in one append, or by ingest order in two."""
    lake = _lake(spark)
    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        for seq in [None] if runs == 1 else [0, 1]:
            lake.write_partitioned("order_filled_v2", fills_v2_of(lines, seq), dealt=True)
    return lake


@query("l01_write_partitioned", _monthly_sql("fills_v2", "amount_usdc"), ("fills_v2",))
def _(spark, sf):
    return _monthly(_fill_lake(spark, sf).scan("order_filled_v2"), "amount_usdc")


@query("l02_publish_snapshot", "SELECT * FROM assets", ("assets",))
def _(spark, sf):
    lake = _lake(spark)
    assets = asset_dimension(part_markets(spark, sf))
    lake.publish_snapshot("market_assets", assets.where("token_side = 'token1'"))
    lake.publish_snapshot("market_assets", assets)
    return lake.scan("market_assets").drop("year", "month")


_CURRENT_ASSETS = " UNION ALL ".join(
    f"SELECT {t} AS asset, id AS market_id, '{t}' AS token_side, timestamp FROM ({CURRENT_SQL}) WHERE {t} <> ''" for t in ("token1", "token2"))


@query("l02_refresh_dimensions", _CURRENT_ASSETS, ("market_versions",))
def _(spark, sf):
    """Canonical, discovered and refreshed markets in a lake, and the asset dimension published from them."""
    lake = _lake(spark)
    # Columns of the contract that the fixture does not fill.
    text = {c: F.lit("-") for c in ("createdAt", "answer1", "answer2", "market_slug", "condition_id", "volume", "ticker", "closedTime",
                                    "outcomePrices", "resolutionSource", "umaResolutionStatus")}
    for source, rows in market_versions(spark, sf).items():
        lake.write_partitioned(source, rows.withColumns({**text, "neg_risk": F.lit(False), "closed": F.lit(False)}))
    lake.refresh_dimensions()
    return lake.scan("market_assets").drop("year", "month")


@query("l03_write_partition", _monthly_sql(
    "fills_v2", "amount_usdc", f"WHERE year(make_timestamp(timestamp * 1000000)) = 1998"), ("fills_v2",))
def _(spark, sf):
    lake = _lake(spark)
    lake.write_months("order_filled_v2", [(1998, month) for month in range(1, 13)], fills_v2(spark, sf))
    return _monthly(lake.scan("order_filled_v2"), "amount_usdc")


@query("l04_scan_pruned", """
  SELECT id, timestamp, asset, amount_usdc, exchange, CAST(log_index AS BIGINT) AS log_index FROM fills_v2
  WHERE year(make_timestamp(timestamp * 1000000)) = 1998 AND month(make_timestamp(timestamp * 1000000)) = 5""",
       ("fills_v2",))
def _(spark, sf):
    return _fill_lake(spark, sf).scan("order_filled_v2", 1998, 5).select(
        "id", "timestamp", "asset", "amount_usdc", "exchange", "log_index"
    )


def _drifting_lake(spark, sf) -> Lake:
    """Amounts as integers in older files and as text, with one more column, in newer ones."""
    lake = _lake(spark)
    amounts = ("makerAmountFilled", "takerAmountFilled")
    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        fills = fills_v1_of(lines)
        old = fills.where("makerAssetId = '0'")
        lake.write_partitioned("orderFilled", old.withColumns({c: F.col(c).cast("long") for c in amounts}), dealt=True)
        lake.write_partitioned("orderFilled", fills.where("makerAssetId <> '0'").withColumn("venue", F.lit("x")), dealt=True)
    return lake


@query("l05_scan_evolving", """
  SELECT id, timestamp, maker, "makerAssetId", "makerAmountFilled", taker, "takerAssetId", "takerAmountFilled",
         "transactionHash", CASE WHEN "makerAssetId" = '0' THEN NULL ELSE 'x' END AS venue FROM fills_v1""",
       ("fills_v1",))
def _(spark, sf):
    return _drifting_lake(spark, sf).scan_evolving("orderFilled").drop("year", "month")


@query("l06_load_csv", """
  SELECT 'P' || p_partkey AS id, p_name AS question, CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_partkey END AS timestamp
  FROM part""")
def _(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "concat('P', p_partkey) AS id", "p_name AS question",
        "if(p_size % 7 = 0, 'n/a', CAST(p_partkey AS string)) AS createdAt",
    )
    path = shared_folder(spark, "csv")
    rows.write.option("header", "true").csv(f"{path}/a")
    rows.withColumn("question", F.lit("later copy")).write.option("header", "true").csv(f"{path}/b")
    return R.load_csv(spark, f"{path}/*").select("id", "question", "timestamp")


@query("l07_legacy_row_ids", """
  SELECT 'legacy:' || (row_number() OVER (ORDER BY orderfilled_id) - 1) AS id, timestamp, maker, taker,
         CAST(round_even(usd_amount * 1000000, 0) AS BIGINT) AS "takerAmountFilled" FROM trades""", ("trades",))
def _(spark, sf):
    path = shared_folder(spark, "legacy")
    trades(spark, sf).repartitionByRange(6, "orderfilled_id").sortWithinPartitions("orderfilled_id").selectExpr(
        "timestamp", "maker", "'0' AS makerAssetId", "CAST(rint(token_amount * 1000000) AS bigint) AS makerAmountFilled",
        "taker", "market_id AS takerAssetId", "CAST(rint(usd_amount * 1000000) AS bigint) AS takerAmountFilled",
        "transactionHash",
    ).write.option("header", "true").csv(path)
    return R.load_fills_csv_with_row_ids(spark, path).select(
        "id", "timestamp", "maker", "taker", "takerAmountFilled"
    )


@query("l08_import_fill_jsonl", """
  SELECT id, timestamp, block_number, asset, amount_usdc, amount_shares, price, upper(side) AS side,
         lower(order_type) AS order_type, fee, builder, exchange, log_index FROM latest_fills_v2""",
       ("latest_fills_v2",))
def _(spark, sf):
    path = shared_folder(spark, "jsonl")
    first, again = fills_v2(spark, sf, 0), fills_v2(spark, sf, 1)
    fields = F.struct(*[c for c in first.columns if c not in ("timestamp", "ingest_seq")])
    # First run bare and enveloped; the second run wraps each order's fills in an array.
    wrapped = F.to_json(F.struct(F.lit(1).alias("page"), F.array(fields).alias("events")))
    bare = first.select(F.when(F.col("order_type") == "maker", F.to_json(fields)).otherwise(wrapped).alias("value"))
    arrays = again.groupBy("transaction_hash").agg(F.to_json(F.collect_list(fields)).alias("value"))
    with freed_shuffles(spark):
        bare.write.option("compression", "gzip").text(f"{path}/run1")
        arrays.select("value").write.option("compression", "gzip").text(f"{path}/run2")
    out = R.import_fill_jsonl(spark, f"{path}/*")
    return out.select(
        "id", "timestamp", "block_number", "asset", "amount_usdc", "amount_shares", "price", "side",
        "order_type", "fee", "builder", "exchange", "log_index",
    )


@query("l09_decode_order_events", """
  SELECT lower(tx) || ':' || log AS id, '0xexchange' AS exchange, log AS log_index, day AS block_number,
         day * 86400 AS block_timestamp, '0x' || lpad(lower(to_hex(l_suppkey)), 40, '0') AS user_id,
         CAST(79228162514264337593543950336::HUGEINT + l_partkey AS VARCHAR) AS asset,
         CASE WHEN log % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, usd / 1000000::DOUBLE AS amount_usdc,
         shares / 1000000::DOUBLE AS amount_shares,
         (usd / 1000000::DOUBLE) / (shares / 1000000::DOUBLE) AS price,
         '0xa' || lpad(lower(to_hex(l_orderkey)), 64, '0') AS order_hash, disc / 1000000::DOUBLE AS fee,
         CASE WHEN l_linestatus = 'F' THEN 'taker' ELSE 'maker' END AS order_type,
         '0x' || lpad(lower(to_hex(l_suppkey)), 64, '0') AS builder
  FROM (SELECT *, CAST(l_linenumber AS BIGINT) AS log, epoch_us(l_shipdate) // 86400000000 AS day,
               CAST(round_even(l_discount * 100, 0) AS BIGINT) AS disc,
               CAST(l_quantity AS BIGINT) * 1000000 AS shares,
               CAST(l_quantity AS BIGINT) * CAST(round_even(l_discount * 100, 0) AS BIGINT) * 100000 AS usd,
               concat_ws('-', '0xTX', l_orderkey, l_partkey, CAST(round_even(l_extendedprice * 100, 0) AS BIGINT),
                         epoch_us(l_shipdate) // 86400000000) AS tx
        FROM lineitem)""")
def _(spark, sf):
    logs, matches, blocks = raw_logs(spark, sf)
    # Logs are decoded from where they landed, not made anew for each use.
    return R.decode_order_events(materialize(logs, "raw-logs"), matches, blocks).select(
        "id", "exchange", "log_index", "block_number", "block_timestamp", "user_id", "asset", "side",
        "amount_usdc", "amount_shares", "price", "order_hash", "fee", "order_type", "builder",
    )


@query("l10_flatten_market_metadata", RAW_SQL)
def _(spark, sf):
    return R.flatten_market_metadata(raw_markets(spark, sf))


def _metadata_lake(spark, sf, fills: str) -> Lake:
    """A lake with the fill generation that is read, the first in two kinds of files, market metadata and the asset dimension."""
    lake = _drifting_lake(spark, sf) if fills == "orderFilled" else _fill_lake(spark, sf)
    lake.write_partitioned("markets", part_markets(spark, sf).drop("p_size", "p_partkey"))
    lake.publish_snapshot("market_assets", asset_dimension(part_markets(spark, sf)))
    return lake


@query("l11_scan_readers", """
  SELECT 'orderFilled' AS source, count(*) AS rows FROM fills_v1 UNION ALL
  SELECT 'markets', count(*) FROM part_markets UNION ALL SELECT 'trades', 0""", ("fills_v1", "part_markets"))
def _(spark, sf):
    lake = _metadata_lake(spark, sf, "orderFilled")
    frames = {"orderFilled": lake.scan_order_filled(), "markets": lake.scan_markets(), "trades": lake.scan_trades()}
    counts = [df.agg(F.lit(s).alias("source"), F.count(F.lit(1)).alias("rows")) for s, df in frames.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_ADHOC = """
  SELECT m.token_side, f.side, count(*) AS n, min(f.timestamp) AS first_ts
  FROM {fills} f JOIN {assets} m ON f.asset = m.asset GROUP BY m.token_side, f.side"""


@query("l12_adhoc_sql", _ADHOC.format(fills="fills_v2", assets="assets"),
       ("fills_v2", "assets"))
def _(spark, sf):
    lake = _metadata_lake(spark, sf, "order_filled_v2")
    lake.register_views(["order_filled_v2", "market_assets"])
    return spark.sql(_ADHOC.format(fills="order_filled_v2", assets="market_assets"))


_COMPACTED = """
  SELECT timestamp, id, lower(order_type) AS order_type FROM latest_fills_v2"""


def _compactable(spark, sf) -> Lake:
    """Two appends of trade rows, the second repeating the returned lines."""
    lake = _lake(spark)
    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        for seq in (0, 1):
            rows = fills_v2_of(lines, seq).selectExpr("*", "block_timestamp * 10 + ingest_seq AS version")
            lake.write_partitioned("fills", rows, dealt=True)
    return lake


@query("l13_compact", """
  SELECT id, order_type, ingest_seq FROM latest_fills_v2
  WHERE year(make_timestamp(timestamp * 1000000)) = 1998 AND month(make_timestamp(timestamp * 1000000)) = 5""",
       ("latest_fills_v2",))
def _(spark, sf):
    lake = _compactable(spark, sf)
    lake.compact("fills", 1998, 5, keys=["id"], order=["version"])
    return lake.scan("fills", 1998, 5).select("id", "order_type", "ingest_seq")


@query("l13_compact_drifted", """
  SELECT id, timestamp, maker, "makerAssetId", "makerAmountFilled", taker, "takerAssetId", "takerAmountFilled",
         "transactionHash", CASE WHEN "makerAssetId" = '0' THEN NULL ELSE 'x' END AS venue FROM fills_v1
  WHERE year(make_timestamp(timestamp * 1000000)) = 1998 AND month(make_timestamp(timestamp * 1000000)) = 5""",
       ("fills_v1",))
def _(spark, sf):
    lake = _drifting_lake(spark, sf)
    lake.compact("orderFilled", 1998, 5)
    return lake.scan("orderFilled", 1998, 5).drop("year", "month")


@query("l14_compact_all", f"SELECT {_MONTH}, count(*) AS rows FROM latest_fills_v2 GROUP BY 1, 2",
       ("latest_fills_v2",))
def _(spark, sf):
    return _compactable(spark, sf).compact_all("fills", keys=["id"], order=["version"])


@query("l15_due_partitions", f"""
  SELECT {_MONTH}, count(*) AS rows FROM fills_v2 GROUP BY 1, 2 HAVING count(DISTINCT ingest_seq) > 1""",
       ("fills_v2",))
def _(spark, sf):
    lake = _compactable(spark, sf)
    return lake.due_partitions("fills", max_run_files=1).select("year", "month", "rows")


_FILL_COLUMNS = """amount_shares double, amount_usdc double, asset string, block_number bigint, block_timestamp bigint,
  builder string, counterparty_id string, exchange string, fee double, id string, ingest_seq int, log_index bigint,
  order_hash string, order_type string, price double, side string, timestamp bigint, transaction_hash string,
  user_id string, version bigint"""


@query("l15_compact_due", f"""
  SELECT year, month, count(*) AS rows FROM (SELECT {_MONTH} FROM latest_fills_v2)
  WHERE (year, month) IN (SELECT (year, month) FROM (SELECT {_MONTH}, ingest_seq FROM fills_v2)
                          GROUP BY year, month HAVING count(DISTINCT ingest_seq) > 1)
  GROUP BY 1, 2""", ("fills_v2", "latest_fills_v2"))
def _(spark, sf):
    return _compactable(spark, sf).compact_due("fills", keys=["id"], max_run_files=1)


@query("l16_partition_inventory", f"""
  SELECT {_MONTH}, count(*) AS rows, count(DISTINCT ingest_seq) AS files, min(timestamp) AS min_timestamp,
         max(timestamp) AS max_timestamp, FALSE AS compacted,
         sha256(regexp_replace('{_FILL_COLUMNS}', ', *\n? *', chr(10), 'g')) AS schema_sha256
  FROM fills_v2 GROUP BY 1, 2""", ("fills_v2",))
def _(spark, sf):
    return _compactable(spark, sf).partition_inventory("fills").select(
        "year", "month", "rows", "files", "min_timestamp", "max_timestamp", "compacted", "schema_sha256"
    )


@query("l17_source_inventory", """
  SELECT 'order_filled_v2' AS source, count(*) AS rows, max(timestamp) AS latest_timestamp
  FROM fills_v2 UNION ALL
  SELECT 'market_assets', count(*), max(timestamp) FROM assets UNION ALL SELECT 'trades', 0, -1""",
       ("fills_v2", "assets"))
def _(spark, sf):
    inventory = _metadata_lake(spark, sf, "order_filled_v2").source_inventory(["order_filled_v2", "market_assets", "trades"])
    return inventory.select("source", "rows", F.coalesce("latest_timestamp", F.lit(-1)).alias("latest_timestamp"))


@query("l18_high_water_marks", """
  SELECT max(timestamp) AS max_timestamp, max(block_number) + 1 AS next_block FROM fills_v2""", ("fills_v2",))
def _(spark, sf):
    lake = _fill_lake(spark, sf)
    marks = (lake.max_timestamp("order_filled_v2"), lake.next_block())
    return spark.createDataFrame([marks], "max_timestamp long, next_block long")


@query("l19_process_incremental_v2", V2_SQL, ("maker_fills", "assets"))
def _(spark, sf):
    """Both deliveries, whole, each landing history after newer fills; metadata that comes in two parts.

    The first run stops at unknown assets and leaves no trade; the next holds their fills back.  The second
    delivery corrects maker fills to taker fills, stored trades among them.
    """
    lake = _lake(spark)
    assets = materialize(asset_dimension(part_markets(spark, sf)), "assets")
    lake.publish_snapshot("market_assets", assets.where("token_side = 'token1'"))
    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        first, again = fills_v2_of(lines, 0), fills_v2_of(lines, 1)
        # 883612800 is 1998-01-01: what is older lands last and is late.
        lake.write_partitioned("order_filled_v2", first.where("timestamp >= 883612800"), dealt=True)
        try:
            lake.process_v2()
            raise AssertionError("unknown assets did not stop the run")
        except UnresolvedAssetsError:
            assert lake.cursor("trades_v2") is None and lake.scan("trades").isEmpty()
        lake.process_v2(hold_unknown=True)
        lake.write_partitioned("order_filled_v2", first.where("timestamp < 883612800"), dealt=True)
        lake.process_v2(hold_unknown=True)
        lake.publish_snapshot("market_assets", assets)
        lake.release_held()
        lake.write_partitioned("order_filled_v2", again, dealt=True)
    lake.process_v2(hold_unknown=True)
    assert lake.process_v2(hold_unknown=True) == 0
    return lake.scan("trades").drop("year", "month")


@query("l19_held_fills", """
  SELECT asset, count(*) AS rows, min(block_timestamp) AS first_timestamp FROM maker_fills
  WHERE asset NOT IN (SELECT asset FROM assets) GROUP BY 1""", ("maker_fills", "assets"))
def _(spark, sf):
    lake = _lake(spark)
    lake.publish_snapshot("market_assets", asset_dimension(part_markets(spark, sf)))
    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        for seq in (0, 1):
            lake.write_partitioned("order_filled_v2", fills_v2_of(lines, seq), dealt=True)
            lake.process_v2(hold_unknown=True)
    return lake.held_assets()


@query("l19_process_incremental_v1", V1_SQL, ("fills_v1", "assets"))
def _(spark, sf):
    lake = _metadata_lake(spark, sf, "orderFilled")
    lake.process_v1()
    assert lake.process_v1() == 0
    return lake.scan("trades").drop("year", "month")


@query("l19_stream_twin", V2_SQL, ("maker_fills", "assets"))
def _(spark, sf):
    """Both deliveries in three landings and two runs of the stream: late fills, repeated ones, corrections."""
    lake = _lake(spark)
    assets = materialize(asset_dimension(part_markets(spark, sf)), "assets")
    state = shared_folder(spark, "checkpoint")

    def run(**options) -> None:
        stream = read_fill_stream(spark, lake.path("order_filled_v2"), files_per_batch=40)
        fills_to_trades(stream, assets, lake, state, hold_unknown=True, **options).awaitTermination()

    with scratch(spark) as keep:
        lines = month_lines(spark, sf, keep)
        first, again = fills_v2_of(lines, 0), fills_v2_of(lines, 1)
        lake.write_partitioned("order_filled_v2", first.where("log_index % 3 <> 0"), dealt=True)
        lake.write_partitioned("order_filled_v2", first.where("log_index % 3 <> 1"), dealt=True)  # a third comes again, a third late
        run()
        lake.write_partitioned("order_filled_v2", again, dealt=True)
    run()
    lake.vacuum("trades", 0)  # nobody reads the corrected months any more
    return lake.scan("trades").drop("year", "month")


@query("l20_export_snapshot", _monthly_sql("fills_v2", "amount_usdc"), ("fills_v2",))
def _(spark, sf):
    lake = _metadata_lake(spark, sf, "order_filled_v2")
    target = shared_folder(spark, "export")
    lake.export_snapshot(["order_filled_v2", "market_assets"], "2026-01-01", target)
    return _monthly(spark.read.parquet(f"{target}/2026-01-01/order_filled_v2"), "amount_usdc")


@query("w11_stream_bars", """
  SELECT market_id, nonusdc_side, timestamp // 3600 * 3600 AS timestamp,
         arg_max(price, (timestamp, orderfilled_id)) AS close, usd_(sum(micro_(usd_amount))) AS usd_volume,
         count(*) AS n_trades FROM trades GROUP BY 1, 2, 3""", ("trades",))
def _(spark, sf):
    """Trades in four files; of every tenth the row comes late, by one file and also by two, and so twice."""
    stored = materialize(trades(spark, sf), "trades")
    lo, hi = stored.agg(F.min("timestamp"), F.max("timestamp")).first()
    part = F.least(F.floor((F.col("timestamp") - lo) * 4 / F.lit(hi - lo + 1)), F.lit(3))
    files = F.when(F.col("orderfilled_id") % 10 == 0, F.array(F.least(part + 1, F.lit(3)), F.least(part + 2, F.lit(3)))).otherwise(F.array(part))
    dealt = stored.withColumn("_file", F.explode(F.array_distinct(files)))
    source, folder, state = (shared_folder(spark, name) for name in ("stream", "bars", "checkpoint"))
    for k in range(4):
        dealt.where(F.col("_file") == k).drop("_file").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(source)
        trades_to_bars(stream, 3600, folder, state)
    return current_bars(spark, stored.schema, 3600, folder)
