"""The lake end to end on real Parquet: sinks, scans, gates, incremental runs, compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from outcomelake.operators.dims import asset_dimension
from outcomelake.operators.fills import TradeModelError, UnresolvedAssetsError
from outcomelake.operators.quality import DataContractError
from outcomelake.sources.lake import Lake
from outcomelake.streaming.incremental import fills_to_trades, read_fill_stream

JAN, FEB, MAR = 1704067200, 1706745600, 1709251200
EXCHANGE = "0xE111180000d2663c0091e4f400237545b87b996b"

V2 = (
    "id string, log_index long, timestamp long, block_number long, block_timestamp long, transaction_hash string, "
    "user_id string, asset string, amount_usdc double, amount_shares double, price double, side string, "
    "order_hash string, counterparty_id string, order_type string, fee double, builder string"
)
MARKETS = "id string, token1 string, token2 string, question string, timestamp long, observed_at long"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def v2(spark):
    def make(*rows):
        out = []
        for id_, ts, *rest in rows:
            asset, kind, side, taker = [*rest, *["t1", "maker", "BUY", "0xT"][len(rest):]]
            out.append((id_, 1, ts, 5, ts, "0xh" + id_, "0xM", asset, 5.0, 10.0, 0.5, side, "0xo", taker, kind, 0.0, "0xb"))
        return spark.createDataFrame(out, V2)

    return make


@pytest.fixture
def markets(spark):
    return spark.createDataFrame([("m1", "t1", "t2", "q", JAN, None)], MARKETS)


def test_write_and_scan_months(lake, v2):
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB), ("c", FEB)))
    assert lake.scan("order_filled_v2").count() == 3
    feb = lake.scan("order_filled_v2", 2024, 2)
    assert feb.count() == 2
    assert "PartitionFilters: [isnotnull(year" in feb._jdf.queryExecution().toString()
    assert lake.scan("order_filled_v2").where("exchange IS NULL").count() == 3
    assert lake.scan("market_outcomes").count() == 0 and "winner_token" in lake.scan("market_outcomes").columns
    with pytest.raises(ValueError, match="timestamp"):
        lake.write_partitioned("x", v2(("a", JAN)).drop("timestamp"))
    with pytest.raises(ValueError, match="empty"):
        lake.write_partitioned("x", v2(("a", JAN)).limit(0))


def test_write_partition_replaces_only_its_month(lake, v2):
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB)))
    lake.write_partition("order_filled_v2", 2024, 2, v2(("x", FEB), ("y", FEB), ("no", JAN)), replace=True)
    assert {r.id for r in lake.scan("order_filled_v2").collect()} == {"a", "x", "y"}


def test_failed_snapshot_keeps_the_old_one(spark, lake, markets):
    assets = asset_dimension(markets)
    assert lake.publish_snapshot("market_assets", assets) == 2
    with pytest.raises(ValueError, match="empty"):
        lake.publish_snapshot("market_assets", assets.limit(0))
    with pytest.raises(DataContractError):
        lake.publish_snapshot("market_assets", assets.withColumn("token_side", F.lit("token9")))
    assert {r.token_side for r in lake.scan("market_assets").collect()} == {"token1", "token2"}


def test_type_drift_and_new_columns(spark, lake):
    base = "id string, timestamp long, maker string, makerAssetId string, taker string, takerAssetId string, transactionHash string"
    old = spark.createDataFrame([("a", JAN, "m", "0", "t", "t1", "h")], base)
    lake.write_partitioned("orderFilled", old.withColumns(
        {"makerAmountFilled": F.lit(5).cast("long"), "takerAmountFilled": F.lit(10).cast("long")}))
    lake.write_partitioned("orderFilled", old.withColumns(
        {"id": F.lit("b"), "makerAmountFilled": F.lit("7"), "takerAmountFilled": F.lit("8"), "venue": F.lit("x")}))
    got = {r.id: (r.makerAmountFilled, r.venue) for r in lake.scan_evolving("orderFilled").collect()}
    assert got == {"a": ("5", None), "b": ("7", "x")}


def test_incremental_v2_resumes_and_equals_one_run(spark, lake, v2, markets, tmp_path):
    rows = v2(("a", JAN), ("b", JAN), ("c", FEB), ("d", FEB, "t2", "taker"), ("e", MAR, "t2", "maker", "SELL"))
    lake.publish_snapshot("market_assets", asset_dimension(markets))
    steps = []
    for part in ("id = 'a'", "id IN ('b', 'c')", "id IN ('d', 'e')"):
        lake.write_partitioned("order_filled_v2", rows.where(part))
        steps.append(lake.process("v2"))
    assert steps == [1, 2, 1] and lake.process("v2") == 0
    whole = Lake(spark, str(tmp_path / "whole"))
    whole.publish_snapshot("market_assets", asset_dimension(markets))
    whole.write_partitioned("order_filled_v2", rows)
    whole.process("v2")
    columns = lake.scan("trades").columns
    assert sorted(lake.scan("trades").collect()) == sorted(whole.scan("trades").select(columns).collect())
    e = whole.scan("trades").where("orderfilled_id = 'v2:e'").first()
    assert (e.maker, e.maker_direction, e.taker_direction, e.nonusdc_side) == ("0xM", "SELL", "BUY", "token2")
    with pytest.raises(ValueError):
        lake.process("v3")


def test_unknown_assets_and_exchange_parties_stop_the_run(lake, v2, markets):
    lake.publish_snapshot("market_assets", asset_dimension(markets))
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", JAN, "t9")))
    with pytest.raises(UnresolvedAssetsError, match="t9"):
        lake.process_v2()
    assert lake.cursor("trades_v2") is None and lake.scan("trades").count() == 0


def test_exchange_party_stops_the_run(lake, v2, markets):
    lake.publish_snapshot("market_assets", asset_dimension(markets))
    lake.write_partitioned("order_filled_v2", v2(("a", JAN, "t1", "maker", "BUY", EXCHANGE)))
    with pytest.raises(TradeModelError):
        lake.process_v2()
    assert lake.cursor("trades_v2") is None


def test_invalid_rows_still_advance_the_mark(lake, v2, markets):
    lake.publish_snapshot("market_assets", asset_dimension(markets))
    lake.write_partitioned("order_filled_v2", v2(("a", JAN, "t1", "taker")))
    assert lake.process_v2() == 0
    assert lake.cursor("trades_v2")["last_id"] == "a"


def test_incremental_v1(spark, lake, markets):
    schema = ("id string, timestamp long, maker string, makerAssetId string, makerAmountFilled string, taker string, "
              "takerAssetId string, takerAmountFilled string, transactionHash string")
    rows = [
        ("1", JAN, "m", "t1", "10000000", "t", "0", "5000000", "h"),
        ("2", JAN + 1, "m", "0", "3000000", "t", "t2", "6000000", "h"),
        ("3", JAN + 2, "m", "t1", "5000000", "t", "0", "6000000", "h"),
        ("4", JAN + 3, "m", "t9", "1", "t", "0", "1", "h"),
        ("5", JAN + 4, "m", "t1", "1", "t", "t2", "1", "h"),
        ("6", JAN + 5, "m", "t1", "0", "t", "0", "0", "h"),
    ]
    lake.write_partitioned("orderFilled", spark.createDataFrame(rows, schema))
    lake.write_partitioned("markets", markets)
    assert lake.process("v1") == 2 and lake.process("v1") == 0
    got = {r.orderfilled_id: (r.taker_direction, r.price, r.nonusdc_side) for r in lake.scan("trades").collect()}
    assert got == {"1": ("BUY", 0.5, "token1"), "2": ("SELL", 0.5, "token2")}
    assert lake.cursor("trades")["last_id"] == "6"


def test_compaction_keeps_the_latest_row_and_is_idempotent(lake, v2):
    first, again = v2(("a", JAN), ("b", JAN + 5)), v2(("a", JAN, "t2"), ("b", JAN + 5, "t2"))
    for seq, df in enumerate((first, again)):
        lake.write_partitioned("fills", df.coalesce(1).withColumn("ingest_seq", F.lit(seq)))
    lake.write_partitioned("fills", v2(("z", FEB)).coalesce(1).withColumn("ingest_seq", F.lit(0)))
    assert lake.compact("fills", 2024, 1) == 2
    assert {(r.id, r.asset) for r in lake.scan("fills", 2024, 1).collect()} == {("a", "t2"), ("b", "t2")}
    months = {(r.year, r.month): r for r in lake.partition_inventory("fills").collect()}
    assert (months[2024, 1].files, months[2024, 1].compacted) == (1, True)
    assert (months[2024, 2].files, months[2024, 2].compacted, months[2024, 2].rows) == (1, False, 1)
    assert lake.compact("fills", 2024, 1) == 0 and lake.compact("fills", 2024, 2) == 0
    assert lake.compact("nothing", 2024, 1) == 0


def test_compaction_leaves_months_with_missing_keys_whole(lake, v2):
    lake.write_partitioned("fills", v2(("a", JAN), ("a", FEB)).coalesce(1))
    lake.write_partitioned("fills", v2(("a", FEB)).coalesce(1))
    lake.write_partitioned("fills", v2(("x", JAN), ("y", JAN)).coalesce(1).withColumn("id", F.lit(None).cast("string")))
    got = {(r.year, r.month): r.rows for r in lake.compact_all("fills").collect()}
    assert got == {(2024, 1): 3, (2024, 2): 1}


def test_seventeen_runs_are_due(spark, lake, v2):
    for i in range(17):
        lake._write(v2((f"r{i}", JAN + i)).coalesce(1), f"{lake.root}/fills")
    lake._write(v2(("f", FEB)).coalesce(1), f"{lake.root}/fills")
    assert [(r.year, r.month) for r in lake.due_partitions("fills").collect()] == [(2024, 1)]
    assert lake.compact_due("fills").first().rows == 17
    assert lake.due_partitions("fills").count() == 0


def test_inventory_and_marks(lake, v2):
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB)))
    rows = {r.source: r for r in lake.source_inventory(["order_filled_v2", "trades"]).collect()}
    assert (rows["order_filled_v2"].rows, rows["order_filled_v2"].latest_timestamp) == (2, FEB)
    assert (rows["trades"].rows, rows["trades"].files, rows["trades"].latest_timestamp) == (0, 0, None)
    assert lake.max_timestamp("order_filled_v2") == FEB and lake.next_block() == 6
    assert lake.max_timestamp("trades") is None


def test_inventory_tells_months_whose_columns_drifted(lake, v2):
    lake.write_partitioned("fills", v2(("a", JAN), ("b", FEB)))
    lake.write_partitioned("fills", v2(("c", MAR)).withColumn("extra", F.lit(1)))
    hashes = lambda: {r.month: r.schema_sha256 for r in lake.partition_inventory("fills").collect()}
    before = hashes()
    assert before[1] == before[2] != before[3] and None not in before.values()
    lake.write_partitioned("fills", v2(("d", FEB)).withColumn("asset", F.lit(7)))
    after = hashes()
    assert (after[1], after[3]) == (before[1], before[3]) and after[2] not in (None, after[1], after[3])


def test_stream_equals_batch_in_any_file_order(spark, lake, v2, markets, tmp_path):
    assets = asset_dimension(markets)
    lake.publish_snapshot("market_assets", assets)
    # Newest file first, one file per batch, one id landed twice.
    for part in (v2(("e", MAR)), v2(("a", JAN), ("b", JAN)), v2(("b", JAN), ("c", FEB))):
        lake.write_partitioned("order_filled_v2", part.coalesce(1))
    stream = Lake(spark, str(tmp_path / "stream"))
    for _ in range(2):
        fills = read_fill_stream(spark, lake.path("order_filled_v2"), files_per_batch=1)
        fills_to_trades(fills, assets, stream, str(tmp_path / "checkpoint")).awaitTermination()
    lake.process_v2()
    columns = lake.scan("trades").columns
    assert sorted(stream.scan("trades").select(columns).collect()) == sorted(lake.scan("trades").collect())


def test_export_and_views(spark, lake, v2, tmp_path):
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB)))
    lake.export_snapshot(["order_filled_v2"], "2026-01-01", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/2026-01-01/order_filled_v2")).count() == 2
    lake.register_views(["order_filled_v2"])
    assert spark.sql("SELECT count(*) FROM order_filled_v2 WHERE month = 2").first()[0] == 1


def test_dimensions_and_outcomes_refresh(spark, lake):
    text = {c: F.lit("x") for c in ("createdAt", "answer1", "answer2", "market_slug", "condition_id", "volume", "ticker",
                                    "category", "resolutionSource", "umaResolutionStatus")}
    base = spark.createDataFrame(
        [("m1", "t1", "t2", "q", JAN, True, '["0","1"]', "2024-01-05T00:00:00Z"), ("m2", "t3", "t4", "q", JAN, False, "[]", "")],
        "id string, token1 string, token2 string, question string, timestamp long, closed boolean, "
        "outcomePrices string, closedTime string",
    ).withColumns({**text, "neg_risk": F.lit(False), "observed_at": F.lit(FEB * 10**9)})
    lake.write_partitioned("markets", base)
    assert lake.refresh_dimensions() == {"market_assets": 4, "markets_current": 2}
    assert {r.timestamp for r in lake.scan("markets_current").collect()} == {FEB}
    assert lake.refresh_outcomes() == {"added": 1, "skipped": 1}
    assert lake.refresh_outcomes() == {"added": 0, "skipped": 1}
    (row,) = lake.scan("market_outcomes").collect()
    assert (row.market_id, row.winner_token, row.resolved_at) == ("m1", "token2", 1704412800)


def test_appends_after_a_snapshot_are_read(lake, v2):
    lake.publish_snapshot("fills", v2(("a", JAN)))
    lake.write_partitioned("fills", v2(("b", FEB)))
    assert {r.id for r in lake.scan("fills").collect()} == {"a", "b"}


def _fills(spark, rows):
    return spark.createDataFrame(rows, "id string, timestamp long, v int, ingest_seq int")


def test_compaction_keeps_columns_and_settles(spark, tmp_path):
    """Columns beyond any contract survive, the last landed version stays, a second run writes nothing."""
    lake = Lake(spark, str(tmp_path))
    january, march = 1704067200, 1709251200
    lake.write_partitioned("x", _fills(spark, [("a", january, 1, 0), ("b", january + 5, 1, 0), ("c", march, 1, 0)]))
    lake.write_partitioned("x", _fills(spark, [("a", january, 2, 1)]))
    first = {(r.year, r.month): r.rows for r in lake.compact_all("x").collect()}
    assert first == {(2024, 1): 2, (2024, 3): 1}
    rows = {r.id: (r.v, r.ingest_seq) for r in lake.scan("x").collect()}
    assert rows == {"a": (2, 1), "b": (1, 0), "c": (1, 0)}
    before = {r.path: r.modified for r in lake._files("x").collect()}
    assert {(r.year, r.month): r.rows for r in lake.compact_all("x").collect()} == first
    assert {r.path: r.modified for r in lake._files("x").collect()} == before


def test_scan_shows_columns_that_only_some_files_have(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_partitioned("x", spark.createDataFrame([(1704067200, 1)], "timestamp long, a int"))
    lake.write_partitioned("x", spark.createDataFrame([(1704067200, "y")], "timestamp long, b string"))
    assert {(r.a, r.b) for r in lake.scan("x").collect()} == {(1, None), (None, "y")}
    with pytest.raises(ValueError, match="empty"):
        lake.write_partitioned("x", spark.createDataFrame([], "timestamp long, a int"))
