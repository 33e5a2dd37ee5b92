"""Disk that steps hold while they run: shuffle files, months taken together, state of streams, landed text."""

from __future__ import annotations

import os
import time
from glob import glob

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from outcomelake.operators.dims import asset_dimension
from outcomelake.session import scratch
from outcomelake.sources import lake as lake_module
from outcomelake.sources.lake import Lake
from outcomelake.streaming.incremental import fills_to_trades, read_fill_stream
from test_lake import FEB, JAN, lake, markets, v2  # noqa: F401
from test_plans import SF_DIR


def _shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, lake, v2):  # noqa: F811
    before = _shuffle_files(spark)
    with scratch(spark) as keep:
        keep(spark.range(1000).repartition(4, "id"), "joined-fills")
        lake.write_partitioned("fills", v2(("a", JAN), ("b", FEB)))
        for _ in range(50):
            if not _shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not _shuffle_files(spark) - before


def test_compaction_takes_months_together_up_to_a_size(spark, lake, v2, monkeypatch):  # noqa: F811
    """With a small limit each month is a shuffle of its own; months of earlier groups are not touched again."""
    for part in (v2(("a", JAN), ("b", JAN + 5), ("f", FEB)), v2(("a", JAN, "t1", "taker"), ("f", FEB, "t1", "taker"))):
        lake.write_partitioned("fills", part)
        lake.write_partitioned("large", part)
    jobs, stored = [], Lake._store
    monkeypatch.setattr(Lake, "_store", lambda self, df, *a, **k: (jobs.append(1), stored(self, df, *a, **k))[1])
    lake.compact_all("large", keys=["id"])
    assert len(jobs) == 1
    monkeypatch.setattr(lake_module, "COMPACTED_AT_ONCE", 1)
    assert {(r.month, r.rows) for r in lake.compact_all("fills", keys=["id"]).collect()} == {(1, 2), (2, 1)}
    assert len(jobs) == 3
    assert {r.id: r.order_type for r in lake.scan("fills").collect()} == {"a": "taker", "b": "maker", "f": "taker"}
    assert lake.month_totals("fills").where("compacted AND files = 1").count() == 2


def test_stored_trades_are_shuffled_once(spark, lake, v2, markets, monkeypatch):  # noqa: F811
    """A rewritten month is one shuffle by time without a join, and only months with a change are rewritten."""
    plans, stored = [], Lake._store

    def store(self, df, folder, order=None, dealt=False, unique=None):
        plans.append((df._jdf.queryExecution().optimizedPlan().toString(), order))
        stored(self, df, folder, order, dealt, unique)

    assets = asset_dimension(markets)
    lake.apply_fills(v2(("a", JAN), ("b", JAN + 9), ("c", FEB), ("d", FEB + 9)).withColumn("ingest_seq", F.lit(0)), assets)
    monkeypatch.setattr(Lake, "_store", store)
    again = v2(("a", JAN, "t1", "taker"), ("b", JAN + 9), ("e", FEB + 20)).withColumn("ingest_seq", F.lit(1))
    assert lake.apply_fills(again, assets) == 2
    plan, order = plans[0]
    assert "Join" not in plan and order == ["timestamp"]
    ids = {r.orderfilled_id: r.month for r in lake.scan("trades").collect()}
    assert ids == {"v2:b": 1, "v2:c": 2, "v2:d": 2, "v2:e": 2}
    # February only gained a row, so its first file stands.
    assert lake.month_totals("trades").where("month = 2").first().files == 2
    # What is stored already as it is changes nothing, beside a trade that is new.
    assert lake.apply_fills(v2(("c", FEB), ("g", FEB + 30)).withColumn("ingest_seq", F.lit(1)), assets) == 1
    assert lake.month_totals("trades").where("month = 2").first().rows == 4
    # A version at another time takes the place of the trade in its old month.
    moved = v2(("b", JAN + 30)).unionByName(v2(("d", FEB + 9, "t2"))).withColumn("ingest_seq", F.lit(2))
    spread = moved.unionByName(v2(("z", JAN)).withColumn("ingest_seq", F.lit(2)))
    assert lake.apply_fills(spread, assets) == 3
    got = {r.orderfilled_id: (r.timestamp, r.nonusdc_side) for r in lake.scan("trades").collect()}
    assert got["v2:d"] == (FEB + 9, "token2") and "v2:z" in got and got["v2:c"][0] == FEB and len(got) == 6


def test_a_trade_that_moves_in_time_is_replaced(spark, lake, v2, markets):  # noqa: F811
    assets = asset_dimension(markets)
    lake.apply_fills(v2(("b", JAN + 9), ("c", JAN + 12)).withColumn("ingest_seq", F.lit(0)), assets)
    assert lake.apply_fills(v2(("a", JAN), ("b", JAN + 30)).withColumn("ingest_seq", F.lit(1)), assets) == 2
    assert sorted((r.orderfilled_id, r.timestamp) for r in lake.scan("trades").collect()) == [
        ("v2:a", JAN), ("v2:b", JAN + 30), ("v2:c", JAN + 12)]


@pytest.mark.parametrize("few", [0, 1 << 19])
def test_held_fills_keep_every_column(spark, lake, v2, markets, monkeypatch, few):  # noqa: F811
    """The latest version waits with all its columns, whether unknown assets are few or many; a corrected one does not."""
    monkeypatch.setattr(lake_module, "FEW_ASSETS", few)
    assets = asset_dimension(markets)
    rows = v2(("a", JAN, "t1"), ("a", JAN, "t9"), ("b", JAN + 1, "t9"), ("b", JAN + 1, "t1"), ("c", JAN + 2, "t8"), ("d", JAN + 3, "t1"))
    rows = rows.coalesce(1).withColumn("ingest_seq", F.monotonically_increasing_id().cast("int"))
    lake.apply_fills(rows, assets, hold_unknown=True)
    held = {r.id: r for r in lake.scan("held_fills_v2").collect()}
    assert {k: r.asset for k, r in held.items()} == {"a": "t9", "c": "t8"}
    assert set(rows.columns) <= set(held["a"].asDict()) and held["a"].order_hash is not None


def test_state_of_a_stream_is_that_of_its_delay(spark, lake, v2, markets, tmp_path):  # noqa: F811
    """One file of long history: its last hour alone passes the state."""
    lake.write_partitioned("order_filled_v2", v2(*[(f"f{k}", JAN + k * 1800) for k in range(200)]).coalesce(1))
    fills = read_fill_stream(spark, lake.path("order_filled_v2"))
    run = fills_to_trades(fills, asset_dimension(markets), lake, str(tmp_path / "checkpoint"))
    assert lake.scan("trades").count() == 200
    assert run.recentProgress[0]["stateOperators"][0]["numRowsTotal"] <= 4


def test_json_lines_land_compressed(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(glob(f"{base}/jsonl-*"))
    queries()["l08_import_fill_jsonl"](spark, SF_DIR)
    (folder,) = set(glob(f"{base}/jsonl-*")) - before
    names = [n for _, _, files in os.walk(folder) for n in files if n.startswith("part-")]
    assert names and all(n.endswith(".txt.gz") for n in names)
