"""The manifest: what readers see before and after a switch, inventories without data, repair, held and late fills."""

from __future__ import annotations

import os
from glob import glob

import pytest
from pyspark.sql import functions as F

from outcomelake.operators.dims import asset_dimension
from outcomelake.operators import quality as Q
from outcomelake.operators.fills import UnresolvedAssetsError, dedupe_guarded
from outcomelake.sources import storage
from outcomelake.sources.lake import Lake
from outcomelake.sources.manifest import Manifest
from test_lake import FEB, JAN, MAR, lake, markets, v2  # noqa: F401


def ids(lake, source, *month):  # noqa: F811
    return sorted(r.id for r in lake.scan(source, *month).collect())


def test_readers_see_old_or_new_files(lake, v2, monkeypatch):  # noqa: F811
    """A compaction that stops between writing and the switch changes nothing; one that ends changes all at once."""
    for name in "ab":
        lake.write_partitioned("fills", v2((name, JAN), ("c", FEB)).coalesce(1))
    before = lake.scan("fills")

    def stop(self, facts, replaces=()):
        raise RuntimeError("the run stops here")

    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "switch", stop)
        with pytest.raises(RuntimeError):
            lake.compact_all("fills")
        with pytest.raises(RuntimeError):
            lake.write_partitioned("fills", v2(("d", MAR)))
        assert ids(lake, "fills") == ["a", "b", "c", "c"]
        assert {(r.month, r.files) for r in lake.partition_inventory("fills").collect()} == {(1, 2), (2, 2)}
    assert lake.compact_all("fills").count() == 2
    assert ids(lake, "fills") == ["a", "b", "c"]
    assert sorted(r.id for r in before.collect()) == ["a", "b", "c", "c"]  # opened before the switch
    # Two commits replaced, two folders of stopped runs.
    assert len(lake.vacuum("fills", older_than_hours=0)) == 4 and ids(lake, "fills") == ["a", "b", "c"]
    lake.write_partitioned("fills", v2(("e", MAR)))
    assert ids(lake, "fills") == ["a", "b", "c", "e"]


def test_inventories_and_marks_open_no_data_file(lake, v2):  # noqa: F811
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB)))
    lake.write_partitioned("order_filled_v2", v2(("c", FEB + 5)).withColumn("extra", F.lit(1)))
    want = lake.partition_inventory("order_filled_v2").collect()
    for path in glob(f"{lake.root}/order_filled_v2/**/*.parquet", recursive=True):
        with open(path, "wb") as f:
            f.write(b"no parquet")
    assert sorted(lake.partition_inventory("order_filled_v2").collect()) == sorted(want)
    assert (lake.source_inventory(["order_filled_v2"]).first().rows, lake.max_timestamp("order_filled_v2")) == (3, FEB + 5)
    assert lake.due_partitions("order_filled_v2", max_run_files=1).first().month == 2
    assert "extra" in lake.scan("order_filled_v2").columns  # columns come from the manifest too
    assert len({r.schema_sha256 for r in want}) == 2


def test_repair_from_a_scan(spark, lake, v2):  # noqa: F811
    """Foreign files in month folders, of two kinds of columns, and a manifest that was lost."""
    for k, df in enumerate((v2(("a", JAN), ("b", FEB)), v2(("c", JAN)).withColumn("fee", F.lit("0")))):
        at = F.timestamp_seconds("timestamp")
        df.withColumns({"year": F.year(at), "month": F.month(at)}).write.mode("append").partitionBy("year", "month").parquet(f"{lake.root}/fills")
    assert lake.scan("fills").count() == 0
    assert lake.repair("fills") == 2 and lake.repair("fills") == 0
    assert ids(lake, "fills") == ["a", "b", "c"] and {r.fee for r in lake.scan_evolving("fills").collect()} == {"0.0", "0"}
    lake.write_partitioned("fills", v2(("d", MAR)))
    want = {(r.month, r.rows) for r in lake.partition_inventory("fills").collect()}
    for path in glob(f"{lake.root}/_state/files/fills/*.json"):
        os.remove(path)
    fresh = Lake(spark, lake.root)
    assert fresh.repair("fills") == 3 and {(r.month, r.rows) for r in fresh.partition_inventory("fills").collect()} == want


def test_scans_prune_by_the_manifest(lake, v2):  # noqa: F811
    lake.write_partitioned("fills", v2(("a", JAN), ("b", FEB)))
    lake.write_partitioned("fills", v2(("c", FEB)).withColumn("fee", F.lit("0")))  # another type: two scans
    plan = lake.scan("fills", 2024, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [" in plan
    assert ids(lake, "fills", 2024, 2) == ["b", "c"]
    lake.write_months("fills", [(2024, 1), (2024, 2)], v2(("x", JAN), ("y", FEB), ("z", MAR)), replace=True)
    assert ids(lake, "fills") == ["x", "y"]


def test_held_late_and_corrected_fills(lake, v2, markets):  # noqa: F811
    assets = asset_dimension(markets)
    trades = lambda: {r.orderfilled_id: r.nonusdc_side for r in lake.scan("trades").collect()}
    lake.publish_snapshot("market_assets", assets.where("asset = 't1'"))
    lake.write_partitioned("order_filled_v2", v2(("a", MAR), ("b", MAR, "t2"), ("n", MAR, "t9")))
    with pytest.raises(UnresolvedAssetsError):
        lake.process_v2()
    assert lake.cursor("trades_v2") is None and trades() == {}
    assert lake.process_v2(hold_unknown=True) == 1
    assert {(r.asset, r.rows) for r in lake.held_assets().collect()} == {("t2", 1), ("t9", 1)}
    # A late fill, one that comes again, and one that turns out a taker's.
    lake.write_partitioned("order_filled_v2", v2(("late", JAN), ("a", MAR), ("c", MAR)))
    assert lake.process_v2() == 2 and set(trades()) == {"v2:a", "v2:late", "v2:c"}
    lake.write_partitioned("order_filled_v2", v2(("c", MAR, "t1", "taker")))
    assert lake.process_v2() == 1 and set(trades()) == {"v2:a", "v2:late"}
    lake.publish_snapshot("market_assets", assets)
    assert lake.release_held() == 1 and trades()["v2:b"] == "token2"
    assert [(r.asset, r.rows) for r in lake.held_assets().collect()] == [("t9", 1)]
    # A held fill that is corrected leaves the held ones; compaction makes nothing new.
    lake.write_partitioned("order_filled_v2", v2(("n", MAR, "t9", "taker")))
    assert lake.process_v2() == 0 and lake.held_assets().count() == 0
    lake.compact_all("order_filled_v2")
    assert lake.process_v2() == 0 and len(trades()) == 3


def test_a_crash_before_the_mark_repeats_without_effect(lake, v2, markets, monkeypatch):  # noqa: F811
    lake.publish_snapshot("market_assets", asset_dimension(markets))
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB)))
    with monkeypatch.context() as patch:
        patch.setattr(Lake, "_advance", lambda *args: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            lake.process_v2()
    assert lake.scan("trades").count() == 2 and lake.process_v2() == 0 and lake.scan("trades").count() == 2


def test_marks_of_an_older_kind(lake, v2, markets):  # noqa: F811
    lake.publish_snapshot("market_assets", asset_dimension(markets))
    lake.write_partitioned("order_filled_v2", v2(("a", JAN), ("b", FEB), ("c", FEB), ("d", MAR)))
    lake.save_cursor("trades_v2", 2024, 2, None, "b")  # by id alone
    assert lake.process_v2() == 2
    assert {r.orderfilled_id for r in lake.scan("trades").collect()} == {"v2:c", "v2:d"}


def test_report_on_a_lake_with_bad_files(spark, lake, v2):  # noqa: F811
    """One file corrupt, one gone, one with another number of rows, one with other types; the rest is checked."""
    for k in range(5):
        df = v2((f"a{k}", JAN + k), (f"b{k}", JAN + k)).coalesce(1)
        lake.write_partitioned("order_filled_v2", df.withColumn("fee", F.lit("0")) if k == 4 else df)
    files = sorted(r.path for r in lake._files("order_filled_v2").collect())
    local = [p.removeprefix("file://").removeprefix("file:") for p in files]
    storage.write_text(spark, files[0], "damaged")
    os.remove(local[1])
    v2(("only", JAN)).coalesce(1).write.parquet(f"{lake.root}/other")
    storage.delete(spark, files[2])
    storage.move(spark, glob(f"{lake.root}/other/*.parquet")[0], files[2])
    outcome = {r.path: r.problem for r in lake.read_outcomes("order_filled_v2", every_column=True).collect()}
    assert [outcome[p] for p in files] == ["unreadable", "unreadable", "row_count", None, None]
    report = {(r.check, r.column, r.code): r for r in Q.validate_lake(lake, ["order_filled_v2", "trades"]).collect()}
    assert report["file_read", None, "unreadable"]["count"] == 2 and report["file_read", None, "row_count"]["count"] == 1
    assert report["file_schema", "fee", "wrong_type"]["count"] == 1
    assert (report["source_stats", "rows", None]["count"], report["source_stats", "min_timestamp", None]["count"]) == (10, JAN)
    assert report["source_presence", None, "no_files"].status == "warning"
    assert report["full_checks", None, None].status == "skipped"
    assert report["contract_values", "side", "allowed"].status == "ok"
    whole = Q.report_status(Q.validate_lake(lake, full=True)).collect()
    assert [(r.source, r.status) for r in whole] == [("order_filled_v2", "error")]


def test_guarded_dedupe(spark):
    rows = [("a", 1), ("a", 2), (None, 3), (None, 4)]
    df = spark.createDataFrame(rows, "k string, v int")
    assert dedupe_guarded(df, ["k"], ["v"]).count() == 4
    assert {(r.k, r.v) for r in dedupe_guarded(df.where("k IS NOT NULL"), ["k"], ["v"], keep="first").collect()} == {("a", 1)}
