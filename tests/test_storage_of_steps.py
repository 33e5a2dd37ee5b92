"""What steps leave behind, and months that are written in several parts."""

from __future__ import annotations

import os
from glob import glob

from pyspark.sql import functions as F

from __spark_entry__ import queries
from outcomelake.operators.dims import asset_dimension
from outcomelake.sources.lake import Lake
from outcomelake.streaming.incremental import fills_to_trades, read_fill_stream
from test_lake import FEB, JAN, lake, markets, v2  # noqa: F401

STEPS = ("micro-batch", "new-fills", "joined-fills", "touched", "merged-trades", "compared-trades", "appended-trades", "month-lines")


def _left(spark) -> set[str]:
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return {n for n in os.listdir(folder) if n.rsplit("-", 1)[0] in STEPS}


def test_stream_leaves_no_copies(spark, lake, v2, markets, tmp_path):  # noqa: F811
    before, state = _left(spark), str(tmp_path / "checkpoint")
    for part in (v2(("a", FEB), ("b", FEB + 10)), v2(("old", JAN), ("b", FEB + 10, "t1", "taker"))):
        lake.write_partitioned("order_filled_v2", part.coalesce(1))
        fills = read_fill_stream(spark, lake.path("order_filled_v2"), files_per_batch=1)
        fills_to_trades(fills, asset_dimension(markets), lake, state)
    assert {r.orderfilled_id for r in lake.scan("trades").collect()} == {"v2:a", "v2:old"}
    assert _left(spark) == before
    assert not glob(f"{state}/on-time/**/*.parquet", recursive=True) and not glob(f"{state}/late/**/*.parquet", recursive=True)


def test_parts_of_a_month_are_one_file(spark, lake, v2):  # noqa: F811
    rows = v2(*[(str(k), JAN + k) for k in range(200)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        lake.write_partitioned("fills", rows)
        lake.write_partitioned("fills", rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    month = lake.partition_inventory("fills").first()
    assert (month.files, month.run_files, month.rows) == (2, 2, 400) and month.parts > 2
    assert lake.due_partitions("fills", max_run_files=2).isEmpty()
    assert lake.compact("fills", 2024, 1) == 200


def test_lake_of_months_in_parts(spark):
    """The report counts one file a month, however large, and no task writes the whole lake."""
    path = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        told = {(r["check"], r["column"], r["code"]): r["count"] for r in queries()["q03_validate_lake"](spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert told["source_stats", "files", ""] <= 84 and told["file_read", "", "unreadable"] == 1


def test_compaction_shuffles_rows_once(spark, lake, v2, monkeypatch):  # noqa: F811
    """Versions of one time meet where rows are dealt out by time; a key whose time changed is still one row."""
    stored, plans = Lake._store, []

    def store(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(self, df, *args, **kwargs)

    monkeypatch.setattr(Lake, "_store", store)
    lake.write_partitioned("fills", v2(("a", JAN), ("b", JAN + 5), ("moved", JAN + 9), ("f", FEB)))
    lake.write_partitioned("fills", v2(("a", JAN, "t1", "taker"), ("moved", JAN + 99, "t1", "taker"), ("f", FEB, "t1", "taker")))
    assert {(r.month, r.rows) for r in lake.compact_all("fills", keys=["id"]).collect()} == {(1, 3), (2, 1)}
    kept = {r.id: (r.timestamp, r.order_type) for r in lake.scan("fills").collect()}
    assert kept["a"] == (JAN, "taker") and kept["moved"] == (JAN + 99, "taker") and kept["f"] == (FEB, "taker") and kept["b"][0] == JAN + 5
    lake.write_partitioned("more", v2(("a", JAN), ("b", JAN + 5)))
    lake.write_partitioned("more", v2(("a", JAN, "t1", "taker"), ("", JAN + 5), ("", JAN + 5)).withColumns({"id": F.nullif("id", F.lit("")), "venue": F.lit("x")}))
    lake.write_partitioned("same", v2(("a", JAN), ("b", JAN + 5)))
    lake.write_partitioned("same", v2(("a", JAN, "t1", "taker")))
    assert lake.compact("more", 2024, 1, keys=["id"]) == 5  # a month with rows that lack a key stays whole
    assert "_row" not in lake.scan("more").columns and "venue" in lake.scan("more").columns
    assert lake.compact("same", 2024, 1, keys=["id"]) == 2
    assert "Window" not in plans[-1]
