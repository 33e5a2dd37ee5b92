"""Plans that move or parse no more than a query needs."""

from __future__ import annotations

import json
import os

import pytest

from __spark_entry__ import queries
from outcomelake.operators import dims as D
from outcomelake.sources import readers as R
from outcomelake.sources.lake import Lake
from test_plans import SF_DIR, plan
from test_sources_dims_quality import EVENT


def _stored(spark) -> set[str]:
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")))


def test_first_generation_fills_are_not_landed(spark):
    before = _stored(spark)
    queries()["d01_normalize_fills_v1"](spark, SF_DIR)
    assert _stored(spark) == before


def test_latest_fills_are_found_once(spark):
    text = plan(queries()["d14_mark_taker_orders"](spark, SF_DIR))
    assert "Window" not in text and "lineitem.parquet" not in text


def test_missing_assets_meet_in_one_aggregate(spark):
    fills = spark.createDataFrame([("A", "0"), ("B", "C"), ("C", None), (None, "")], "maker string, taker string")
    known = spark.createDataFrame([("A", None), ("x", "")], "token1 string, token2 string")
    found = D.missing_assets([(fills, "maker"), (fills, "taker")], [known], spark.createDataFrame([("B",)], "asset string"))
    text = plan(found)
    assert "Join" not in text
    assert text.count("HashAggregate") == 2
    assert [r.asset for r in found.collect()] == ["C"]


def test_json_lines_are_parsed_once(spark, tmp_path):
    path = tmp_path / "fills.jsonl"
    path.write_text("\n".join(json.dumps(x) for x in [EVENT, [], {"rows": []}, {"data": "none", **EVENT, "id": "2"}]) + "\n  \n")
    out = R.import_fill_jsonl(spark, str(path))
    text = plan(out)
    assert text.count("from_json(") == 2 and "size(" not in text
    assert {r.id for r in out.collect()} == {"1", "2"}


@pytest.mark.parametrize("line", ['[{"id": "1", "asset": ', '{"data": "[1"}'])
def test_json_lists_that_do_not_parse_fail(spark, tmp_path, line):
    path = tmp_path / "bad.jsonl"
    path.write_text(line)
    with pytest.raises(Exception, match="malformed list of events|missing fields"):
        R.import_fill_jsonl(spark, str(path)).collect()


def test_only_fills_that_are_read_are_landed(spark, monkeypatch):
    landed = []
    write = Lake.write_partitioned
    monkeypatch.setattr(Lake, "write_partitioned", lambda lake, source, *a, **k: (landed.append(source), write(lake, source, *a, **k))[1])
    queries()["l12_adhoc_sql"](spark, SF_DIR)
    assert landed.count("order_filled_v2") == 1 and "orderFilled" not in landed
