"""Landing formats, market dimensions and data quality."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from outcomelake.functions import epoch_from_iso
from outcomelake.operators import dims as D
from outcomelake.operators import quality as Q
from outcomelake.operators.fills import dedupe, mark_taker_orders, sample_fixture, valid_maker_fills
from outcomelake.schemas import contract, has_contract
from outcomelake.sources import readers as R

EVENT = {
    "id": "1", "block_number": 7, "block_timestamp": 1704067200, "transaction_hash": "0xh", "user_id": "u",
    "asset": str(2**200), "amount_usdc": "1.5", "amount_shares": 3, "price": 0.5, "side": "buy",
    "order_hash": "o", "counterparty_id": "c", "order_type": "MAKER", "fee": 0, "builder": "b",
}


def test_jsonl_envelopes_and_last_row_wins(spark, tmp_path):
    lines = [
        EVENT, {"data": [{**EVENT, "id": "2"}], "page": 1}, {"records": [{**EVENT, "id": "3"}]},
        [{**EVENT, "id": "4"}, {**EVENT, "id": "1", "price": 0.25, "exchange": "0xE", "log_index": 3}],
    ]
    path = tmp_path / "fills.jsonl"
    path.write_text("\n\n".join(json.dumps(line) for line in lines))
    got = {r.id: r for r in R.import_fill_jsonl(spark, str(path)).collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert (got["1"].price, got["1"].exchange, got["1"].log_index) == (0.25, "0xE", 3)
    assert (got["2"].side, got["2"].order_type, got["2"].asset) == ("BUY", "maker", str(2**200))
    assert got["2"].timestamp == 1704067200 and got["2"].exchange is None
    Q.assert_valid(R.import_fill_jsonl(spark, str(path)).where("exchange IS NOT NULL").drop("metadata"), "order_filled_v2")


@pytest.mark.parametrize("line,message", [
    ('{"id": "1"}', "missing fields: block_number"),
    ('"text"', "neither a JSON object"),
    (json.dumps({**EVENT, "block_number": "x"}), "CAST_INVALID_INPUT"),
])
def test_jsonl_errors(spark, tmp_path, line, message):
    path = tmp_path / "bad.jsonl"
    path.write_text(line)
    with pytest.raises(Exception, match=message):
        R.import_fill_jsonl(spark, str(path)).collect()


def test_csv_fallbacks(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,createdAt\na,12\nb,soon\na,99\n")
    got = {(r.id, r.timestamp) for r in R.load_csv(spark, str(tmp_path / "m.csv")).collect()}
    assert got == {("a", 12), ("b", 0)}
    (tmp_path / "n.csv").write_text("name\nx\nx\n")
    assert [r.timestamp for r in R.load_csv(spark, str(tmp_path / "n.csv")).collect()] == [0, 0]


def test_legacy_ids_follow_file_order(spark, tmp_path):
    head = "timestamp,maker,makerAssetId,makerAmountFilled,taker,takerAssetId,takerAmountFilled,transactionHash\n"
    for name, rows in (("a.csv", range(3)), ("b.csv", range(3, 5))):
        (tmp_path / name).write_text(head + "".join(f"{i},m,0,1,t,x,2,h{i}\n" for i in rows))
    got = {(r.id, r.timestamp) for r in R.load_fills_csv_with_row_ids(spark, str(tmp_path / "*.csv")).collect()}
    assert got == {(f"legacy:{i}", i) for i in range(5)}
    assert R.load_fills_csv_with_row_ids(spark, str(tmp_path / "*.csv"), limit=2).count() == 2


def _word(n):
    return f"{n:064x}"


def test_event_log_decoding(spark):
    def log(side, token, maker, taker, index):
        data = "0x" + "".join(_word(n) for n in (side, token, maker, taker, 20_000, 0xAB, 0xCD))
        return ("0xEX", "0x10", "0xTX", hex(index), ["0xf", "0xORDER%d" % index, "0x" + _word(0xA1), "0x" + _word(0xB2)], data)

    schema = "address string, blockNumber string, transactionHash string, logIndex string, topics array<string>, data string"
    logs = spark.createDataFrame([log(0, 2**255 + 1, 500_000, 1_000_000, 1), log(1, 7, 2_000_000, 500_000, 2),
                                  log(0, 7, 1, 0, 3)], schema)
    matches = spark.createDataFrame([("0xtx", ["0xm", "0xorder2"])] * 2, "transactionHash string, topics array<string>")
    blocks = spark.createDataFrame([(16, 1704067200)], "block_number long, block_timestamp long")
    got = {r.log_index: r for r in R.decode_order_events(logs, matches, blocks).collect()}
    assert (got[1].id, got[1].asset, got[1].side, got[1].price) == ("0xtx:1", str(2**255 + 1), "BUY", 0.5)
    assert (got[2].amount_usdc, got[2].amount_shares, got[2].side, got[2].price) == (0.5, 2.0, "SELL", 0.25)
    assert [got[i].order_type for i in (1, 2)] == ["maker", "taker"] and got[3].price == 0.0
    assert got[1].user_id == "0x" + f"{0xA1:040x}" and got[1].fee == 0.02 and got[1].builder == "0x" + _word(0xAB)
    wide = spark.createDataFrame([log(0, 7, 2**200 + 2**70 + 5, 2**64 - 1, 1), log(0, 7, 2**64, 1, 2)], schema)
    amounts = {r.log_index: (r.amount_usdc, r.amount_shares) for r in R.decode_order_events(wide, matches, blocks).collect()}
    assert amounts == {1: (float(2**200 + 2**70 + 5) / 1e6, float(2**64 - 1) / 1e6), 2: (float(2**64) / 1e6, 1e-6)}
    for bad in ("0x00", "0x" + "0" * 447 + "g", "0x" + "0" * 447):
        with pytest.raises(Exception, match="lacks topics"):
            R.decode_order_events(logs.withColumn("data", F.lit(bad)), matches, blocks).collect()
    assert R.decode_order_events(logs.withColumn("data", F.upper(F.substring("data", 3, 448))), matches, blocks).count() == 3


def test_asset_words_are_converted_where_they_are(spark):
    """No second reading of the logs and no shuffle of decoded rows for their assets."""
    values = [0, 1, 2**56 - 1, 2**63, 2**64 - 1, 2**64, 2**96 + 12345, 2**119 + 1, 2**120 - 1, 2**120, 2**126, 10**38, 2**256 - 1]
    data = [(k, "0x10", "0xEX", "0xTX", hex(k), ["0xf", "0xo", "0xa", "0xb"], "0x" + "".join(_word(n) for n in (0, v, 1, 1, 0, 0, 0)))
            for k, v in enumerate(values)]
    logs = spark.createDataFrame(data, "k int, blockNumber string, address string, transactionHash string, logIndex string, topics array<string>, data string")
    matches = spark.createDataFrame([], "transactionHash string, topics array<string>")
    blocks = spark.createDataFrame([(16, 1704067200)], "block_number long, block_timestamp long")
    decoded = R.decode_order_events(logs, matches, blocks)
    assert {r.log_index: r.asset for r in decoded.collect()} == {k: str(v) for k, v in enumerate(values)}
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 - (plan.count("LocalRelation <empty>") > 0)


def test_metadata_flattening(spark):
    base = {"id": "m", "title": "T", "outcomes": '["Yes","No"]', "clobTokenIds": '["1","2"]', "createdAt": "2024-01-01T00:00:00Z"}
    rows = [
        base, {**base, "id": "event", "events": [{"ticker": "tk", "category": "Sports"}]},
        {**base, "id": "own", "question": "Q", "category": "Own", "events": [{"category": "Sports"}], "negRiskOther": True},
        {**base, "id": "list", "clobTokenIds": ["8", "9"]}, {**base, "id": "short", "clobTokenIds": '["1"]'},
        {**base, "id": "bad", "clobTokenIds": "nope"},
    ]
    raw = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    got = {r.id: r for r in R.flatten_market_metadata(raw).collect()}
    assert set(got) == {"m", "event", "own", "list"}
    assert (got["m"].question, got["m"].category, got["m"].timestamp, got["m"].neg_risk) == ("T", "", 1704067200, False)
    assert (got["event"].category, got["event"].ticker) == ("Sports", "tk")
    assert (got["own"].category, got["own"].question, got["own"].neg_risk) == ("Own", "Q", True)
    assert (got["list"].token1, got["list"].token2, got["list"].outcomePrices) == ("8", "9", "[]")


def test_iso_times(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01 00:00:00", "2024-01-01T01:00:00+01:00", "1704067200", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(epoch_from_iso("t")).collect()] == [1704067200] * 4 + [None] * 3


def test_official_outcomes(spark):
    prices = ['["1","0"]', '["0","1.0"]', '["0.5","0.5"]', '["1","1"]', "nope", '["1","0","0"]', None]
    df = spark.createDataFrame(
        [(f"m{i}", True, p, "2024-01-01T00:00:00Z", 5) for i, p in enumerate(prices)]
        + [("open", False, '["1","0"]', "2024-01-01T00:00:00Z", 5), ("undated", True, '["1","0"]', "", 5)],
        "id string, closed boolean, outcomePrices string, closedTime string, timestamp long")
    got = {r.market_id: r.winner_token for r in D.official_outcomes(df).collect()}
    assert got == {"m0": "token1", "m1": "token2"}
    known = spark.createDataFrame([("m0",)], "market_id string")
    assert [r.market_id for r in D.new_outcomes(df, known).collect()] == ["m1"]
    assert tuple(D.outcome_counts(df, known).first()) == (1, 7)


def test_latest_version_and_current(spark):
    schema = "id string, token1 string, token2 string, question string, timestamp long, observed_at long"
    base = spark.createDataFrame([("1", "a", "b", "old", 5, None), ("2", "c", "d", "only", 6, None)], schema)
    refreshed = spark.createDataFrame(
        [("1", "a", "b", "new", 5, 1_700_000_001 * 10**9), ("1", "a", "b", "newer", 5, 1_700_000_002 * 10**9)], schema)
    found = base.drop("observed_at").where("id = '1'").withColumn("question", F.lit("found"))
    current = {r.id: r for r in D.markets_current(
        {"markets": base, "missing_markets": found, "market_refreshes": refreshed}).collect()}
    assert (current["1"].question, current["1"].timestamp) == ("newer", 1_700_000_002)
    assert (current["2"].question, current["2"].timestamp, current["2"].category) == ("only", 6, "")
    # Without any observation the highest source still wins.
    plain = D.latest_version({"markets": base.drop("observed_at"), "missing_markets": found})
    assert {r.id: r.question for r in plain.collect()}["1"] == "found"


def test_changes(spark):
    batch = spark.createDataFrame([("1", "q"), ("2", "changed"), ("3", None)], "id string, question string")
    current = spark.createDataFrame([("2", "q"), ("3", None)], "id string, question string")
    got = {r.id: r.target for r in D.classify_changes(batch, current, 7).collect()}
    assert got == {"1": "markets", "2": "market_refreshes"}


def test_missing_assets(spark):
    v1 = spark.createDataFrame([("0", "B2"), ("A1", "0"), ("", None)], "makerAssetId string, takerAssetId string")
    v2 = spark.createDataFrame([("B1",), ("A2",)], "asset string")
    m = spark.createDataFrame([("A1", "A2")], "token1 string, token2 string")
    refs = [(v1, "makerAssetId"), (v1, "takerAssetId"), (v2, "asset")]
    assert [r.asset for r in D.missing_assets(refs, [m]).collect()] == ["B1", "B2"]
    tried = spark.createDataFrame([("B1",)], "asset string")
    assert [r.asset for r in D.missing_assets(refs, [m], tried, 5).collect()] == ["B2"]


def test_dedupe_rules(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "p"), (None, 2, "q")], "id string, n int, v string")
    keyed = df.where("id IS NOT NULL")
    assert dedupe(keyed, ["id"], ["n"]).first().v == "y"
    assert dedupe(keyed, ["id"], ["n"], keep="first").first().v == "x"
    assert dedupe(keyed, ["id"], ["n"]).count() == 1
    plan = dedupe(keyed, ["id"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    with pytest.raises(ValueError):
        dedupe(df, ["id"], ["n"], keep="any")


def test_corrected_role_does_not_survive(spark):
    schema = "id string, side string, order_type string, price double, amount_usdc double, amount_shares double, block_timestamp long, ingest_seq int"
    rows = [("a", "BUY", "maker", 0.5, 1.0, 2.0, 1, 0), ("a", "BUY", "taker", 0.5, 1.0, 2.0, 1, 1), ("b", "sell", "MAKER", 0.5, 1.0, 2.0, 1, 0),
            ("c", "hold", "maker", 0.5, 1.0, 2.0, 1, 0), ("d", "BUY", "maker", 1.5, 1.0, 2.0, 1, 0)]
    assert [r.id for r in valid_maker_fills(spark.createDataFrame(rows, schema)).collect()] == ["b"]


def test_taker_marks_and_samples(spark):
    fills = spark.createDataFrame([("t", "o1"), ("t", "o2")], "transaction_hash string, order_hash string")
    matches = spark.createDataFrame([("t", "o2"), ("t", "o2")], "transaction_hash string, order_hash string")
    assert sorted((r.order_hash, r.order_type) for r in mark_taker_orders(fills, matches).collect()) == [
        ("o1", "maker"), ("o2", "taker")]
    orders = spark.createDataFrame([("a1", "0"), ("0", "b1"), ("a1", "a2"), ("z", "0")], "makerAssetId string, takerAssetId string")
    m = spark.createDataFrame([("A", "a1", "a2"), ("B", "b1", "b2"), ("C", "c1", "c2")], "id string, token1 string, token2 string")
    sample, rows = sample_fixture(orders, m, 1)
    assert [r.id for r in sample.collect()] == ["A"] and rows.count() == 2


def test_contracts_and_violations(spark):
    assert contract("market_refreshes") is contract("markets") and contract("orderFilled").source == "orderFilled"
    assert has_contract("trades") and not has_contract("cursor")
    with pytest.raises(KeyError):
        contract("nothing")
    schema = "asset string, market_id string, token_side string, timestamp long"
    good = [("t1", "m", "token1", 1), ("t2", "m", "token2", 0)]
    assert Q.validate_frame(spark.createDataFrame(good, schema), contract("market_assets")) == []
    bad = spark.createDataFrame([("t1", None, "token9", -1), ("t1", "m", None, None)], schema)
    found = {(v.code, v.column): v.count for v in Q.validate_frame(bad, contract("market_assets"))}
    assert found == {("null", "market_id"): 1, ("null", "token_side"): 1, ("null", "timestamp"): 1,
                     ("allowed", "token_side"): 1, ("min", "timestamp"): 1, ("duplicate", "asset"): 2}
    partial = bad.drop("market_id").withColumn("timestamp", F.lit("x"))
    codes = {(v.code, v.column) for v in Q.validate_frame(partial, contract("market_assets"))}
    assert ("missing_column", "market_id") in codes and ("wrong_type", "timestamp") in codes
    with pytest.raises(Q.DataContractError):
        Q.assert_valid(bad, "market_assets")


def test_store_report(spark):
    assets = spark.createDataFrame([("t1", "m", "token1", 1)], "asset string, market_id string, token_side string, timestamp long")
    report = Q.validate_store({"market_assets": assets, "trades": None, "cursor": assets}, spark, full=True)
    status = {r.source: r.status for r in Q.report_status(report).collect()}
    assert status == {"market_assets": "ok", "trades": "warning", "cursor": "warning"}


def test_references_status_and_fingerprint(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "market_id string")
    known = spark.createDataFrame([("a",)], "id string")
    lost = Q.unknown_references(df, "market_id", known, "id")
    assert tuple(Q.reference_summary(lost).first()) == (1, ["b"])
    raw = spark.createDataFrame([("1", 5), ("1", 6), ("2", 4)], "id string, block_timestamp long")
    trades = spark.createDataFrame([("v2:1", 5), ("old", 9)], "orderfilled_id string, timestamp long")
    assert tuple(Q.ingest_status(raw, trades).first()) == (3, 2, 1, 6, 1, 5)
    assert tuple(Q.ingest_status(raw.limit(0), trades.limit(0)).first()) == (0, 0, 0, None, 0, None)
    left = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    right = spark.createDataFrame([("y", 2), ("x", 1)], "b string, a int")
    assert Q.fingerprint(left).first() == Q.fingerprint(right).first()
    assert Q.fingerprint(left).first() != Q.fingerprint(left.limit(1)).first()


def test_versions_of_a_fill_have_a_total_order(spark):
    """Spelling does not decide the role, and equal versions come out alike in any input order."""
    schema = "id string, side string, order_type string, price double, amount_usdc double, amount_shares double"
    corrected = [("a", "BUY", "maker", 0.5, 1.0, 2.0), ("a", "BUY", "TAKER", 0.5, 1.0, 2.0)]
    assert valid_maker_fills(spark.createDataFrame(corrected, schema)).count() == 0
    twice = [("a", "BUY", "maker", 0.5, 1.0, 2.0), ("a", "buy", "Maker", 0.9, 1.0, 2.0)]
    found = [valid_maker_fills(spark.createDataFrame(rows, schema)).first().price for rows in (twice, twice[::-1])]
    assert found[0] == found[1]


def test_words_of_256_bits_without_python(spark):
    values = [0, 1, 10**8, 10**8 - 1, 2**32, 2**64 - 1, 2**255, 2**256 - 1, 10**77, 3**160, 2**96 + 12345]
    df = spark.createDataFrame([(f"{v:064x}", str(v)) for v in values] + [(None, None), (f"{2**200:064X}", str(2**200))], "w string, want string")
    got = df.select("want", R.uint256_text(F.col("w")).alias("text"))
    assert all(r.text == r.want for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for bad in ("12", "g" * 64):
        with pytest.raises(Exception, match="256-bit"):
            spark.createDataFrame([(bad,)], "w string").select(R.uint256_text(F.col("w"))).collect()
