from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from outcomelake.session import build_session  # noqa: E402

BASE = 1704067200  # 2024-01-01 UTC


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
            "spark.sql.warehouse.dir": "/tmp/outcomelake-warehouse",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-tests-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TRADE_SCHEMA = (
    "timestamp long, market_id string, maker string, taker string, nonusdc_side string, "
    "maker_direction string, taker_direction string, price double, usd_amount double, "
    "token_amount double, transactionHash string, orderfilled_id string"
)


def fill(i, ts, market, maker, taker, side, taker_direction, price, tokens=100.0):
    other = "SELL" if taker_direction == "BUY" else "BUY"
    return (ts, market, maker, taker, side, other, taker_direction, price, price * tokens, tokens,
            f"0x{i}", f"f{i:04d}")


@pytest.fixture(scope="session")
def make_trades(spark):
    def make(rows):
        return spark.createDataFrame([fill(i, *r) for i, r in enumerate(rows)], TRADE_SCHEMA)

    return make
