"""The physical plans the operators are meant to get."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from outcomelake import session
from outcomelake.operators import backtest as B
from outcomelake.operators import positions as P
from outcomelake.operators.wallets import combine_sides, wallet_market_metrics
from outcomelake.plans.fixtures import markets, trades

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build,exchanges", [
    (lambda t, m: P.expand_to_positions(t), 0),
    (lambda t, m: P.positions_table(t), 1),
    (lambda t, m: P.last_price_per_side(t), 1),
    (lambda t, m: B.transaction_bars(t, 60), 1),
    (lambda t, m: combine_sides(wallet_market_metrics(t, m)), 4),
])
def test_shuffles_and_hash_aggregates(spark, build, exchanges):
    text = plan(build(trades(spark, SF_DIR), markets(spark, SF_DIR)))
    assert text.count("Exchange hashpartitioning") == exchanges
    assert "SortAggregate" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_stored_tables_prune_columns_and_push_filters(spark):
    stored = session.materialize(trades(spark, SF_DIR), "plan-test")
    text = plan(P.positions_table(stored.where(F.col("timestamp") > 1704153600), "taker"))
    assert "GreaterThan(timestamp,1704153600)" in text
    assert "transactionHash" not in text.split("ReadSchema")[1]


def test_scratch_folder_needs_the_checkpoint_setting(spark):
    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Unset, "x")
    one, two = (session.shared_folder(spark, "x") for _ in range(2))
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]


def test_copy_fills_read_stored_tables_only(spark):
    """Counting hot keys and walking the rows both read what is stored: no plan derives the prints again."""
    from __spark_entry__ import queries

    for name in ("w07_next_print", "w08_copy_fills"):
        text = plan(queries()[name](spark, SF_DIR))
        assert text.count("Scan parquet") >= 2 and "signup" not in text  # a word of the prints' derivation alone
