"""Market metadata is parsed once, by more tasks than its table has row groups."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries
from outcomelake.plans.fixtures import raw_markets

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["d10_outcome_counts", "d10_refresh_outcomes"])
def test_outcomes_read_parsed_metadata(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "part.parquet" not in plan and "clobTokenIds" not in plan


def test_raw_markets_are_spread(spark):
    assert "Exchange hashpartitioning(p_partkey" in raw_markets(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
