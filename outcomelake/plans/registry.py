"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outcomelake.plans.fixtures import with_ctes
from outcomelake.session import CHECKPOINT_DIR_KEY, use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` may read the fixture ``views``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if not spark.conf.get(CHECKPOINT_DIR_KEY, None):
                # The warehouse is shared on a cluster too.
                spark.conf.set(CHECKPOINT_DIR_KEY, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
            return fn(use_utc(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *views)
        return fn

    return register
