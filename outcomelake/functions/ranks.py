"""X05 — exact ranks and nearest-rank quantiles without a single-task sort."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Epoch seconds fit 32 bits, so there are at most 65 536 buckets of at most
# 65 536 distinct values: both windows below are bounded for any row count.
BUCKET = 65_536


def value_ranks(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Distinct ``value`` with its row count ``n`` and 0-based first rank ``lo``.

    ``value`` is an integral time column.  Counts are combined map-side, one
    offset per bucket is broadcast, and values are ranked inside their bucket.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(rows.alias("n"))
        .withColumn("_b", F.floor(F.col(value) / F.lit(BUCKET)))
    )
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("_b")
        .agg(F.sum("n").alias("_bn"))
        .select("_b", F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_off"))
    )
    inside = Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.join(F.broadcast(offsets), "_b")
        .withColumn("lo", F.col("_off") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .select(value, "n", "lo")
    )


def distinct_index(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with their 0-based position ``idx`` in ascending order."""
    return value_ranks(df.select(value).distinct(), value).select(value, F.col("lo").alias("idx"))


def quantile_nearest(df: DataFrame, value: str, q: float) -> int | None:
    """The value whose 0-based rank is nearest to ``q * (n - 1)``, halves upward.

    Two jobs of counts, each combined map-side and at most one bucket wide at the
    driver: the first finds the bucket holding the rank, the second reads only
    that bucket's range, which a Parquet scan can skip to.  ``df`` is evaluated
    twice, so pass a stored table.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError(f"q must be in [0, 1], got {q!r}")
    bucket = F.floor(F.col(value) / F.lit(BUCKET))
    known = df.where(F.col(value).isNotNull())
    sizes = sorted((r.b, r.n) for r in known.groupBy(bucket.alias("b")).agg(_rows()).collect())
    target = math.floor(q * (sum(n for _, n in sizes) - 1) + 0.5)
    for b, n in sizes:
        if target < n:
            inside = known.where((F.col(value) >= b * BUCKET) & (F.col(value) < (b + 1) * BUCKET))
            for v, m in sorted((r.v, r.n) for r in inside.groupBy(F.col(value).alias("v")).agg(_rows()).collect()):
                if target < m:
                    return v
                target -= m
        target -= n
    return None


def _rows():
    return F.count(F.lit(1)).alias("n")
