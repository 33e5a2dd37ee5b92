"""Ordered per-key work that stays parallel when one key holds much of the data.

Running sums and as-of lookups need the rows of a key in time order, and a plain
window puts a whole key into one task.  Here keys above a share of the input
are cut into time slices; slices are processed in parallel and joined up by a
carried value per slice.

A key above ``limit`` rows is cut where the running count of its time buckets
passes a multiple of the limit, so slices hold about equally many rows however the
rows cluster in time.  At most ``1/limit`` of the rows are hot keys, each with at
most ``most_slices`` slices.  Rows of one bucket stay together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"


@dataclass(frozen=True)
class SkewPolicy:
    limit: int = 1_000_000
    bucket: int = 10
    most_slices: int = 1000


DEFAULT_POLICY = SkewPolicy()


def hot_keys(
    df: DataFrame, keys: list[str], ts: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame | None:
    """Keys above the limit with the starts of their time slices, None if there are none.

    Runs at once, like a pivot without values does, at every size of the input:
    one aggregation of the key and time columns, combined map-side, so that inputs
    without a hot key get a plain one-shuffle window.
    """
    bucket = F.floor(F.col(ts) / policy.bucket)
    counts = df.groupBy(*keys, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        *keys, "_b", F.sum("_n").over(whole).alias("_rows_all"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
    ).where(F.col("_rows_all") > policy.limit)
    size = F.greatest(F.lit(policy.limit), F.ceil(F.col("_rows_all") / policy.most_slices))
    starts = placed.groupBy(*keys, F.floor(F.col("_rows_before") / size).alias("_k")).agg((F.min("_b") * policy.bucket).alias("_s"))
    hot = starts.groupBy(*keys).agg(F.array_sort(F.collect_list("_s")).alias("_starts"))
    rows = hot.collect()
    return df.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def _slice_number(ts: str) -> Column:
    return (F.size(F.filter("_starts", lambda s: s <= F.col(ts))) - 1).cast("long")


def slice_rows(df: DataFrame, hot: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Every row with its slice number; rows of ordinary keys share slice -1."""
    number = F.when(F.col("_starts").isNotNull(), _slice_number(ts)).otherwise(F.lit(-1).cast("long"))
    return df.join(F.broadcast(hot), keys, "left").withColumn(SLICE, number).drop("_starts")


def hot_rows(df: DataFrame, hot: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Only the rows of hot keys, sliced."""
    return df.join(F.broadcast(hot), keys).withColumn(SLICE, _slice_number(ts)).drop("_starts")


def running_sum(
    df: DataFrame,
    keys: list[str],
    order: tuple[str, str],
    sums: dict[str, str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``sums`` maps output names to integer columns summed per key up to each row."""
    ts, tie = order
    hot = hot_keys(df, keys, ts, policy)
    group = keys if hot is None else [*keys, SLICE]
    upto = Window.partitionBy(*group).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    totals = {out: F.sum(c).over(upto) for out, c in sums.items()}
    if hot is None:
        return df.withColumns(totals)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        hot_rows(df, hot, keys, ts)
        .groupBy(*keys, SLICE)
        .agg(*[F.sum(c).alias(f"_t_{out}") for out, c in sums.items()])
        .select(*keys, SLICE, *[F.sum(f"_t_{out}").over(before).alias(f"_c_{out}") for out in sums])
    )
    return (
        slice_rows(df, hot, keys, ts)
        .withColumns(totals)
        .join(F.broadcast(carry), [*keys, SLICE], "left")
        .withColumns({o: F.col(o) + F.coalesce(F.col(f"_c_{o}"), F.lit(0)) for o in sums})
        .drop(SLICE, *[f"_c_{o}" for o in sums])
    )
