"""X06 and W15 — forward as-of join and alignment of series to a common clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outcomelake.functions.skew import DEFAULT_POLICY, SLICE, SkewPolicy, hot_keys, hot_rows, slice_rows


def asof_forward(
    signals: DataFrame,
    prints: DataFrame,
    by: list[str],
    at: str,
    print_ts: str,
    print_tie: str,
    take: dict[str, str],
    strict: bool,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Each signal with the first print of its group at or after (``strict``: after) ``at``.

    ``take`` maps output columns to print columns; they are null where no print
    follows.  Signals and prints are stacked and walked backwards in time, so
    the lookup is one shuffle and linear per group instead of a range join.
    Groups holding a large share of the rows are cut into time slices; a slice
    inherits the first print of the slices after it.  To find such groups the keys and times are read once
    beforehand, so pass stored tables.
    """
    # Walking back, a print must come before the signals it serves.
    print_tag, signal_tag = (0, 1) if strict else (1, 0)
    found = F.struct(*[F.col(c).alias(out) for out, c in take.items()])
    keys = [f"_k{i}" for i in range(len(by))]
    key_cols = [F.col(b).alias(k) for b, k in zip(by, keys)]
    stacked = signals.select(
        *key_cols, F.col(at).alias("_t"), F.lit(signal_tag).alias("_tag"),
        F.struct(*signals.columns).alias("_signal"),
    ).unionByName(
        prints.select(
            *key_cols, F.col(print_ts).alias("_t"), F.lit(print_tag).alias("_tag"),
            F.col(print_tie).alias("_tie"), found.alias("_print"),
        ),
        allowMissingColumns=True,
    )
    hot = hot_keys(stacked, keys, "_t", policy)
    group = keys if hot is None else [*keys, SLICE]
    back = (
        Window.partitionBy(*group)
        .orderBy(F.desc("_t"), F.desc("_tag"), F.desc("_tie"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    walked = stacked if hot is None else slice_rows(stacked, hot, keys, "_t")
    local = walked.withColumn("_next", F.last("_print", ignorenulls=True).over(back)).where(
        F.col("_signal").isNotNull()
    )
    if hot is not None:
        local = local.join(F.broadcast(_first_print_later(stacked, hot, keys)), [*keys, SLICE], "left")
        local = local.withColumn("_next", F.coalesce("_next", "_carried"))
    return local.select("_signal.*", *[F.col(f"_next.{out}").alias(out) for out in take])


def _first_print_later(stacked: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Per slice of a hot key, the first print of the slices after it."""
    key = F.when(F.col("_print").isNotNull(), F.struct("_t", "_tie"))
    later = Window.partitionBy(*keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    return (
        hot_rows(stacked, hot, keys, "_t")
        .groupBy(*keys, SLICE)
        .agg(F.min_by("_print", key).alias("_first"))
        .select(*keys, SLICE, F.last("_first", ignorenulls=True).over(later).alias("_carried"))
    )


def align_to_clock(
    series: DataFrame,
    names: list[str],
    name: str = "series",
    clock: str = "timestamp",
    value: str = "value",
    forward_fill: bool = False,
    slice_seconds: int = 86_400,
) -> DataFrame:
    """W15 — one row per instant of the union of all clocks, one column per named series.

    An instant a series does not have is NaN, or with ``forward_fill`` the value
    of its latest earlier row.  Values may themselves be NaN, so rows are
    carried, not non-null values.  Rows of one series must have distinct clocks.

    The fill walks the common clock inside time slices and inherits the last row
    of each series from the slices before; the slice table has one row per
    ``slice_seconds`` of history, so its window and broadcast are bounded by the
    calendar and not by the number of rows.
    """
    cells, present = [f"_v{i}" for i in range(len(names))], [f"_p{i}" for i in range(len(names))]
    # Values and presence as primitives, so the pivot is a hash aggregate.
    pivot = [
        agg
        for s, v, p in zip(names, cells, present)
        for agg in (F.max(F.when(F.col(name) == s, F.col(value))).alias(v), F.bool_or(F.col(name) == s).alias(p))
    ]
    wide = series.where(F.col(name).isin(*names)).groupBy(F.col(clock)).agg(*pivot)
    if not forward_fill:
        return wide.select(clock, *[_cell(_row(v, p), s) for v, p, s in zip(cells, present, names)])
    sliced = wide.withColumn(SLICE, F.floor(F.col(clock) / slice_seconds))
    ends = sliced.groupBy(SLICE).agg(
        *[F.max_by(v, F.when(F.col(p), F.col(clock))).alias(v) for v, p in zip(cells, present)],
        *[F.bool_or(p).alias(p) for p in present],
    )
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    upto = (
        Window.partitionBy(SLICE).orderBy(clock).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def latest(over) -> list[Column]:
        return [F.last(_row(v, p), ignorenulls=True).over(over) for v, p in zip(cells, present)]

    carried = [f"_c{i}" for i in range(len(names))]
    carry = ends.select(SLICE, *[c.alias(n) for c, n in zip(latest(earlier), carried)])
    filled = sliced.select(SLICE, clock, *[c.alias(n) for c, n in zip(latest(upto), cells)])
    return filled.join(F.broadcast(carry), SLICE, "left").select(
        clock, *[_cell(F.coalesce(v, c), s) for v, c, s in zip(cells, carried, names)]
    )


def _row(value: str, present: str) -> Column:
    """A row of a series, null where it has none; its value may itself be null or NaN."""
    return F.when(F.col(present), F.struct(F.col(value).alias("v")))


def _cell(row: Column, name: str) -> Column:
    return F.when(row.isNull(), F.lit(float("nan"))).otherwise(row.getField("v")).alias(name)
