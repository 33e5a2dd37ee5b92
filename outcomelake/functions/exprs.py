"""Column expressions shared by the operators (all JVM-side, all codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICRO = 1_000_000  # amounts originate as integers of 1e-6


def micros(amount: Column | str) -> Column:
    """An amount in its native 1e-6 units.

    Integer sums are exact and independent of row order, run in a hash
    aggregate on a primitive long, and make ``== 0`` tests on inventories safe.
    ANSI mode raises on overflow, which starts at 9.2e12 whole units.
    """
    return F.rint(_c(amount) * F.lit(float(MICRO))).cast("long")


def from_micros(units: Column | str) -> Column:
    return _c(units).cast("double") / F.lit(float(MICRO))


def sum_micros(amount: Column | str) -> Column:
    """Exact sum of an amount as a double; 0.0 where nothing qualifies."""
    return from_micros(F.coalesce(F.sum(micros(amount)), F.lit(0).cast("long")))


def opposite(direction: Column | str) -> Column:
    return F.when(_c(direction) == "BUY", "SELL").otherwise("BUY")


def signed(direction: Column | str, amount: Column | str, buy: int = 1) -> Column:
    """``amount`` carrying the sign ``buy`` for BUY and the other sign otherwise."""
    a = _c(amount)
    plus, minus = (a, -a) if buy > 0 else (-a, a)
    return F.when(_c(direction) == "BUY", plus).otherwise(minus)


def observed_seconds(observed: Column | str) -> Column:
    """Epoch nanoseconds or seconds to seconds; null stays null."""
    o = _c(observed).cast("long")
    return F.when(o > 10_000_000_000, F.floor(o / F.lit(1_000_000_000))).otherwise(o)


def epoch_from_iso(text: Column | str) -> Column:
    """ISO text (naive means UTC) or a bare number to epoch seconds, null if malformed."""
    t = _c(text)
    number = F.regexp_like(t, F.lit(r"^\d+(\.\d+)?$"))
    return F.when(number, F.floor(t.try_cast("double")).cast("long")).otherwise(
        F.unix_seconds(F.try_to_timestamp(t))
    )


def clamp_mark(price: Column | str) -> Column:
    """A last price taken as settled beyond 0.98 and below 0.02."""
    p = _c(price)
    return F.when(p > 0.98, 1.0).when(p < 0.02, 0.0).otherwise(p)


def order_key(df: DataFrame, ts: str, tie: str) -> Column:
    """A single value ordering rows by ``(ts, tie)``, for ``max_by``/``min_by``.

    With an integral tie-break the pair is packed into one decimal, which a
    hash aggregate can update in place; a struct would force Spark to sort the
    whole input before the partial aggregation.  Text ids keep the struct.
    """
    if isinstance(df.schema[tie].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        # 2^64 leaves room for every signed 64-bit tie-break.
        packed = F.col(ts).cast("decimal(18,0)") * F.lit(str(2**64)).cast("decimal(20,0)")
        return (packed + F.col(tie).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.struct(F.col(ts), F.col(tie))


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
