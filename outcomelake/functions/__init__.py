from outcomelake.functions.exprs import (
    clamp_mark,
    epoch_from_iso,
    from_micros,
    micros,
    observed_seconds,
    opposite,
    order_key,
    signed,
    sum_micros,
)

__all__ = [
    "clamp_mark",
    "epoch_from_iso",
    "from_micros",
    "micros",
    "observed_seconds",
    "opposite",
    "order_key",
    "signed",
    "sum_micros",
]
