"""Checks of arguments that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def need_columns(df: DataFrame, *names: str) -> None:
    """Stop early, and by name, where an input lacks a column."""
    for name in names:
        if name not in df.columns:
            raise ValueError(f"input without column {name!r}; it has {', '.join(df.columns)}")


def need_within(name: str, value: float, low: float, high: float = float("inf"), open_ends: bool = False) -> None:
    """Stop where a number lies outside its range; ``open_ends`` leaves out the ends."""
    inside = low < value < high if open_ends else low <= value <= high
    if not inside:
        raise ValueError(f"{name} = {value} lies outside {low} .. {high}{' (ends left out)' if open_ends else ''}")
