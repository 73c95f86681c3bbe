"""Source validation."""

from __future__ import annotations

from pyspark.sql import DataFrame


def expect_count(df: DataFrame, expected: int, what: str = "rows") -> DataFrame:
    """Return ``df`` if it has exactly ``expected`` rows, else raise ValueError."""
    found = df.count()
    if found != expected:
        raise ValueError(f"expected {expected} {what}, found {found}")
    return df
