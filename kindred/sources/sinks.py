"""JSON output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one JSON object per row; every partition writes its own file."""
    df.write.mode(mode).json(path)
