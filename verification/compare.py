"""Compare registered queries with their oracles: python -m verification.compare DIR [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    """An in-process connection with every table of ``directory`` as a view."""
    con = duckdb.connect()
    for path in Path(directory).glob("*.parquet"):
        con.execute(f'CREATE VIEW "{path.stem}" AS SELECT * FROM read_parquet(\'{path}\')')
    return con


def canonical(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    """Columns by name; numbers as floats, missing as None, rows in a fixed order."""
    df = df[sorted(df.columns)]
    rows = [
        tuple(
            None if pd.isna(v) else float(v) if isinstance(v, (int, float)) else v for v in row
        )
        for row in df.astype(object).itertuples(index=False)
    ]
    rows.sort(key=lambda row: tuple((v is None, str(type(v)), 0 if v is None else v) for v in row))
    return list(df.columns), rows


def differences(spark: SparkSession, con, directory: str, name: str) -> str | None:
    """None if query and oracle agree exactly, else what differs."""
    columns, ours = canonical(QUERIES[name](spark, directory).toPandas())
    expected_columns, theirs = canonical(con.execute(ORACLE[name]).df())
    if columns != expected_columns:
        return f"columns {columns} / {expected_columns}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    if not ours:
        return "no rows"
    bad = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    return f"{len(bad)} of {len(ours)} rows, first {bad[0][0]} / {bad[0][1]}" if bad else None


def main(directory: str, names: list[str]) -> int:
    from kindred import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(directory)
    failed = 0
    for name in names or list(QUERIES):
        started = time.time()
        problem = differences(spark, con, directory, name)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {time.time() - started:6.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
