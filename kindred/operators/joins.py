"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Each key of a per-key table is spread over this many tasks.  It also puts a
# shuffle of its own under both sides, which is what AQE needs to split a skewed
# partition further; a side that arrives already aggregated on the key has none.
SALTS = 4


def join_per_key(
    facts: DataFrame, per_key: DataFrame, key: str | list[str], spread_by: str, how: str = "inner"
) -> DataFrame:
    """Join ``facts`` with a table of one row per ``key`` (a column or several).

    Rows of one key are divided by a hash of ``spread_by``; the per-key row is
    repeated for each division.  ``how`` is inner or left.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    repeated = per_key.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keys = [key] if isinstance(key, str) else key
    return facts.withColumn("salt", salt).join(repeated, [*keys, "salt"], how).drop("salt")
