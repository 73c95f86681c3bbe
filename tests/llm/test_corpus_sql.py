"""Registered queries against their SQL, and that all of them are registered."""

import pytest

import __spark_entry__ as entry
from kindred.llm.oracle import ORACLE
from kindred.llm.queries import QUERIES
from verification.compare import canonical, duck


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, small_dir, name):
    ours = canonical(QUERIES[name](spark, small_dir).toPandas())
    theirs = canonical(duck(small_dir).execute(ORACLE[name]).df())
    assert ours == theirs and ours[1]


def test_every_row_of_the_table_is_in_the_result(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").count()
    for name in ("op2_kdshards", "op3_licenses", "op6_toxicity", "op11_quality"):
        assert QUERIES[name](spark, small_dir).count() == docs
