"""Every registered query against its SQL, or for rows where it has none."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import differences

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    if name in ORACLES:
        assert differences(df, duck, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["organisation", "topic_id", "policy", "walk", "talk"]
    assert df.count() > 0


def test_no_query_leaves_the_jvm(spark, folder):
    for name in ("clean_statements", "tokens", "page_text", "walk_the_talk"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan
