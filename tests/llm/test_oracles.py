"""Every query that has SQL, against it."""

import pytest
from compare import difference, duck

from postingloom.llm import oracles, queries


@pytest.mark.parametrize("name", oracles.oracle_sql())
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(queries.queries()[name](spark, sf_dir), duck(sf_dir), oracles.oracle_sql()[name]) is None


def test_contract_names():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.queries()}


@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_quality_rules", "op6_chat_format"])
def test_native_plans_have_no_python(spark, sf_dir, name):
    plan = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(mark in plan for mark in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
