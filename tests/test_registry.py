"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from compare import difference, duck, plan_of

import __spark_entry__ as contract

from postingloom.registry import oracles, queries  # noqa: E402

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()

# These write tables before they return a frame.
WRITING = {
    "landed_feeds_roundtrip", "raw_zone_roundtrip", "raw_zone_rewrite_day", "staging_append", "staging_stream",
    "incremental_fact", "incremental_bridge", "incremental_dimensions", "published_marts", "quality_report",
    "extract_landed_runs", "empty_rerun_replaces_day", "load_with_faults", "latest_run_with_odd_times",
    "quality_report_of_broken_tables", "streamed_fact", "marts_kept_current", "raw_zone_of_both_forms",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITING])
def test_plan_is_built_in_and_joins_on_keys(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert operator not in plan, (name, operator)


def test_columns_are_pruned_down_to_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["load_report"](spark, sf_dir))
    assert "o_totalprice" not in plan and "o_orderdate" not in plan


@pytest.mark.parametrize(
    "name, order",
    [
        ("mart_skill_demand", lambda r: (-r.job_count, r.skill_name)),
        ("mart_seniority_distribution", lambda r: (-r.job_count, r.seniority_level)),
        ("mart_geography_demand", lambda r: (-r.job_count, r.country_name, r.city_name, r.source)),
        ("mart_skill_by_seniority", lambda r: (r.skill_name, -r.job_count, r.seniority_level)),
    ],
)
def test_marts_are_in_order(spark, sf_dir, name, order):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows and rows == sorted(rows, key=order)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"skill_name", "job_count", "pct_du_total"}
