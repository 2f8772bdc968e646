"""Rows set aside before a load, constraints checked after it."""

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from postingloom.operators import modelling as M
from postingloom.operators import quality
from postingloom.sources.order_postings import order_postings


@pytest.fixture
def rows(spark, sf_dir):
    return order_postings(spark, sf_dir).withColumn("salary_max", F.lit("1"))


def test_sound_rows_pass(rows):
    assert quality.quarantined(rows).count() == 0
    assert quality.accepted(rows).count() == rows.count()


@pytest.mark.parametrize(
    "column, value, reason, for_all",
    [
        ("source", None, "source missing", True),
        ("source", "s" * 21, "source too long", True),
        ("external_id", None, "external_id missing", True),
        ("external_id", "x" * 101, "external_id too long", True),
        ("country", "c" * 11, "country too long", True),
        ("work_mode", "w" * 21, "work_mode too long", True),
        ("job_type", "j" * 51, "job_type too long", False),
        ("company_name", "c" * 256, "company_name too long", False),
        ("location", "l" * 201 + ",", "city too long", False),
    ],
)
def test_each_reason(rows, column, value, reason, for_all):
    faulty = rows.withColumn("country", F.lit("fr")).withColumn(column, F.lit(value).cast("string"))
    aside = quality.quarantined(faulty)
    assert {r.reason for r in aside.select("reason").distinct().collect()} == {reason}
    expected = faulty if for_all else M.relevant_postings(faulty)
    assert aside.count() == expected.count()
    assert aside.count() + quality.accepted(faulty).count() == faulty.count()


def test_values_at_the_limit_pass(rows):
    edge = rows.withColumns(
        {"external_id": F.lit("x" * 100), "company_name": F.lit("c" * 255), "job_type": F.lit("j" * 50),
         "country": F.lit("c" * 10), "location": F.lit("l" * 200 + ",")}
    )
    assert quality.quarantined(edge).count() == 0


def test_malformed_salaries(rows):
    faulty = rows.withColumn("salary_min", F.lit("much"))
    assert quality.malformed_salaries(rows).count() == 0
    assert quality.malformed_salaries(faulty).count() == rows.count()


def test_report_counts_violations(spark, rows):
    tables = M.build_warehouse(rows)
    clean = {(r.table_name, r.check_name): r.violations for r in quality.quality_report(tables).collect()}
    assert clean and set(clean.values()) == {0}

    fact = tables["fact_job_posting"]
    one = fact.limit(1)
    extra = one.withColumns({"company_id": F.lit("nobody"), "url": F.lit("again"), "job_type": F.lit("j" * 51)})
    broken = dict(
        tables,
        fact_job_posting=fact.unionByName(extra),
        dim_skill=tables["dim_skill"].where("skill_name <> 'sql'"),
        dim_company=tables["dim_company"].withColumn(
            "company_name", F.when(F.col("company_name") != "Unknown", F.col("company_name"))
        ),
    )
    found = {(r.table_name, r.check_name): r.violations for r in quality.quality_report(broken).collect()}
    with_sql = tables["bridge_job_skill"].join(tables["dim_skill"], "skill_id").where("skill_name = 'sql'").count()
    assert {k: v for k, v in found.items() if v} == {
        ("fact_job_posting", "job_type length"): 1,
        ("fact_job_posting", "job_posting_id unique"): 1,
        ("fact_job_posting", "source+external_id unique"): 1,
        ("fact_job_posting", "company_id in dim_company"): 1,
        ("bridge_job_skill", "skill_id in dim_skill"): with_sql,
        ("dim_company", "company_name not null"): 1,
    }


@pytest.mark.parametrize("name", sorted(quality.REQUIRED))
def test_one_scan_for_all_checks_of_a_table(spark, rows, tmp_path, name):
    path = f"{tmp_path}/{name}"
    M.build_warehouse(rows)[name].write.parquet(path)
    plan = plan_of(quality._checked(name, spark.read.parquet(path)))
    assert plan.count("FileScan") == 1
