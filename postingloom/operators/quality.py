"""Constraints of the warehouse, checked by jobs instead of by a storage engine.

Rows that could not be stored are set aside before the load; the finished
tables are reported on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..session import written

# Text limits of staging columns, and of warehouse columns filled from them. Fixed values.
STAGING_LIMITS = {"source": 20, "external_id": 100, "country": 10, "work_mode": 20, "job_type": 50, "company_name": 255}
CITY_LIMIT = 200

# Limits and keys of the warehouse. Fixed values.
LIMITS = {
    "dim_country": {"country_code": 10, "country_name": 100},
    "dim_city": {"city_name": 200},
    "dim_company": {"company_name": 255},
    "dim_skill": {"skill_name": 100},
    "dim_date": {"day_name": 20},
    "fact_job_posting": {
        "source": 20, "external_id": 100, "work_mode": 20, "job_type": 50, "seniority_level": 20,
    },
}

REQUIRED = {
    "dim_country": ["country_id"],
    "dim_city": ["city_id"],
    "dim_company": ["company_id", "company_name"],
    "dim_skill": ["skill_id", "skill_name"],
    "dim_date": ["date_id", "year", "month", "day", "week_of_year", "day_name"],
    "fact_job_posting": ["job_posting_id", "source", "external_id", "title", "date_first_seen", "date_last_seen"],
    "bridge_job_skill": ["job_posting_id", "skill_id"],
}

UNIQUE = {
    "dim_country": [["country_id"], ["country_code"]],
    "dim_city": [["city_id"], ["city_name", "country_id"]],
    "dim_company": [["company_id"], ["company_name"]],
    "dim_skill": [["skill_id"], ["skill_name"]],
    "dim_date": [["date_id"]],
    "fact_job_posting": [["job_posting_id"], ["source", "external_id"]],
    "bridge_job_skill": [["job_posting_id", "skill_id"]],
}

# (table, column, referenced table, referenced column)
REFERENCES = [
    ("dim_city", "country_id", "dim_country", "country_id"),
    ("fact_job_posting", "company_id", "dim_company", "company_id"),
    ("fact_job_posting", "city_id", "dim_city", "city_id"),
    ("fact_job_posting", "publication_date_id", "dim_date", "date_id"),
    ("bridge_job_skill", "job_posting_id", "fact_job_posting", "job_posting_id"),
    ("bridge_job_skill", "skill_id", "dim_skill", "skill_id"),
]


# ---- before the load ------------------------------------------------------

def _problems() -> tuple[dict[str, Column], dict[str, Column]]:
    """Tests by reason: for every row, and for relevant rows only. A warehouse
    limit concerns the latter; the others are never stored there."""
    always = {
        "source missing": F.col("source").isNull(),
        "external_id missing": F.col("external_id").isNull(),
    }
    when_relevant = {}
    for column, limit in STAGING_LIMITS.items():
        tests = when_relevant if column in ("job_type", "company_name") else always
        tests[f"{column} too long"] = F.coalesce(F.length(column) > limit, F.lit(False))
    when_relevant["city too long"] = F.coalesce(F.length(rules.city_name()) > CITY_LIMIT, F.lit(False))
    return always, when_relevant


def _rejected() -> Column:
    """True where a staging row cannot be stored; never NULL."""
    always, when_relevant = (reduce(Column.__or__, tests.values()) for tests in _problems())
    return always | (when_relevant & rules.is_relevant())


def outcome() -> Column:
    """What a load makes of a staging row: quarantined, relevant or skipped."""
    return F.when(_rejected(), "quarantined").when(rules.is_relevant(), "relevant").otherwise("skipped")


def outcome_totals() -> list[Column]:
    """Rows per value of a column ``outcome``."""
    return [F.count_if(F.col("outcome") == name).alias(name) for name in ("relevant", "skipped", "quarantined")]


def outcome_counts(staging_rows: DataFrame) -> DataFrame:
    return staging_rows.select(outcome().alias("outcome")).agg(*outcome_totals())


def accepted(staging_rows: DataFrame) -> DataFrame:
    return staging_rows.where(~_rejected())


def quarantined(staging_rows: DataFrame) -> DataFrame:
    """The rows that are set aside, each with its ``reason``.

    Reasons are spelled out for these rows only.
    """
    always, when_relevant = _problems()
    relevant = rules.is_relevant()
    reasons = [F.when(test, reason) for reason, test in always.items()]
    reasons += [F.when(relevant & test, reason) for reason, test in when_relevant.items()]
    return staging_rows.where(_rejected()).withColumn("reason", F.concat_ws(", ", *reasons))


def malformed_salaries(staging_rows: DataFrame) -> DataFrame:
    """Salary texts that are given but unreadable; the amount is stored as NULL."""
    bounds = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("salary_min", "salary_max")]
    )
    texts = staging_rows.select("source", "external_id", "ordinal", F.explode(bounds).alias("s"))
    return texts.select("source", "external_id", "ordinal", "s.field", "s.text").where(
        rules.salary_is_malformed("text")
    )


# ---- after the load -------------------------------------------------------

def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, check_name, violations``, one row per constraint.

    Each table is read once for all its checks: what is checked of a row becomes a few (check, key) pairs, which are counted in
    one aggregate and stored. Uniqueness is told from the counts, references by joining the values of one
    table with the keys of another."""
    seen = {name: written(_checked(name, table), f"checks-{name}") for name, table in tables.items()}
    parts = [_table_checks(name, pairs) for name, pairs in seen.items()]
    parts += [_reference_check(child, seen[child], column, parent, seen[parent], key) for child, column, parent, key in REFERENCES]
    return reduce(DataFrame.unionByName, parts)


def _column_tests(name: str) -> dict[str, Column]:
    tests = {f"{c} not null": F.col(c).isNull() for c in REQUIRED[name]}
    return tests | {f"{c} length": F.length(c) > n for c, n in LIMITS.get(name, {}).items()}


def _keys(name: str) -> dict[str, list[str]]:
    """Columns whose values are counted: keys, and references to other tables."""
    counted = [*UNIQUE[name], *[[column] for child, column, _, _ in REFERENCES if child == name]]
    return {"+".join(key): key for key in counted}


def _checked(name: str, table: DataFrame) -> DataFrame:
    """(check, key, n): rows with each value of each key, and rows that fail a test of their columns, under an empty key.

    Keys with a NULL are left out: NULLs are no duplicates of each other, and a missing reference is none."""
    pairs = []
    for check, key in _keys(name).items():
        complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
        values = F.array(*[F.col(c).cast("string") for c in key])
        pairs.append(F.when(complete, F.struct(F.lit(check).alias("check"), values.alias("key"))))
    nothing = F.array().cast("array<string>")
    for check, fails in _column_tests(name).items():
        pairs.append(F.when(fails, F.struct(F.lit(check).alias("check"), nothing.alias("key"))))
    found = table.select(F.explode(F.array(*pairs)).alias("pair")).where("pair IS NOT NULL")
    return found.groupBy("pair.check", "pair.key").agg(F.count(F.lit(1)).alias("n"))


def _table_checks(name: str, pairs: DataFrame) -> DataFrame:
    """Violations of the column tests, and keys that occur more than once."""
    checks = [F.coalesce(F.sum(F.when(F.col("check") == test, F.col("n"))), F.lit(0)).alias(test) for test in _column_tests(name)]
    for key in UNIQUE[name]:
        check = "+".join(key)
        checks.append(F.count_if((F.col("check") == check) & (F.col("n") > 1)).alias(f"{check} unique"))
    counted = pairs.agg(*checks)
    return counted.unpivot([], counted.columns, "check_name", "violations").select(
        F.lit(name).alias("table_name"), "check_name", "violations"
    )


def _reference_check(child_name: str, child: DataFrame, column: str, parent_name: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose reference leads nowhere. A value that many rows share is joined once."""
    dangling = child.where(F.col("check") == column).join(parent.where(F.col("check") == key).select("key"), "key", "left_anti")
    return dangling.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(child_name).alias("table_name"),
        F.lit(f"{column} in {parent_name}").alias("check_name"),
        "violations",
    )
