"""Marts kept current by the signed difference of a load.

Every figure of the five marts follows from counts of postings by some key. The counts are kept beside a version of the
warehouse; a load adds what the postings of its run count for now and takes off what they counted for before. So it reads
the postings of the run and their stored rows, and nothing else of fact and bridge is counted again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import marts, merge

COLUMNS = ["kind", "a", "b", "n"]


def _key(kind: str, a: str | None = None, b: str | None = None) -> Column:
    parts = [F.lit(None) if c is None else F.col(c) for c in (a, b)]
    return F.struct(F.lit(kind).alias("kind"), *[p.cast("string").alias(name) for p, name in zip(parts, "ab", strict=True)])


def counts(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """(kind, a, b, n): postings by each key that a mart groups by. Groups combine in the map tasks."""
    of_posting = F.array(
        _key("posting"),
        _key("level", "seniority_level"),
        _key("place", "city_id", "source"),
        _key("company", "company_id"),
        _key("last seen", "date_last_seen"),
        F.when(F.col("work_mode") == "remote", _key("remote")),
    )
    of_pair = F.array(_key("skill", "skill_id"), _key("skill level", "skill_id", "seniority_level"))
    pairs = bridge.join(fact.select("job_posting_id", "seniority_level"), "job_posting_id")
    keys = fact.select(F.explode(of_posting).alias("key")).where("key IS NOT NULL").unionByName(pairs.select(F.explode(of_pair).alias("key")))
    return keys.groupBy("key.kind", "key.a", "key.b").agg(F.count(F.lit(1)).alias("n"))


def _sum(parts: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [part.select(*COLUMNS) for part in parts])
    return rows.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).where("n <> 0")


def difference(stored: dict[str, DataFrame], run: dict[str, DataFrame]) -> DataFrame:
    """(kind, a, b, n): what loading ``run`` adds to the counts; below zero where postings leave a group."""
    touched = run["fact_job_posting"].select("job_posting_id")
    before, pairs = (stored[t].join(touched, "job_posting_id", "left_semi") for t in ("fact_job_posting", "bridge_job_skill"))
    after = merge.merge_fact(before, run["fact_job_posting"])
    all_pairs = pairs.unionByName(run["bridge_job_skill"]).distinct()
    out = counts(before, pairs).withColumn("n", -F.col("n"))
    return _sum([out, counts(after, all_pairs)])


def advanced(state: DataFrame, change: DataFrame) -> DataFrame:
    return _sum([state, change])


def marts_of(state: DataFrame, dimensions: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five marts from the counts and the dimensions, like :func:`marts.all_marts` from the whole tables."""

    def of(kind: str, a: str, b: str | None = None, n: str = "n") -> DataFrame:
        named = [F.col("a").alias(a), *([F.col("b").alias(b)] if b else []), F.col("n").alias(n)]
        return state.where(F.col("kind") == kind).select(*named)

    skill = dimensions["dim_skill"]
    is_kind = lambda kind: F.col("kind") == kind
    number = lambda kind: F.coalesce(F.sum(F.when(is_kind(kind), F.col("n"))), F.lit(0))
    figures = state.agg(
        number("posting").alias("total_job_postings"),
        F.count_if(is_kind("company") & F.col("a").isNotNull()).alias("total_companies"),
        number("remote").alias("remote"),
        F.max(F.when(is_kind("last seen"), F.col("a"))).cast("date").alias("last_update"),
    )
    total = state.agg(number("posting")).scalar()
    return {
        "mart_skill_demand": marts.demand_of(of("skill", "skill_id"), total, skill),
        "mart_seniority_distribution": marts.levels_of(of("level", "seniority_level", n="job_count")),
        "mart_geography_demand": marts.places_of(of("place", "city_id", "source"), dimensions["dim_city"], dimensions["dim_country"]),
        "mart_skill_by_seniority": marts.skill_levels_of(of("skill level", "skill_id", "seniority_level"), skill),
        "mart_kpi_summary": marts.kpis_of(figures, skill),
    }
