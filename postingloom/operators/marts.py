"""The five marts and the top-skills chart, as functions of warehouse tables.

Facts are aggregated before they meet a dimension, so only group rows are
joined, and a group that holds most of the facts is reduced in the map tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import vocabulary as V


def _rows_in(table: DataFrame) -> Column:
    return table.agg(F.count(F.lit(1))).scalar()


def skill_demand(fact: DataFrame, bridge: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """Postings per skill and their share of all postings.

    A bridge pair is unique, so counting pairs counts distinct postings and the
    bridge is not shuffled. Shares add up to more than 100.
    """
    return demand_of(bridge.groupBy("skill_id").agg(F.count(F.lit(1)).alias("n")), _rows_in(fact), dim_skill)


def demand_of(per_skill: DataFrame, total: Column, dim_skill: DataFrame) -> DataFrame:
    """The mart from (skill_id, n)."""
    # skill_id and skill_name are both unique; grouping again costs a few rows
    # and holds even if a name should ever carry two ids.
    counted = (
        per_skill.join(dim_skill, "skill_id")
        .groupBy("skill_name")
        .agg(F.sum("n").alias("job_count"))
        .withColumn("total", total)
    )
    return counted.select(
        "skill_name", "job_count", rules.percent_of("job_count", "total").alias("pct_du_total")
    ).orderBy(F.desc("job_count"), "skill_name")


def top_skills(demand: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of the skill chart."""
    return demand.orderBy(F.desc("job_count"), "skill_name").limit(k)


def seniority_distribution(fact: DataFrame) -> DataFrame:
    """Postings per seniority level; the window runs over the group rows only."""
    return levels_of(fact.groupBy("seniority_level").agg(F.count(F.lit(1)).alias("job_count")))


def levels_of(counted: DataFrame) -> DataFrame:
    """The mart from (seniority_level, job_count)."""
    total = F.sum("job_count").over(Window.partitionBy())
    return (
        counted.withColumn("total", total)
        .select(
            "seniority_level",
            "job_count",
            rules.percent_of("job_count", "total").alias("pct_du_total"),
        )
        .orderBy(F.desc("job_count"), "seniority_level")
    )


def geography_demand(fact: DataFrame, dim_city: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Postings per country, city and feed.

    A posting reaches its country through its city, so one without a city has
    no country either. Groups are formed on the stored names; labels for
    missing ones are put on afterwards.
    """
    return places_of(fact.groupBy("city_id", "source").agg(F.count(F.lit(1)).alias("n")), dim_city, dim_country)


def places_of(per_city: DataFrame, dim_city: DataFrame, dim_country: DataFrame) -> DataFrame:
    """The mart from (city_id, source, n)."""
    named = per_city.join(dim_city, "city_id", "left").join(dim_country, "country_id", "left")
    counted = named.groupBy("country_name", "city_name", "source").agg(F.sum("n").alias("job_count"))
    return counted.select(
        F.substring(F.coalesce("country_name", F.lit(V.NO_COUNTRY_LABEL)), 1, 100).alias("country_name"),
        F.substring(F.coalesce("city_name", F.lit(V.NO_CITY_LABEL)), 1, 200).alias("city_name"),
        "source",
        "job_count",
    ).orderBy(F.desc("job_count"), "country_name", "city_name", "source")


def skill_by_seniority(fact: DataFrame, bridge: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """Postings per skill and seniority level.

    Bridge and fact meet on the posting key, on which the stored tables are
    bucketed; the skill names join the group rows.
    """
    pairs = bridge.join(fact.select("job_posting_id", "seniority_level"), "job_posting_id")
    return skill_levels_of(pairs.groupBy("skill_id", "seniority_level").agg(F.count(F.lit(1)).alias("n")), dim_skill)


def skill_levels_of(per_group: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """The mart from (skill_id, seniority_level, n)."""
    return (
        per_group.join(dim_skill, "skill_id")
        .groupBy("skill_name", "seniority_level")
        .agg(F.sum("n").alias("job_count"))
        .orderBy("skill_name", F.desc("job_count"), "seniority_level")
    )


def kpi_summary(fact: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """One row of headline figures, also for an empty warehouse.

    Companies are counted from the facts, skills from their dimension.
    """
    figures = fact.agg(
        F.count(F.lit(1)).alias("total_job_postings"),
        F.count_distinct("company_id").alias("total_companies"),
        F.count_if(F.col("work_mode") == "remote").alias("remote"),
        F.max("date_last_seen").alias("last_update"),
    )
    return kpis_of(figures, dim_skill)


def kpis_of(figures: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """The mart from one row (total_job_postings, total_companies, remote, last_update)."""
    figures = figures.withColumn("total_skills", _rows_in(dim_skill))
    return figures.select(
        "total_job_postings",
        "total_companies",
        rules.percent_of("remote", "total_job_postings").alias("pct_remote"),
        "total_skills",
        "last_update",
    )


def all_marts(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    fact, bridge, skill = tables["fact_job_posting"], tables["bridge_job_skill"], tables["dim_skill"]
    return {
        "mart_skill_demand": skill_demand(fact, bridge, skill),
        "mart_seniority_distribution": seniority_distribution(fact),
        "mart_geography_demand": geography_demand(fact, tables["dim_city"], tables["dim_country"]),
        "mart_skill_by_seniority": skill_by_seniority(fact, bridge, skill),
        "mart_kpi_summary": kpi_summary(fact, skill),
    }


def create_views(tables: dict[str, DataFrame]) -> list[str]:
    """Register tables and marts as temporary views for SQL users."""
    frames = {**tables, **all_marts(tables)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
