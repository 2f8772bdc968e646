"""The join-based variant of the load.

The default load computes keys and cuts the vocabulary into expressions. Here
dimensions are tables to be joined, and the skill vocabulary is data.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import vocabulary as V
from ..session import written
from . import modelling as M
from .heavy import join_unique
from .mentions import skill_pairs

TABLES = ("dim_country", "dim_city", "dim_company", "dim_skill", "fact_job_posting", "bridge_job_skill")

OPTIONS = M.ModelOptions(
    country_name_mode="code", trim_city=False, seed_all_skills=True, blank_company_is_unknown=False
)


#: What dimensions and keys are made from.
NARROW = ["source", "external_id", "extracted_at", "ordinal", "company_name", "country", "location"]


def cities_by_join(relevant: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Cities with their parent taken from the country dimension."""
    parts = (
        relevant.where(F.col("location").contains(","))
        .select(
            rules.city_text_before_comma().alias("city_name"),
            rules.country_code().alias("country_code"),
        )
        .distinct()
    )
    named = parts.join(dim_country, "country_code")
    return named.select(
        rules.surrogate_key("city_name", "country_code").alias("city_id"), "city_name", "country_id"
    )


def first_sightings(relevant: DataFrame) -> DataFrame:
    """(source, external_id, company_name, country_code, city_name) of each posting's first sighting.

    There is no comma guard on the city here: "Paris" finds an existing "Paris" of the same country."""
    names = relevant.select(
        "source",
        "external_id",
        F.struct("extracted_at", "ordinal").alias("ord"),
        F.coalesce("company_name", F.lit(V.UNKNOWN_COMPANY)).alias("company_name"),
        rules.country_code().alias("country_code"),
        rules.city_text_before_comma().alias("city_name"),
    )
    return names.groupBy("source", "external_id").agg(
        F.min_by(F.struct("company_name", "country_code", "city_name"), F.col("ord")).alias("f")
    ).select("source", "external_id", "f.*")


def fact_keys_by_join(first: DataFrame, dim_company: DataFrame, dim_country: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Company and city key of every posting, looked up in the dimensions.

    ``first`` is stored. Companies and cities that many postings share are split off
    (:mod:`.heavy`), and so are postings without a country, which can have no city."""
    cities = dim_city.join(dim_country.select("country_id", "country_code"), "country_id").select("city_name", "country_code", "city_id")
    employed = join_unique(first, dim_company, ["company_name"])
    return join_unique(employed, cities, ["city_name", "country_code"], "left", counted=first).select(
        "source", "external_id", "company_id", "city_id"
    )


def bridge_by_join(relevant: DataFrame, fact: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """Bridge pairs with both keys looked up."""
    pairs = skill_pairs(relevant, dim_skill)
    keyed = pairs.join(fact.select("source", "external_id", "job_posting_id"), ["source", "external_id"])
    return keyed.join(dim_skill, "skill_name").select("job_posting_id", "skill_id")


def build_declarative(staging_rows: DataFrame, tables: Collection[str] = TABLES) -> dict[str, DataFrame]:
    """Warehouse tables of one run by the join-based variant, those in ``tables``.

    The relevant rows are worked out once and stored, with the columns that the tables need; all tables are made from these."""
    columns = {"fact_job_posting": M.FOLDED, "bridge_job_skill": [*NARROW, "title", "description"]}
    wanted = {c for name in tables for c in columns.get(name, NARROW)}
    relevant = written(
        M.relevant_postings(staging_rows).select(*[c for c in staging_rows.columns if c in wanted]), "declarative-relevant"
    )
    dim_country = M.countries_of(relevant, OPTIONS)
    dim_city = cities_by_join(relevant, dim_country)
    dim_company = M.companies_of(relevant, OPTIONS)
    built = {
        "dim_country": dim_country,
        "dim_city": dim_city,
        "dim_company": dim_company,
        "dim_skill": M.skill_seed(staging_rows.sparkSession, OPTIONS.skills),
    }
    if "fact_job_posting" in tables:
        first = written(first_sightings(relevant), "declarative-first")
        keys = fact_keys_by_join(first, dim_company, dim_country, dim_city)
        folded = M.fold(relevant, OPTIONS).drop("company_id", "city_id", *rules.mask_names(OPTIONS.skills), "sightings")
        built["fact_job_posting"] = folded.join(keys, ["source", "external_id"])
    if "bridge_job_skill" in tables:
        keyed = relevant.select("source", "external_id").distinct().withColumn(
            "job_posting_id", rules.surrogate_key("source", "external_id")
        )
        built["bridge_job_skill"] = bridge_by_join(relevant, keyed, built["dim_skill"])
    return {name: table for name, table in built.items() if name in tables}
