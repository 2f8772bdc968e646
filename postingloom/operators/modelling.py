"""Relevant postings, folded postings and the dimensions they need."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import vocabulary as V
from ..functions.text import literal


@dataclass(frozen=True)
class ModelOptions:
    """Where the declarative variant of the load differs from the default."""

    country_name_mode: str = "name"        # "name": looked up; "code": the code itself
    trim_city: bool = True
    seed_all_skills: bool = False
    blank_company_is_unknown: bool = True
    #: Publication days as keys of the calendar, which then has them; without it the key stays NULL.
    publication_dates: bool = False
    #: The vocabulary of skills, each once, of any length.
    skills: tuple[str, ...] = tuple(V.SKILLS)


DEFAULT = ModelOptions()


def relevant_postings(staging_rows: DataFrame) -> DataFrame:
    return staging_rows.where(rules.is_relevant())


def _company(options: ModelOptions) -> Column:
    if options.blank_company_is_unknown:
        return rules.company_or_unknown()
    return F.coalesce("company_name", F.lit(V.UNKNOWN_COMPANY))


def _city(options: ModelOptions) -> Column:
    if options.trim_city:
        city = rules.city_name()
    else:
        located = F.col("country").isNotNull() & F.col("location").contains(",")
        city = F.when(located, rules.city_text_before_comma())
    return F.nullif(city, F.lit(""))


# What is kept of the first sighting. The long texts are apart so that whoever
# needs none of them does not shuffle them.
_FIRST = [
    "title", "company_name", "country", "location", "work_mode", "salary_min", "salary_max", "job_type", "run_date",
]
LONG_TEXTS = ["url", "description"]

#: All that the fold reads.
FOLDED = ["source", "external_id", "extracted_at", "ordinal", *_FIRST, *LONG_TEXTS, "publication_date"]


def fold(relevant: DataFrame, options: ModelOptions = DEFAULT) -> DataFrame:
    """One row per posting: the outcome of loading its sightings in order.

    Loading row by row keeps most attributes of the first sighting, takes title
    and last-seen date from the last, and adds up skills. First, last and union
    are associative, so one aggregation with map-side combine gives the same
    rows, and a posting seen very often is no burden for any task. Values
    travel in structs led by the order key: the least struct is the first
    sighting, and a NULL in it is kept as such. Sightings of equal order, as
    documents without ordinals can bring, are told apart by a hash of their
    content, so all that is kept of the first comes from one of them.

    Amounts, seniority and keys are worked out after the fold, once per posting.
    Keys are computed from natural keys, so no lookup join exists and a company
    or city that many postings share costs nothing.
    """
    masks = rules.mask_names(options.skills)
    kept = [*_FIRST, "publication_date"] if options.publication_dates else _FIRST
    folded = (
        with_skill_mask(relevant, skills=options.skills)
        .withColumn("ord", F.struct("extracted_at", "ordinal"))
        .withColumn("tie", F.xxhash64(*kept, *LONG_TEXTS))
        # Rows are sorted by what tells most of them apart first.
        .groupBy("external_id", "source")
        .agg(
            F.min(F.struct("ord", "tie", *kept)).alias("first"),
            F.min(F.struct("ord", "tie", *LONG_TEXTS)).alias("first_texts"),
            F.max(F.struct("ord", "tie", "title", "run_date")).alias("last"),
            *[F.bit_or(mask).alias(mask) for mask in masks],
            F.count(F.lit(1)).alias("sightings"),
        )
    )
    opened = folded.select(
        "source", "external_id", "first.*", *[f"first_texts.{c}" for c in LONG_TEXTS],
        F.col("last.ord").alias("last_ord"), F.col("last.title").alias("last_title"),
        F.col("last.run_date").alias("last_date"), *masks, "sightings",
    ).withColumns({"_company": _company(options), "_city": _city(options), "_code": rules.country_code()})
    return opened.select(
        rules.surrogate_key("source", "external_id").alias("job_posting_id"),
        "source",
        "external_id",
        F.col("last_title").alias("title"),
        rules.surrogate_key("_company").alias("company_id"),
        rules.surrogate_key("_city", "_code").alias("city_id"),
        "work_mode",
        rules.salary("salary_min").alias("salary_min"),
        rules.salary("salary_max").alias("salary_max"),
        "job_type",
        rules.seniority().alias("seniority_level"),
        (rules.publication_day() if options.publication_dates else F.lit(None).cast("date")).alias("publication_date_id"),
        F.col("run_date").alias("date_first_seen"),
        F.col("last_date").alias("date_last_seen"),
        *LONG_TEXTS,
        F.col("ord").alias("first_ord"),
        "last_ord",
        *masks,
        "sightings",
    )


def with_skill_mask(
    rows: DataFrame, title: str = "title", description: str = "description", skills: Sequence[str] = V.SKILLS
) -> DataFrame:
    """Add the columns of ``rules.mask_names``; the searched text is made once per row."""
    searched = rows.withColumn("_text", rules.searchable_text(title, description))
    return searched.withColumns(rules.skill_masks("_text", skills)).drop("_text")


def skill_rows(
    rows: DataFrame, *keep: str, title: str = "title", description: str = "description", positions: bool = False,
    skills: Sequence[str] = V.SKILLS,
) -> DataFrame:
    """One row per mentioned skill: columns ``keep`` and ``skill_name``; with
    ``positions`` also the place in the list of mentioned skills."""
    masked, names = with_skill_mask(rows, title, description, skills), rules.skills_in_mask(skills)
    if positions:
        return masked.select(*keep, F.posexplode(names).alias("position", "skill_name"))
    return masked.select(*keep, F.explode(names).alias("skill_name"))


def bridge_of(folded: DataFrame, skills: Sequence[str] = V.SKILLS) -> DataFrame:
    """(posting, skill) pairs. Unique as they stand: one row per posting goes
    in, and a mask names a skill once."""
    return folded.select("job_posting_id", F.explode(rules.skill_ids_in_mask(skills)).alias("skill_id"))


# ---- dimensions -----------------------------------------------------------
# Built from every relevant sighting, not from the folded rows: a company that
# appears only on a later sighting is in the dimension although no fact uses it.

def countries_of(relevant: DataFrame, options: ModelOptions = DEFAULT) -> DataFrame:
    codes = relevant.select(rules.country_code().alias("country_code")).where("country_code IS NOT NULL").distinct()
    name = F.col("country_code") if options.country_name_mode == "code" else rules.country_name()
    return codes.select(
        rules.surrogate_key("country_code").alias("country_id"), "country_code", name.alias("country_name")
    )


def cities_of(relevant: DataFrame, options: ModelOptions = DEFAULT) -> DataFrame:
    cities = (
        relevant.select(_city(options).alias("city_name"), rules.country_code().alias("country_code"))
        .where("city_name IS NOT NULL AND country_code IS NOT NULL")
        .distinct()
    )
    return cities.select(
        rules.surrogate_key("city_name", "country_code").alias("city_id"),
        "city_name",
        rules.surrogate_key("country_code").alias("country_id"),
    )


def companies_of(relevant: DataFrame, options: ModelOptions = DEFAULT) -> DataFrame:
    names = relevant.select(_company(options).alias("company_name")).distinct()
    return names.select(rules.surrogate_key("company_name").alias("company_id"), "company_name")


def skill_seed(spark: SparkSession, skills: Sequence[str] = V.SKILLS) -> DataFrame:
    """The whole vocabulary as a relation."""
    names = spark.sql(f"VALUES {', '.join(f'({literal(s)})' for s in skills)} AS vocabulary(skill_name)")
    return names.select(rules.surrogate_key("skill_name").alias("skill_id"), "skill_name")


def skills_of(relevant: DataFrame, options: ModelOptions = DEFAULT) -> DataFrame:
    """Skills that were detected at all.

    The masks are united first, in one row; names are only spelled out from
    that row.
    """
    if options.seed_all_skills:
        return skill_seed(relevant.sparkSession, options.skills)
    return skills_in(with_skill_mask(relevant, skills=options.skills), options.skills)


def skills_in(masks: DataFrame, skills: Sequence[str] = V.SKILLS) -> DataFrame:
    """Skill rows for all bits that occur in the mask columns."""
    united = masks.agg(*[F.bit_or(mask).alias(mask) for mask in rules.mask_names(skills)])
    names = united.select(F.explode(rules.skills_in_mask(skills)).alias("skill_name"))
    return names.select(rules.surrogate_key("skill_name").alias("skill_id"), "skill_name")


def dates_of(staging_rows: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """Calendar rows of the run days. A run without postings of interest has
    its day in the calendar all the same. ``published`` are postings whose publication days are in it too."""
    days = staging_rows.select("run_date")
    if published is not None:
        days = days.union(published.select(rules.publication_day()))
    days = days.where("run_date IS NOT NULL").distinct()
    return days.select(*rules.calendar_fields("run_date"))


# ---- a whole warehouse at once --------------------------------------------

#: What dimensions are made from.
DIMENSION_SOURCES = ["company_name", "country", "location"]


def dimension_sources(options: ModelOptions) -> list[str]:
    return [*DIMENSION_SOURCES, "publication_date"] if options.publication_dates else DIMENSION_SOURCES


def build_warehouse(
    staging_rows: DataFrame,
    options: ModelOptions = DEFAULT,
    folded: DataFrame | None = None,
    relevant: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All warehouse tables from all given rows, lazily.

    ``folded`` is the fold of the same rows if it is stored somewhere; fact,
    bridge and skills are then read from it. ``relevant`` likewise has their
    ``dimension_sources``. The calendar is made from all rows.
    """
    if relevant is None:
        relevant = relevant_postings(staging_rows)
    if folded is None:
        folded, skills = fold(relevant, options), skills_of(relevant, options)
    else:
        skills = (
            skill_seed(relevant.sparkSession, options.skills) if options.seed_all_skills else skills_in(folded, options.skills)
        )
    return {
        "dim_country": countries_of(relevant, options),
        "dim_city": cities_of(relevant, options),
        "dim_company": companies_of(relevant, options),
        "dim_skill": skills,
        "dim_date": dates_of(staging_rows, relevant if options.publication_dates else None),
        "fact_job_posting": folded.drop(*rules.mask_names(options.skills), "sightings"),
        "bridge_job_skill": bridge_of(folded, options.skills),
    }
