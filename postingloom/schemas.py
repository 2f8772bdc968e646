"""Explicit schemas; nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _S) for n in names]


# Numbers in a feed (ids, salaries) are read as text, which is how they are kept.
SOURCE_A_JOB = T.StructType(
    _strings("id", "title", "company_name", "candidate_required_location", "job_type",
             "publication_date", "description", "url")
    + [T.StructField("tags", T.ArrayType(_S))]
)

SOURCE_B_JOB = T.StructType(
    _strings("id", "title", "description")
    + [
        T.StructField("company", T.StructType(_strings("display_name"))),
        T.StructField("location", T.StructType(_strings("display_name"))),
    ]
    + _strings("salary_min", "salary_max", "contract_time", "created", "redirect_url")
)

# One landed response. ``page`` is written by whoever lands it; a response
# without one is page 0.
SOURCE_A_RESPONSE = T.StructType(
    [T.StructField("page", T.LongType()), T.StructField("jobs", T.ArrayType(SOURCE_A_JOB))]
)
SOURCE_B_RESPONSE = T.StructType(
    [T.StructField("page", T.LongType()), T.StructField("results", T.ArrayType(SOURCE_B_JOB))]
)

POSTING = T.StructType(
    _strings("source", "external_id", "title", "company_name", "location", "country",
             "work_mode", "salary_min", "salary_max", "job_type", "publication_date",
             "description", "url")
    + [T.StructField("tags", T.ArrayType(_S))]
)
POSTING_COLUMNS = POSTING.fieldNames()

# A raw-zone document. ``ordinal`` is optional inside a posting: documents
# written elsewhere have none and take the position in the array instead.
PAYLOAD = T.StructType(
    [
        T.StructField("extracted_at", _S),
        T.StructField("sources", T.ArrayType(_S)),
        T.StructField("job_count", T.LongType()),
        T.StructField("job_count_by_source", T.MapType(_S, T.LongType())),
        T.StructField(
            "jobs", T.ArrayType(T.StructType(POSTING.fields + [T.StructField("ordinal", T.LongType())]))
        ),
    ]
)

STAGING = T.StructType(
    POSTING.fields
    + [
        T.StructField("extracted_at", _S),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("run_key", _S),
    ]
)

DIM_COUNTRY = T.StructType(_strings("country_id", "country_code", "country_name"))
DIM_CITY = T.StructType(_strings("city_id", "city_name", "country_id"))
DIM_COMPANY = T.StructType(_strings("company_id", "company_name"))
DIM_SKILL = T.StructType(_strings("skill_id", "skill_name"))
DIM_DATE = T.StructType(
    [T.StructField("date_id", T.DateType())]
    + [T.StructField(n, T.IntegerType()) for n in ("year", "month", "day", "week_of_year")]
    + _strings("day_name")
)

_ORD = T.StructType([T.StructField("extracted_at", _S), T.StructField("ordinal", T.LongType())])

# The 16 public columns of the fact, then the two order keys that let a later
# run be folded in.
FACT = T.StructType(
    _strings("job_posting_id", "source", "external_id", "title", "company_id", "city_id", "work_mode")
    + [T.StructField("salary_min", T.DecimalType(10, 2)), T.StructField("salary_max", T.DecimalType(10, 2))]
    + _strings("job_type", "seniority_level")
    + [T.StructField(n, T.DateType()) for n in ("publication_date_id", "date_first_seen", "date_last_seen")]
    + _strings("url", "description")
    + [T.StructField("first_ord", _ORD), T.StructField("last_ord", _ORD)]
)
FACT_COLUMNS = [n for n in FACT.fieldNames() if n not in ("first_ord", "last_ord")]

BRIDGE = T.StructType(_strings("job_posting_id", "skill_id"))

WAREHOUSE = {
    "dim_country": DIM_COUNTRY,
    "dim_city": DIM_CITY,
    "dim_company": DIM_COMPANY,
    "dim_skill": DIM_SKILL,
    "dim_date": DIM_DATE,
    "fact_job_posting": FACT,
    "bridge_job_skill": BRIDGE,
}
