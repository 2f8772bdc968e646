"""DuckDB SQL that states independently what each registered query returns.

The load is written the way a database would do it: first and last sighting by
``row_number``, distinct pairs for the bridge, lookups by join. Word lists and
sample texts are the same fixed values; nothing else is shared.
"""

from __future__ import annotations

from ..functions import vocabulary as V
from ..sources import order_postings as OP


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _any(expression: str, words) -> str:
    return "(" + " OR ".join(f"contains({expression}, {_text(w)})" for w in words) + ")"


def key(*parts: str) -> str:
    return "substr(sha256(" + " || chr(0) || ".join(parts) + "), 1, 32)"


def percent(part: str, total: str) -> str:
    return f"CAST((2000 * {part} + {total}) // (2 * nullif({total}, 0)) AS DOUBLE) / 10"


def work_mode(text: str) -> str:
    return (
        f"CASE WHEN {_any(text, V.ON_SITE_WORDS)} THEN 'on_site' WHEN {_any(text, V.HYBRID_WORDS)} THEN 'hybrid' "
        f"WHEN {_any(text, V.REMOTE_WORDS)} THEN 'remote' ELSE 'unknown' END"
    )


TITLE = "lower(coalesce(title, ''))"
BOTH = "lower(coalesce(title, '') || ' ' || coalesce(description, ''))"
RELEVANT = f"({_any(TITLE, V.ROLE_WORDS)} AND NOT {_any(TITLE, V.OFF_TOPIC_WORDS)})"
SENIORITY = (
    f"CASE WHEN {_any(TITLE, V.SENIOR_WORDS)} THEN 'senior' "
    f"WHEN {_any(TITLE, V.JUNIOR_WORDS)} THEN 'junior' ELSE 'unknown' END"
)
COMPANY = f"coalesce(nullif(company_name, ''), {_text(V.UNKNOWN_COMPANY)})"
CODE = "upper(nullif(country, ''))"
CITY = "CASE WHEN nullif(country, '') IS NOT NULL AND contains(location, ',') THEN trim(split_part(location, ',', 1)) END"
COUNTRY_NAME = (
    "CASE lower({0}) " + " ".join(f"WHEN {_text(c)} THEN {_text(n)}" for c, n in V.COUNTRY_NAMES.items())
    + " ELSE upper({0}) END"
)


def salary(text: str) -> str:
    return f"try_cast(nullif(nullif({text}, 'None'), '') AS DECIMAL(10, 2))"


SKILL_ROWS = "(VALUES " + ", ".join(f"({i}, {_text(s)})" for i, s in enumerate(V.SKILLS)) + ") AS vocab(position, skill_name)"

# ---- building blocks ------------------------------------------------------

POSTINGS = f"""
sightings AS (
  SELECT o_orderkey AS n, o_orderkey % 4 AS r, o_orderkey // 4 AS p,
         CAST(o_totalprice AS DECIMAL(12, 2)) AS price, o_orderdate, o_orderstatus,
         c_custkey, c_name, n_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
bare AS (
  SELECT n AS ordinal, CASE WHEN p % 4 = 0 THEN '{V.SOURCE_A}' ELSE '{V.SOURCE_B}' END AS source,
    CAST(p AS VARCHAR) AS external_id,
    {_list(OP.TITLES)}[1 + (p * 3 + CASE WHEN p % 6 = 0 THEN r ELSE 0 END) % {len(OP.TITLES)}] AS title,
    {_list(OP.DESCRIPTIONS)}[1 + (p * 5 + r) % {len(OP.DESCRIPTIONS)}] AS description,
    CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 20 = 1 THEN '' ELSE c_name END AS company_name,
    CASE WHEN p % 4 = 0 THEN 'Worldwide' WHEN p % 5 = 0 THEN 'City' || (p % 40) || ', Region'
         WHEN p % 5 = 1 THEN '  City' || (p % 40) || ' , Region, X' WHEN p % 5 = 2 THEN 'City' || (p % 8 * 5)
         WHEN p % 5 = 3 THEN ', Region' END AS location,
    CASE WHEN p % 4 = 0 THEN NULL WHEN n_nationkey = 24 THEN 'us'
         ELSE {_list(V.SOURCE_B_COUNTRIES)}[1 + n_nationkey % {len(V.SOURCE_B_COUNTRIES)}] END AS country,
    CASE n % 7 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '0'
         ELSE CAST(price AS VARCHAR) END AS salary_min,
    CASE (n + 3) % 7 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'negotiable'
         WHEN 4 THEN CAST(price AS VARCHAR) || '5' ELSE CAST(price * 2 AS VARCHAR) END AS salary_max,
    CASE n % 3 WHEN 0 THEN 'full_time' WHEN 1 THEN 'part_time' END AS job_type,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS publication_date,
    'https://jobs.example.org/' || p AS url,
    CASE WHEN p % 4 = 0 THEN '["data","' || o_orderstatus || '"]' ELSE '[]' END AS tags,
    CASE WHEN r < 2 THEN '{OP.RUN_TIMES[0]}' WHEN r = 2 THEN '{OP.RUN_TIMES[1]}' ELSE '{OP.RUN_TIMES[2]}' END AS extracted_at
  FROM sightings
),
postings AS (
  SELECT *, {work_mode(BOTH)} AS work_mode, CAST(substr(extracted_at, 1, 10) AS DATE) AS run_date FROM bare
)"""


def relevant(source: str = "postings") -> str:
    return f"relevant AS (SELECT * FROM {source} WHERE {RELEVANT})"


def model(source: str = "postings") -> str:
    """Fact and bridge from all rows of ``source``."""
    return f"""
{relevant(source)},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, external_id ORDER BY extracted_at, ordinal) AS up,
         row_number() OVER (PARTITION BY source, external_id ORDER BY extracted_at DESC, ordinal DESC) AS down
  FROM relevant
),
fact AS (
  SELECT {key('f.source', 'f.external_id')} AS job_posting_id, f.source, f.external_id, l.title,
    {key(COMPANY.replace('company_name', 'f.company_name'))} AS company_id,
    {key("nullif(f.city_name, '')", 'f.country_code')} AS city_id,
    f.work_mode, f.salary_min, f.salary_max, f.job_type, f.seniority_level,
    CAST(NULL AS DATE) AS publication_date_id, f.run_date AS date_first_seen, l.run_date AS date_last_seen,
    f.url, f.description
  FROM (SELECT source, external_id, company_name, {CITY} AS city_name, {CODE} AS country_code, work_mode,
               CAST({salary('salary_min')} AS DOUBLE) AS salary_min, CAST({salary('salary_max')} AS DOUBLE) AS salary_max,
               job_type, {SENIORITY} AS seniority_level, run_date, url, description
        FROM ranked WHERE up = 1) f
  JOIN (SELECT source, external_id, title, run_date FROM ranked WHERE down = 1) l
    ON f.source = l.source AND f.external_id = l.external_id
),
pairs AS (
  SELECT DISTINCT source, external_id, skill_name
  FROM relevant JOIN {SKILL_ROWS} ON contains({BOTH}, skill_name)
),
bridge AS (
  SELECT {key('source', 'external_id')} AS job_posting_id, {key('skill_name')} AS skill_id, skill_name FROM pairs
),
dim_country AS (
  SELECT DISTINCT {key(CODE)} AS country_id, {CODE} AS country_code, {COUNTRY_NAME.format(CODE)} AS country_name
  FROM relevant WHERE {CODE} IS NOT NULL
),
dim_city AS (
  SELECT DISTINCT {key('city_name', 'code')} AS city_id, city_name, {key('code')} AS country_id
  FROM (SELECT nullif({CITY}, '') AS city_name, {CODE} AS code FROM relevant)
  WHERE city_name IS NOT NULL AND code IS NOT NULL
),
dim_company AS (SELECT DISTINCT {key(COMPANY)} AS company_id, {COMPANY} AS company_name FROM relevant),
dim_skill AS (SELECT DISTINCT skill_id, skill_name FROM bridge)"""


MARTS = {
    "mart_skill_demand": f"""
SELECT skill_name, CAST(c AS BIGINT) AS job_count, {percent('c', 't')} AS pct_du_total
FROM (SELECT skill_name, count(DISTINCT job_posting_id) AS c FROM bridge GROUP BY skill_name),
     (SELECT count(*) AS t FROM fact)""",
    "mart_seniority_distribution": f"""
SELECT seniority_level, CAST(c AS BIGINT) AS job_count, {percent('c', 't')} AS pct_du_total
FROM (SELECT seniority_level, count(*) AS c FROM fact GROUP BY seniority_level), (SELECT count(*) AS t FROM fact)""",
    "mart_geography_demand": f"""
SELECT substr(coalesce(co, '{V.NO_COUNTRY_LABEL}'), 1, 100) AS country_name,
       substr(coalesce(ci, '{V.NO_CITY_LABEL}'), 1, 200) AS city_name, source, CAST(c AS BIGINT) AS job_count
FROM (SELECT country_name AS co, city_name AS ci, source, count(*) AS c
      FROM fact LEFT JOIN dim_city USING (city_id) LEFT JOIN dim_country USING (country_id)
      GROUP BY country_name, city_name, source)""",
    "mart_skill_by_seniority": """
SELECT skill_name, seniority_level, count(*) AS job_count
FROM bridge JOIN fact USING (job_posting_id) GROUP BY skill_name, seniority_level""",
    "mart_kpi_summary": f"""
SELECT t AS total_job_postings, companies AS total_companies, {percent('remote', 't')} AS pct_remote,
       (SELECT count(*) FROM dim_skill) AS total_skills, last_update
FROM (SELECT count(*) AS t, count(DISTINCT company_id) AS companies,
             count(*) FILTER (WHERE work_mode = 'remote') AS remote, max(date_last_seen) AS last_update FROM fact)""",
}

FACT_SELECT = "SELECT * FROM fact"
BRIDGE_SELECT = "SELECT job_posting_id, skill_id FROM bridge"

LATEST = "latest AS (SELECT * FROM postings WHERE extracted_at = (SELECT max(extracted_at) FROM postings))"

POSTING_FIELDS = (
    "source, external_id, title, company_name, location, country, work_mode, salary_min, salary_max, "
    "job_type, publication_date, description, url, tags"
)

# ---- feeds ----------------------------------------------------------------
# The same sightings as jobs of the two feeds; a job's id is missing on every
# 101st order.

_TERMS_A, _TERMS_B = len(V.SOURCE_A_TERMS), len(V.SOURCE_B_TERMS)
_RANK = f"coalesce(nullif(list_position({_list(V.SOURCE_B_COUNTRIES)}, country), 0), {len(V.SOURCE_B_COUNTRIES) + 1})"

FEEDS = f"""
feed AS (
  SELECT * REPLACE (CASE WHEN ordinal % 101 <> 0 THEN external_id END AS external_id,
                    CASE WHEN source = '{V.SOURCE_A}' THEN NULL ELSE salary_min END AS salary_min,
                    CASE WHEN source = '{V.SOURCE_A}' THEN NULL ELSE salary_max END AS salary_max,
                    coalesce(title, '') AS title, coalesce(description, '') AS description),
    ordinal // 1000 AS page, ordinal % 1000 AS pos,
    CASE WHEN source = '{V.SOURCE_A}' THEN ordinal % {_TERMS_A} ELSE ordinal % {_TERMS_B} END AS term
  FROM postings
),
feed_ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY extracted_at, source, external_id
      ORDER BY CASE WHEN source = '{V.SOURCE_A}' THEN 0 ELSE {_RANK} END DESC, coalesce(country, '') DESC,
               term DESC, page DESC, pos DESC) AS down,
    count(*) OVER (PARTITION BY extracted_at, source, external_id) AS seen
  FROM feed WHERE external_id IS NOT NULL
),
merged AS (
  SELECT *, CASE WHEN source = '{V.SOURCE_A}' THEN 1 ELSE seen END AS copies
  FROM feed_ranked
  WHERE down = 1 AND (source = '{V.SOURCE_B}' OR NOT {_any(TITLE, V.NOISE_WORDS)})
)"""


def _with(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n"


def _on_postings(select: str, *blocks: str) -> str:
    return _with(POSTINGS, *blocks) + select.strip()


def _on_feeds(select: str, *blocks: str) -> str:
    return _with(POSTINGS, FEEDS, *blocks) + select.strip()


# ---- declarative variant --------------------------------------------------

_D_COMPANY = f"coalesce(company_name, {_text(V.UNKNOWN_COMPANY)})"
DECLARATIVE = f"""
{relevant('latest')},
d_country AS (SELECT DISTINCT {key('upper(country)')} AS country_id, upper(country) AS country_code,
                     upper(country) AS country_name FROM relevant WHERE country IS NOT NULL),
d_city AS (SELECT DISTINCT {key("split_part(location, ',', 1)", 'country_code')} AS city_id,
                  split_part(location, ',', 1) AS city_name, country_id
           FROM relevant JOIN d_country ON upper(country) = country_code WHERE location LIKE '%,%'),
d_company AS (SELECT DISTINCT {key(_D_COMPANY)} AS company_id, {_D_COMPANY} AS company_name FROM relevant),
d_skill AS (SELECT {key('skill_name')} AS skill_id, skill_name FROM {SKILL_ROWS}),
d_fact AS (
  SELECT {key('r.source', 'r.external_id')} AS job_posting_id, r.source, r.external_id, r.title, co.company_id, ci.city_id, r.work_mode,
         CAST({salary('r.salary_min')} AS DOUBLE) AS salary_min, CAST({salary('r.salary_max')} AS DOUBLE) AS salary_max, r.job_type,
         CASE WHEN regexp_matches(lower(r.title), '(senior|sr\\.|sr |lead|principal|head of|staff)') THEN 'senior'
              WHEN regexp_matches(lower(r.title), '(junior|jr\\.|jr |entry level|graduate|intern)') THEN 'junior'
              ELSE 'unknown' END AS seniority_level,
         r.run_date AS date_first_seen, r.run_date AS date_last_seen, r.url, r.description
  FROM relevant r
  JOIN d_company co ON coalesce(r.company_name, {_text(V.UNKNOWN_COMPANY)}) = co.company_name
  LEFT JOIN d_country cnt ON upper(r.country) = cnt.country_code
  LEFT JOIN d_city ci ON split_part(r.location, ',', 1) = ci.city_name AND cnt.country_id = ci.country_id
),
d_bridge AS (
  SELECT DISTINCT f.job_posting_id, sk.skill_id
  FROM relevant r JOIN d_fact f ON r.source = f.source AND r.external_id = f.external_id
  JOIN d_skill sk ON contains(lower(r.title || ' ' || coalesce(r.description, '')), sk.skill_name)
)"""

# ---- quality --------------------------------------------------------------

FAULTY = """
faulty AS (
  SELECT * REPLACE (
    CASE WHEN ordinal % 97 = 0 THEN NULL WHEN ordinal % 89 = 0 THEN repeat(external_id || '-', 60) ELSE external_id END AS external_id,
    CASE WHEN ordinal % 83 = 0 THEN repeat('Company ', 40) ELSE company_name END AS company_name,
    CASE WHEN ordinal % 79 = 0 THEN repeat('City ', 50) || ', Region' ELSE location END AS location,
    CASE WHEN ordinal % 73 = 0 THEN 'somewhere far' ELSE country END AS country)
  FROM postings
)"""

_REASONS = [
    ("external_id IS NULL", "external_id missing"),
    ("length(external_id) > 100", "external_id too long"),
    ("length(country) > 10", "country too long"),
    (f"{RELEVANT} AND length(company_name) > 255", "company_name too long"),
    (f"{RELEVANT} AND length({CITY}) > 200", "city too long"),
]
REASON = (
    "nullif(concat_ws(', ', " + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name in _REASONS) + "), '')"
)

# A row per constraint; the counts below are what a sound warehouse must show.
_CHECKS = [
    ("dim_country", "country_id not null", "country_id IS NULL"),
    ("dim_country", "country_code length", "length(country_code) > 10"),
    ("dim_country", "country_name length", "length(country_name) > 100"),
    ("dim_city", "city_id not null", "city_id IS NULL"),
    ("dim_city", "city_name length", "length(city_name) > 200"),
    ("dim_company", "company_id not null", "company_id IS NULL"),
    ("dim_company", "company_name not null", "company_name IS NULL"),
    ("dim_company", "company_name length", "length(company_name) > 255"),
    ("dim_skill", "skill_id not null", "skill_id IS NULL"),
    ("dim_skill", "skill_name not null", "skill_name IS NULL"),
    ("dim_skill", "skill_name length", "length(skill_name) > 100"),
    *[("dim_date", f"{c} not null", f"{c} IS NULL") for c in ("date_id", "year", "month", "day", "week_of_year", "day_name")],
    ("dim_date", "day_name length", "length(day_name) > 20"),
    *[("fact_job_posting", f"{c} not null", f"{c} IS NULL")
      for c in ("job_posting_id", "source", "external_id", "title", "date_first_seen", "date_last_seen")],
    *[("fact_job_posting", f"{c} length", f"length({c}) > {n}")
      for c, n in (("source", 20), ("external_id", 100), ("work_mode", 20), ("job_type", 50), ("seniority_level", 20))],
    ("bridge_job_skill", "job_posting_id not null", "job_posting_id IS NULL"),
    ("bridge_job_skill", "skill_id not null", "skill_id IS NULL"),
]
_UNIQUE = [
    ("dim_country", "country_id"), ("dim_country", "country_code"), ("dim_city", "city_id"),
    ("dim_city", "city_name, country_id"), ("dim_company", "company_id"), ("dim_company", "company_name"),
    ("dim_skill", "skill_id"), ("dim_skill", "skill_name"), ("dim_date", "date_id"),
    ("fact_job_posting", "job_posting_id"), ("fact_job_posting", "source, external_id"),
    ("bridge_job_skill", "job_posting_id, skill_id"),
]
_REFERENCES = [
    ("dim_city", "country_id", "dim_country", "country_id"), ("fact_job_posting", "company_id", "dim_company", "company_id"),
    ("fact_job_posting", "city_id", "dim_city", "city_id"), ("fact_job_posting", "publication_date_id", "dim_date", "date_id"),
    ("bridge_job_skill", "job_posting_id", "fact_job_posting", "job_posting_id"),
    ("bridge_job_skill", "skill_id", "dim_skill", "skill_id"),
]
_CTE = {"fact_job_posting": "fact", "bridge_job_skill": "bridge"}

BROKEN = f"""
b_fact AS (
  SELECT * REPLACE (CASE WHEN external_id LIKE '%3' THEN repeat(job_type, 9) ELSE job_type END AS job_type)
  FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE external_id LIKE '%7')
),
b_company AS (SELECT company_id, nullif(company_name, {_text(V.UNKNOWN_COMPANY)}) AS company_name FROM dim_company),
b_country AS (SELECT * FROM dim_country WHERE country_code <> 'FR')"""
_BROKEN_CTE = _CTE | {"fact_job_posting": "b_fact", "dim_company": "b_company", "dim_country": "b_country"}


def _quality_sql(names: dict[str, str] = _CTE) -> str:
    rows = [
        f"SELECT '{t}' AS table_name, '{name}' AS check_name, count(*) FILTER (WHERE {test}) AS violations FROM {names.get(t, t)}"
        for t, name, test in _CHECKS
    ]
    for t, columns in _UNIQUE:
        complete = " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(","))
        rows.append(
            f"SELECT '{t}', '{columns.replace(', ', '+')} unique', count(*) FROM "
            f"(SELECT 1 FROM {names.get(t, t)} WHERE {complete} GROUP BY {columns} HAVING count(*) > 1)"
        )
    for child, column, parent, parent_key in _REFERENCES:
        rows.append(
            f"SELECT '{child}', '{column} in {parent}', count(*) FROM {names.get(child, child)} c WHERE c.{column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {names.get(parent, parent)} p WHERE p.{parent_key} = c.{column})"
        )
    return "\nUNION ALL\n".join(rows)


def calendar(day: str) -> str:
    return (
        f"{day} AS date_id, CAST(year({day}) AS INTEGER) AS year, CAST(month({day}) AS INTEGER) AS month, "
        f"CAST(day({day}) AS INTEGER) AS day, CAST(weekofyear({day}) AS INTEGER) AS week_of_year, dayname({day}) AS day_name"
    )


DIM_DATE = f"dim_date AS (SELECT {calendar('run_date')} FROM (SELECT DISTINCT run_date FROM postings))"


def oracle_sql() -> dict[str, str]:
    skills = f"SELECT {{columns}}, skill_name FROM {{rows}} JOIN {SKILL_ROWS} ON contains({{text}}, skill_name)"
    sql = {
        # rules
        "work_mode_classification": _on_postings("SELECT ordinal, work_mode FROM postings"),
        "light_title_filter": _on_postings(
            f"SELECT ordinal, title FROM postings WHERE source = '{V.SOURCE_A}' AND NOT {_any(TITLE, V.NOISE_WORDS)}"
        ),
        "relevant_postings": _on_postings(
            "SELECT ordinal, source, external_id, title FROM relevant", relevant()
        ),
        "skill_detection": _on_postings(
            "SELECT ordinal, position, skill_name FROM (SELECT *, row_number() OVER (PARTITION BY ordinal ORDER BY rank) - 1 AS position "
            f"FROM (SELECT ordinal, vocab.position AS rank, skill_name FROM postings JOIN {SKILL_ROWS} ON contains({BOTH}, skill_name)))"
        ),
        "skill_lists": _on_postings(
            "SELECT ordinal, coalesce(skills, '') AS skills FROM postings LEFT JOIN "
            f"(SELECT ordinal, string_agg(skill_name, ',' ORDER BY vocab.position) AS skills FROM postings "
            f"JOIN {SKILL_ROWS} ON contains({BOTH}, skill_name) GROUP BY ordinal) USING (ordinal)"
        ),
        "skill_theta_join": _on_postings(
            skills.format(columns="DISTINCT source, external_id", rows="relevant", text=BOTH), relevant()
        ),
        "seniority_case": _on_postings(f"SELECT ordinal, {SENIORITY} AS seniority_level FROM postings"),
        "seniority_regex": _on_postings(
            "SELECT ordinal, CASE WHEN regexp_matches(lower(coalesce(title, '')), 'senior|sr\\.|sr |lead|principal|head of|staff') THEN 'senior' "
            "WHEN regexp_matches(lower(coalesce(title, '')), 'junior|jr\\.|jr |entry level|graduate|intern') THEN 'junior' "
            "ELSE 'unknown' END AS seniority_level FROM postings"
        ),
        "geography_parse": _on_postings(f"SELECT ordinal, {CODE} AS country_code, {CITY} AS city_name FROM postings"),
        "geography_split_part": _on_postings(
            "SELECT ordinal, split_part(location, ',', 1) AS city_text FROM postings WHERE country IS NOT NULL AND location LIKE '%,%'"
        ),
        "salary_parse": _on_postings(
            f"SELECT ordinal, CAST({salary('salary_min')} AS DOUBLE) AS salary_min, "
            f"CAST({salary('salary_max')} AS DOUBLE) AS salary_max FROM postings"
        ),
        "company_default": _on_postings(f"SELECT ordinal, {COMPANY} AS company_name FROM postings"),
        "country_name_lookup": _on_postings(
            f"SELECT ordinal, {COUNTRY_NAME.format('country')} AS country_name FROM postings"
        ),
        "calendar_fields": f"SELECT {calendar('d')} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)",
        "extraction_time_text": (
            "SELECT event_id, strftime(CASE WHEN event_id % 2 = 0 THEN ts ELSE ts - INTERVAL 2 HOUR END, "
            "'%Y-%m-%dT%H:%M:%S.%f') AS extracted_at FROM events"
        ),
        "posting_keys": _on_postings(
            f"SELECT DISTINCT source, external_id, {key('source', 'external_id')} AS job_posting_id FROM postings"
        ),
        # feeds
        "normalize_source_a": _on_feeds(
            f"SELECT {POSTING_FIELDS}, ordinal FROM feed WHERE source = '{V.SOURCE_A}'"
        ),
        "normalize_source_b": _on_feeds(
            f"SELECT {POSTING_FIELDS}, ordinal FROM feed WHERE source = '{V.SOURCE_B}'"
        ),
        "normalize_union_dedup": _on_feeds(f"SELECT {POSTING_FIELDS}, extracted_at, copies FROM merged"),
        "extraction_report": _on_feeds(
            f"SELECT extracted_at, count(*) AS job_count, "
            f"CAST(coalesce(sum(copies) FILTER (WHERE source = '{V.SOURCE_A}'), 0) AS BIGINT) AS count_a, "
            f"CAST(coalesce(sum(copies) FILTER (WHERE source = '{V.SOURCE_B}'), 0) AS BIGINT) AS count_b "
            "FROM merged GROUP BY extracted_at"
        ),
        "feed_counts": _on_feeds(
            f"SELECT extracted_at AS run, CASE WHEN source = '{V.SOURCE_A}' THEN 'a' ELSE 'b' END AS feed, country, term, "
            "count(*) AS jobs, count(*) FILTER (WHERE external_id IS NULL) AS without_id "
            "FROM feed GROUP BY ALL"
        ),
        "jobs_without_id": _on_feeds("SELECT source, ordinal FROM feed WHERE external_id IS NULL"),
        # staging
        "latest_run_scan": _on_postings(f"SELECT {POSTING_FIELDS}, extracted_at, ordinal FROM latest", LATEST),
        "latest_run_with_odd_times": _on_postings(
            "SELECT ordinal, source, external_id, '2026-09-21T06:00:00.000000' AS extracted_at FROM postings "
            f"WHERE extracted_at = '{OP.RUN_TIMES[2]}' AND ordinal % 50 <> 0"
        ),
        # dimensions
        "dim_country": _on_postings("SELECT * FROM dim_country", model()),
        "dim_city": _on_postings("SELECT * FROM dim_city", model()),
        "dim_company": _on_postings("SELECT * FROM dim_company", model()),
        "dim_skill": _on_postings("SELECT * FROM dim_skill", model()),
        "dim_skill_seeded": _on_postings(
            f"SELECT {key('skill_name')} AS skill_id, skill_name, "
            "(SELECT count(*) FROM pairs p WHERE p.skill_name = vocab.skill_name) AS job_count "
            f"FROM {SKILL_ROWS}", model()
        ),
        "dim_date": _on_postings("SELECT * FROM dim_date", DIM_DATE),
        # facts
        "fact_upsert": _on_postings(FACT_SELECT, model()),
        "publication_dates": _on_postings(
            f"SELECT {key('source', 'external_id')} AS job_posting_id, day AS publication_date_id, "
            "CAST(week(day) AS INTEGER) AS week_of_year, dayname(day) AS day_name "
            "FROM (SELECT *, CAST(substr(publication_date, 1, 10) AS DATE) AS day FROM ranked WHERE up = 1)", model()
        ),
        "streamed_fact": _on_postings(FACT_SELECT, model()),
        "raw_zone_of_both_forms": _on_feeds(
            "SELECT source, external_id, title, url FROM merged WHERE extracted_at = (SELECT max(extracted_at) FROM merged)"
        ),
        "bridge_upsert": _on_postings(BRIDGE_SELECT, model()),
        "load_report": _on_postings(
            "SELECT extracted_at, count(*) FILTER (WHERE rel AND nth = 1) AS inserted, "
            "count(*) FILTER (WHERE rel AND nth > 1) AS updated, count(*) FILTER (WHERE NOT rel) AS skipped, "
            "CAST(0 AS BIGINT) AS quarantined "
            "FROM (SELECT *, row_number() OVER (PARTITION BY rel, source, external_id ORDER BY extracted_at, ordinal) AS nth "
            f"FROM (SELECT *, {RELEVANT} AS rel FROM postings)) GROUP BY extracted_at"
        ),
        "fact_from_tied_documents": _on_postings(
            "SELECT source, external_id, min(run_date) AS date_first_seen, true AS one_sighting "
            "FROM relevant GROUP BY source, external_id", relevant()
        ),
        # marts
        **{name: _on_postings(select, model()) for name, select in MARTS.items()},
        "top_skills": _on_postings(
            "SELECT skill_name, count(*) AS job_count FROM bridge GROUP BY skill_name ORDER BY job_count DESC, skill_name LIMIT 5",
            model(),
        ),
        "empty_warehouse_kpis": (
            "SELECT CAST(0 AS BIGINT) AS total_job_postings, CAST(0 AS BIGINT) AS total_companies, "
            "CAST(NULL AS DOUBLE) AS pct_remote, CAST(0 AS BIGINT) AS total_skills, CAST(NULL AS DATE) AS last_update"
        ),
        # quality
        "quality_report_of_broken_tables": _on_postings(_quality_sql(_BROKEN_CTE), model(), DIM_DATE, BROKEN),
        "quality_report": _on_postings(_quality_sql(), model(), DIM_DATE),
        "quarantined_rows": _on_postings(
            f"SELECT ordinal, source, external_id, {REASON} AS reason FROM faulty WHERE {REASON} IS NOT NULL", FAULTY
        ),
        "load_with_faults": _on_postings(
            "SELECT extracted_at, count(*) FILTER (WHERE NOT bad AND rel AND nth = 1) AS inserted, "
            "count(*) FILTER (WHERE NOT bad AND rel AND nth > 1) AS updated, "
            "count(*) FILTER (WHERE NOT bad AND NOT rel) AS skipped, count(*) FILTER (WHERE bad) AS quarantined, "
            "count(*) FILTER (WHERE bad) AS set_aside FROM (SELECT *, row_number() OVER "
            "(PARTITION BY bad, rel, source, external_id ORDER BY extracted_at, ordinal) AS nth "
            f"FROM (SELECT *, {REASON} IS NOT NULL AS bad, {RELEVANT} AS rel FROM faulty)) GROUP BY extracted_at", FAULTY
        ),
        "malformed_salaries": _on_postings(
            "SELECT ordinal, source, external_id, 'salary_max' AS field, salary_max AS text FROM postings "
            "WHERE salary_max = 'negotiable'"
        ),
        # written and read back
        "landed_feeds_roundtrip": _on_feeds(f"SELECT {POSTING_FIELDS}, extracted_at, copies FROM merged"),
        "extract_landed_runs": _on_feeds(f"SELECT {POSTING_FIELDS}, extracted_at FROM merged"),
        "empty_rerun_replaces_day": _on_feeds(
            f"SELECT extracted_at, CASE WHEN extracted_at = '{OP.RUN_TIMES[2]}' THEN 0 ELSE count(*) END AS postings, "
            f"CASE WHEN extracted_at = '{OP.RUN_TIMES[2]}' THEN 0 ELSE count(*) END AS job_count FROM merged GROUP BY extracted_at"
        ),
        "raw_zone_roundtrip": _on_feeds(
            f"SELECT {POSTING_FIELDS}, extracted_at FROM merged WHERE extracted_at = (SELECT max(extracted_at) FROM merged)"
        ),
        "raw_zone_rewrite_day": _on_feeds(
            f"SELECT extracted_at, source, count(*) AS postings FROM merged "
            f"WHERE extracted_at < '{OP.RUN_TIMES[2]}' OR source = '{V.SOURCE_B}' GROUP BY ALL"
        ),
        "staging_append": _on_feeds(
            "SELECT extracted_at || '.000000' AS extracted_at, source, external_id, 2 * count(*) AS copies FROM merged GROUP BY ALL"
        ),
        "staging_stream": _on_feeds(f"SELECT {POSTING_FIELDS}, extracted_at || '.000000' AS extracted_at FROM merged"),
        "incremental_fact": _on_postings(FACT_SELECT, model()),
        "incremental_bridge": _on_postings(BRIDGE_SELECT, model()),
        "incremental_dimensions": _on_postings(
            "SELECT 'country' AS dimension, country_id AS id, country_name AS name, country_code AS rest FROM dim_country "
            "UNION ALL SELECT 'city', city_id, city_name, country_id FROM dim_city "
            "UNION ALL SELECT 'company', company_id, company_name, '' FROM dim_company "
            "UNION ALL SELECT 'skill', skill_id, skill_name, '' FROM dim_skill "
            "UNION ALL SELECT 'date', CAST(date_id AS VARCHAR), day_name, "
            "concat_ws(' ', year, month, day, week_of_year) FROM dim_date",
            model(), DIM_DATE,
        ),
        "published_marts": _on_postings(
            "SELECT 'mart_skill_demand' AS mart, concat_ws(' | ', skill_name, pct_du_total) AS label, job_count FROM ("
            + MARTS["mart_skill_demand"] + ") UNION ALL SELECT 'mart_seniority_distribution', "
            "concat_ws(' | ', seniority_level, pct_du_total), job_count FROM (" + MARTS["mart_seniority_distribution"]
            + ") UNION ALL SELECT 'mart_geography_demand', concat_ws(' | ', country_name, city_name, source), job_count FROM ("
            + MARTS["mart_geography_demand"] + ") UNION ALL SELECT 'mart_skill_by_seniority', "
            "concat_ws(' | ', skill_name, seniority_level), job_count FROM (" + MARTS["mart_skill_by_seniority"]
            + ") UNION ALL SELECT 'mart_kpi_summary', concat_ws(' | ', total_companies, pct_remote, total_skills, last_update), "
            "total_job_postings FROM (" + MARTS["mart_kpi_summary"] + ")",
            model(),
        ),
        # one step after another
        "feeds_to_kpis": _on_feeds(MARTS["mart_kpi_summary"], model("fed"))
        .replace("relevant AS (", "fed AS (SELECT * EXCLUDE (down, seen) FROM merged),\nrelevant AS (", 1),
        # declarative variant
        "declarative_dimensions": _on_postings(
            "SELECT 'country' AS dimension, country_id AS id, country_name AS name, country_code AS rest FROM d_country "
            "UNION ALL SELECT 'city', city_id, city_name, country_id FROM d_city "
            "UNION ALL SELECT 'company', company_id, company_name, '' FROM d_company "
            "UNION ALL SELECT 'skill', skill_id, skill_name, '' FROM d_skill",
            LATEST, DECLARATIVE,
        ),
        "declarative_fact": _on_postings("SELECT * FROM d_fact", LATEST, DECLARATIVE),
        "declarative_bridge": _on_postings("SELECT * FROM d_bridge", LATEST, DECLARATIVE),
        # upserts on their own
        "insert_if_absent": _on_postings(
            f"SELECT company_name, min(extracted_at) AS first_run FROM (SELECT {COMPANY} AS company_name, extracted_at FROM relevant) "
            "GROUP BY company_name", relevant()
        ),
        "country_name_overwrite": _on_postings(
            "SELECT country_id, country_code, CASE WHEN renewed THEN country_name ELSE country_code END AS country_name FROM "
            "(SELECT country_id, country_code, country_name, country_code IN "
            f"(SELECT {CODE} FROM relevant WHERE extracted_at > '{OP.RUN_TIMES[0]}') AS renewed FROM dim_country)", model()
        ),
        # long texts
        "skills_in_documents": (
            f"SELECT doc_id, coalesce(string_agg(skill_name, ',' ORDER BY vocab.position), '') AS skills "
            f"FROM documents LEFT JOIN {SKILL_ROWS} ON contains(lower(text), skill_name) GROUP BY doc_id"
        ),
        "work_mode_of_documents": f"SELECT doc_id, {work_mode('lower(text)')} AS work_mode FROM documents",
        "skills_in_conversations": (
            f"SELECT conv_id, turn, coalesce(string_agg(skill_name, ',' ORDER BY vocab.position), '') AS skills "
            f"FROM conversations LEFT JOIN {SKILL_ROWS} ON contains(lower(text), skill_name) GROUP BY conv_id, turn"
        ),
    }
    sql["marts_kept_current"] = sql["published_marts"]
    return sql
