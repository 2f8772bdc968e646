"""The registered queries: ``name -> (spark, folder) -> DataFrame``.

All read the test tables in ``folder``. Amounts are returned as DOUBLE and
arrays row by row, so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from ..functions import vocabulary as V
from ..operators import declarative, dedup, mart_state, marts, mentions, merge, quality
from ..operators import modelling as M
from ..operators import normalize as N
from ..plans import extract, load, stage
from ..session import scratch_path, written
from ..sources import feeds, raw_zone, staging
from ..sources.order_postings import (
    RUN_TIMES, order_postings, read_table, source_a_jobs, source_b_jobs,
)
from ..sources.warehouse import Warehouse
from ..streaming.load_stream import load_new_rows
from ..streaming.staging_stream import stage_new_documents

Query = Callable[[SparkSession, str], DataFrame]

# Stands in for the clock wherever a load records when it ran.
LOADED_AT = dt.datetime(2026, 9, 21, 7, 0, 0)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _plain_postings(postings: DataFrame, *more: str) -> DataFrame:
    fields = [F.to_json("tags").alias("tags") if c == "tags" else F.col(c) for c in schemas.POSTING_COLUMNS]
    return postings.select(*fields, *more)


def _plain_fact(fact: DataFrame) -> DataFrame:
    return fact.select(
        *[F.col(c).cast("double").alias(c) if c.startswith("salary") else F.col(c)
          for c in schemas.FACT_COLUMNS if c in fact.columns]
    )


def _warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return M.build_warehouse(order_postings(spark, folder))


# ---- rules ----------------------------------------------------------------

@query
def work_mode_classification(spark, folder):
    return order_postings(spark, folder).select("ordinal", rules.work_mode().alias("work_mode"))


@query
def light_title_filter(spark, folder):
    from_a = order_postings(spark, folder).where(F.col("source") == V.SOURCE_A)
    return N.drop_noise(from_a).select("ordinal", "title")


@query
def relevant_postings(spark, folder):
    return M.relevant_postings(order_postings(spark, folder)).select("ordinal", "source", "external_id", "title")


@query
def skill_detection(spark, folder):
    rows = M.skill_rows(order_postings(spark, folder), "ordinal", positions=True)
    return rows.withColumn("position", F.col("position").cast("bigint"))


@query
def skill_lists(spark, folder):
    """The skills of each posting as one text."""
    masked = M.with_skill_mask(order_postings(spark, folder))
    return masked.select("ordinal", F.concat_ws(",", rules.skills_in_mask()).alias("skills"))


@query
def skill_theta_join(spark, folder):
    relevant = M.relevant_postings(order_postings(spark, folder))
    return mentions.skill_pairs(relevant, M.skill_seed(spark))


@query
def seniority_case(spark, folder):
    return order_postings(spark, folder).select("ordinal", rules.seniority().alias("seniority_level"))


@query
def seniority_regex(spark, folder):
    return order_postings(spark, folder).select("ordinal", rules.seniority_by_regex().alias("seniority_level"))


@query
def geography_parse(spark, folder):
    return order_postings(spark, folder).select(
        "ordinal",
        rules.country_code().alias("country_code"),
        rules.city_name().alias("city_name"),
    )


@query
def geography_split_part(spark, folder):
    placed = order_postings(spark, folder).where(F.col("country").isNotNull() & F.col("location").contains(","))
    return placed.select("ordinal", rules.city_text_before_comma().alias("city_text"))


@query
def salary_parse(spark, folder):
    return order_postings(spark, folder).select(
        "ordinal", *[rules.salary(c).cast("double").alias(c) for c in ("salary_min", "salary_max")]
    )


@query
def company_default(spark, folder):
    return order_postings(spark, folder).select(
        "ordinal", rules.company_or_unknown().alias("company_name")
    )


@query
def country_name_lookup(spark, folder):
    return order_postings(spark, folder).select("ordinal", rules.country_name("country").alias("country_name"))


@query
def calendar_fields(spark, folder):
    days = read_table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(*rules.calendar_fields("d"))


@query
def extraction_time_text(spark, folder):
    """Event times in the two spellings in use, brought to one."""
    spelled = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    spelled = F.when(F.col("event_id") % 2 == 0, spelled).otherwise(F.concat(spelled, F.lit("+02:00")))
    events = read_table(spark, folder, "events").select("event_id", spelled.alias("spelled"))
    return events.select("event_id", rules.extraction_time_text("spelled").alias("extracted_at"))


@query
def posting_keys(spark, folder):
    key = rules.surrogate_key("source", "external_id")
    return order_postings(spark, folder).select("source", "external_id").distinct().withColumn("job_posting_id", key)


# ---- feeds ----------------------------------------------------------------

def _feeds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return N.place_in_feed(source_a_jobs(spark, folder)), N.place_in_feed(source_b_jobs(spark, folder))


def _order_number():
    """The order a job was made from, recovered from its place in the feed."""
    return (F.col("feed_order.p") * 1000 + F.col("feed_order.i")).alias("ordinal")


@query
def normalize_source_a(spark, folder):
    jobs, _ = _feeds(spark, folder)
    return _plain_postings(N.normalize_source_a(jobs), _order_number())


@query
def normalize_source_b(spark, folder):
    _, jobs = _feeds(spark, folder)
    return _plain_postings(N.normalize_source_b(jobs), _order_number())


@query
def normalize_union_dedup(spark, folder):
    return _plain_postings(N.merge_feeds(*_feeds(spark, folder)), "extracted_at", "copies")


@query
def extraction_report(spark, folder):
    return N.extraction_report(N.merge_feeds(*_feeds(spark, folder)))


@query
def feed_counts(spark, folder):
    return extract.feed_counts(*_feeds(spark, folder))


@query
def jobs_without_id(spark, folder):
    a, b = (N.without_id(jobs).select(_order_number()) for jobs in _feeds(spark, folder))
    return a.withColumn("source", F.lit(V.SOURCE_A)).unionByName(b.withColumn("source", F.lit(V.SOURCE_B)))


# ---- staging --------------------------------------------------------------

@query
def latest_run_scan(spark, folder):
    return _plain_postings(staging.latest_run(order_postings(spark, folder)), "extracted_at", "ordinal")


@query
def latest_run_with_odd_times(spark, folder):
    """The newest staged run where some times are missing and some carry an offset."""
    time, n = F.col("extracted_at"), F.col("ordinal")
    odd = (
        F.when(n % 50 == 0, F.lit(None))
        .when((n % 3 == 0) & (time == RUN_TIMES[2]), F.lit("2026-09-21T08:00:00+02:00"))
        .when((n % 3 == 1) & (time == RUN_TIMES[1]), F.lit("2026-09-14T23:00:00-03:00"))
        .otherwise(time)
    )
    path = scratch_path(spark, "staging")
    rows = order_postings(spark, folder).withColumn("extracted_at", odd)
    staging.append(staging.to_staging(rows, LOADED_AT), path)
    newest = staging.read_run(spark, path, staging.latest_run_key(spark, path))
    return newest.select("ordinal", "source", "external_id", "extracted_at")


# ---- dimensions -----------------------------------------------------------

@query
def dim_country(spark, folder):
    return _warehouse(spark, folder)["dim_country"]


@query
def dim_city(spark, folder):
    return _warehouse(spark, folder)["dim_city"]


@query
def dim_company(spark, folder):
    return _warehouse(spark, folder)["dim_company"]


@query
def dim_skill(spark, folder):
    return _warehouse(spark, folder)["dim_skill"]


@query
def dim_skill_seeded(spark, folder):
    """The full vocabulary, each skill with its number of postings."""
    seed = M.skill_seed(spark)
    per_skill = _warehouse(spark, folder)["bridge_job_skill"].groupBy("skill_id").agg(F.count(F.lit(1)).alias("n"))
    return seed.join(per_skill, "skill_id", "left").select(
        "skill_id", "skill_name", F.coalesce("n", F.lit(0)).alias("job_count")
    )


@query
def dim_date(spark, folder):
    return _warehouse(spark, folder)["dim_date"]


# ---- facts ----------------------------------------------------------------

@query
def fact_upsert(spark, folder):
    return _plain_fact(_warehouse(spark, folder)["fact_job_posting"])


@query
def publication_dates(spark, folder):
    """Postings with the day they were published as a key of the calendar."""
    tables = M.build_warehouse(order_postings(spark, folder), M.ModelOptions(publication_dates=True))
    fact = tables["fact_job_posting"].select("job_posting_id", "publication_date_id")
    days = tables["dim_date"].select("date_id", "week_of_year", "day_name")
    return fact.join(days, F.col("publication_date_id") == F.col("date_id"), "left").drop("date_id")


@query
def bridge_upsert(spark, folder):
    return _warehouse(spark, folder)["bridge_job_skill"]


@query
def fact_from_tied_documents(spark, folder):
    """Sightings of a run numbered alike, as two documents without ordinals number theirs: what is kept of a first
    sighting comes from one of them. A row says whether its url, salary and type occur together."""
    rows = order_postings(spark, folder).withColumns({
        "ordinal": F.lit(0).cast("bigint"), "url": F.concat("url", F.lit("/"), F.col("ordinal").cast("string")),
    })
    relevant = M.relevant_postings(rows)
    fact = M.fold(relevant).select("source", "external_id", "url", "job_type", "salary_min", "date_first_seen")
    seen = relevant.select(
        F.col("url").alias("of_url"), F.col("job_type").alias("of_type"), rules.salary("salary_min").alias("of_salary")
    ).distinct()
    together = (
        (F.col("url") == F.col("of_url"))
        & F.col("job_type").eqNullSafe(F.col("of_type"))
        & F.col("salary_min").eqNullSafe(F.col("of_salary"))
    )
    return fact.join(seen, together, "left").select(
        "source", "external_id", "date_first_seen", F.col("of_url").isNotNull().alias("one_sighting")
    )


@query
def load_report(spark, folder):
    return merge.replay_report(order_postings(spark, folder))


# ---- marts ----------------------------------------------------------------

#: What marts read of a folded posting.
_MART_COLUMNS = ["job_posting_id", "source", "company_id", "city_id", "work_mode", "seniority_level", "date_last_seen"]


def _marts(spark: SparkSession, folder: str, store: str = "") -> dict[str, DataFrame]:
    """Marts over the fold of all runs, with what is read more than once stored: the short columns of the
    ``fold``, or those that ``dimensions`` are made from."""
    relevant = M.relevant_postings(quality.accepted(order_postings(spark, folder)))
    fold = M.fold(relevant).select(*_MART_COLUMNS, *rules.mask_names())
    if store == "fold":
        fold = written(fold, "folded")
    narrow = relevant.select(*M.DIMENSION_SOURCES, "run_date")
    if store == "dimensions":
        narrow = written(narrow, "relevant")
    return marts.all_marts(M.build_warehouse(narrow, M.DEFAULT, fold, narrow))


@query
def mart_skill_demand(spark, folder):
    return _marts(spark, folder, "fold")["mart_skill_demand"]


@query
def mart_seniority_distribution(spark, folder):
    return _marts(spark, folder)["mart_seniority_distribution"]


@query
def mart_geography_demand(spark, folder):
    return _marts(spark, folder, "dimensions")["mart_geography_demand"]


@query
def mart_skill_by_seniority(spark, folder):
    return _marts(spark, folder, "fold")["mart_skill_by_seniority"]


@query
def mart_kpi_summary(spark, folder):
    return _marts(spark, folder, "fold")["mart_kpi_summary"]


@query
def top_skills(spark, folder):
    demand = _marts(spark, folder, "fold")["mart_skill_demand"]
    return marts.top_skills(demand, 5).select("skill_name", "job_count")


@query
def empty_warehouse_kpis(spark, folder):
    """The headline figures when no posting is relevant."""
    none = order_postings(spark, folder).where(F.col("title") == "Gardener")
    return marts.all_marts(M.build_warehouse(none))["mart_kpi_summary"]


# ---- quality --------------------------------------------------------------

def _published(spark: SparkSession, folder: str) -> Warehouse:
    """All runs staged, replayed and published."""
    path = scratch_path(spark, "staging")
    staging.append(staging.to_staging(order_postings(spark, folder), LOADED_AT), path)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    load.replay(staging.read(spark, path), warehouse, LOADED_AT)
    return warehouse


@query
def quality_report(spark, folder):
    return quality.quality_report(_published(spark, folder).tables())


def _broken(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables that break a constraint of each kind."""
    fact, company, country = tables["fact_job_posting"], tables["dim_company"], tables["dim_country"]
    no_name = F.when(F.col("company_name") != V.UNKNOWN_COMPANY, F.col("company_name"))
    return tables | {
        "fact_job_posting": fact.unionByName(fact.where("external_id LIKE '%7'")).withColumn(
            "job_type", F.when(F.col("external_id").endswith("3"), F.repeat("job_type", 9)).otherwise(F.col("job_type"))
        ),
        "dim_company": company.withColumn("company_name", no_name),
        "dim_country": country.where("country_code <> 'FR'"),
    }


@query
def quality_report_of_broken_tables(spark, folder):
    return quality.quality_report(_broken(_published(spark, folder).tables()))


def _faulty(spark: SparkSession, folder: str) -> DataFrame:
    """Postings with faults put into them."""
    n = F.col("ordinal")
    key = F.col("external_id")
    return order_postings(spark, folder).withColumns(
        {
            "external_id": F.when(n % 97 == 0, F.lit(None))
            .when(n % 89 == 0, F.repeat(F.concat(key, F.lit("-")), 60))
            .otherwise(key),
            "company_name": F.when(n % 83 == 0, F.repeat(F.lit("Company "), 40)).otherwise(F.col("company_name")),
            "location": F.when(n % 79 == 0, F.concat(F.repeat(F.lit("City "), 50), F.lit(", Region")))
            .otherwise(F.col("location")),
            "country": F.when(n % 73 == 0, "somewhere far").otherwise(F.col("country")),
        }
    )


@query
def quarantined_rows(spark, folder):
    """Rows set aside after faults were put into the postings."""
    return quality.quarantined(_faulty(spark, folder)).select("ordinal", "source", "external_id", "reason")


@query
def load_with_faults(spark, folder):
    """Reports of loading faulty postings run by run, and the rows in each version's quarantine table."""
    faulty = _faulty(spark, folder)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    reports = []
    for time in RUN_TIMES:
        # A load reads its run up to three times.
        run = written(faulty.where(F.col("extracted_at") == time), "run")
        report = load.load_run(run, warehouse, time, LOADED_AT)
        reports.append((time, *(report[c] for c in ("inserted", "updated", "skipped", "quarantined")), warehouse.quarantine().count()))
    return spark.createDataFrame(
        reports, "extracted_at string, inserted bigint, updated bigint, skipped bigint, quarantined bigint, set_aside bigint"
    )


@query
def malformed_salaries(spark, folder):
    return quality.malformed_salaries(order_postings(spark, folder))


# ---- written and read back ------------------------------------------------
# These write to new paths in the shared folder that the session names.

@query
def landed_feeds_roundtrip(spark, folder):
    """Land the responses of both feeds as files, read and merge them."""
    a, b = _land(spark, folder)
    landed = feeds.read_source_a(spark, a, multi_line=False), feeds.read_source_b(spark, b, multi_line=False)
    return _plain_postings(N.merge_feeds(*landed), "extracted_at", "copies")


@query
def extract_landed_runs(spark, folder):
    """Extract landed responses run by run, as a week's job would; read the raw zone back."""
    a, b = _land(spark, folder)
    root = scratch_path(spark, "raw")
    for time in RUN_TIMES:
        extract.extract_landed(spark, a, b, root, run=_key(time), multi_line=False)
    return _plain_postings(raw_zone.postings_of(raw_zone.read_payloads(spark, root)), "extracted_at")


def _key(time: str) -> str:
    """Run key of a time without fractions."""
    return "".join(c for c in time if c.isalnum()) + "000000"


@query
def empty_rerun_replaces_day(spark, folder):
    """Extract all runs, then the newest once more with nothing landed: its day is left with no posting."""
    root = _raw_zone(spark, folder)
    a, b = (jobs.where("false") for jobs in _feeds(spark, folder))
    extract.extract(a, b, root, spark.createDataFrame([(RUN_TIMES[-1],)], "extracted_at string"))
    documents = raw_zone.read_payloads(spark, root)
    counted = documents.groupBy("extracted_at").agg(
        F.sum(F.size(F.coalesce("jobs", F.array()))).alias("postings"), F.max("job_count").alias("job_count")
    )
    return counted


def _land(spark: SparkSession, folder: str) -> tuple[str, str]:
    paths = scratch_path(spark, "landed-a"), scratch_path(spark, "landed-b")
    # A response per job: whatever the tables hold, none grows beyond that.
    a, b = source_a_jobs(spark, folder), source_b_jobs(spark, folder)
    run = rules.run_key("run").alias("run")
    page = (F.col("page") * 1000 + F.col("pos")).alias("page")
    feeds.write_responses(a.select(run, "term", page, F.array("job").alias("jobs")), paths[0])
    feeds.write_responses(b.select(run, "country", "term", page, F.array("job").alias("results")), paths[1])
    return paths


def _raw_zone(spark: SparkSession, folder: str) -> str:
    root = scratch_path(spark, "raw")
    extract.extract(*_feeds(spark, folder), root)
    return root


@query
def raw_zone_roundtrip(spark, folder):
    """Write every run to the raw zone, read the newest day back."""
    root = _raw_zone(spark, folder)
    newest = raw_zone.read_payloads(spark, raw_zone.latest_day_path(spark, root))
    return _plain_postings(raw_zone.postings_of(newest), "extracted_at")


@query
def raw_zone_rewrite_day(spark, folder):
    """Write the newest day once more, from feed B alone: it is replaced, the
    other days stay."""
    root = _raw_zone(spark, folder)
    _, b = _feeds(spark, folder)
    again = b.where(F.col("run") == RUN_TIMES[-1])
    no_a, _ = _feeds(spark, folder)
    extract.extract(no_a.where(F.lit(False)), again, root)
    rows = raw_zone.postings_of(raw_zone.read_payloads(spark, root))
    return rows.groupBy("extracted_at", "source").agg(F.count(F.lit(1)).alias("postings"))


@query
def staging_append(spark, folder):
    """Stage every day twice: nothing is de-duplicated here."""
    root, path = _raw_zone(spark, folder), scratch_path(spark, "staging")
    for _ in range(2):
        for time in RUN_TIMES:
            day = raw_zone.day_path(root, dt.date.fromisoformat(time[:10]))
            stage.stage_path(spark, day, path, LOADED_AT)
    rows = staging.read(spark, path)
    return rows.groupBy("extracted_at", "source", "external_id").agg(F.count(F.lit(1)).alias("copies"))


@query
def staging_stream(spark, folder):
    """Stage all raw documents by the file stream."""
    root, path = _raw_zone(spark, folder), scratch_path(spark, "stream-staging")
    running = stage_new_documents(spark, root, path, scratch_path(spark, "stream-state"), LOADED_AT)
    running.awaitTermination()
    return _plain_postings(staging.read(spark, path), "extracted_at")


def _load_run_by_run(spark: SparkSession, folder: str) -> Warehouse:
    path = scratch_path(spark, "staging")
    postings = order_postings(spark, folder)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    for time in RUN_TIMES:
        run = postings.where(F.col("extracted_at") == time)
        staging.append(staging.to_staging(run, LOADED_AT), path)
        load.load_latest_run(spark, path, warehouse, LOADED_AT)
    return warehouse


@query
def incremental_fact(spark, folder):
    """Fact after loading run by run; equals the replay."""
    return _plain_fact(_load_run_by_run(spark, folder).tables()["fact_job_posting"])


@query
def streamed_fact(spark, folder):
    """Fact after loading what was staged by the file stream, a few files at a time; equals the replay."""
    path = scratch_path(spark, "staging")
    staging.append(staging.to_staging(order_postings(spark, folder), LOADED_AT), path)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    running = load_new_rows(spark, path, warehouse, scratch_path(spark, "stream-state"), LOADED_AT, files_per_batch=8)
    running.awaitTermination()
    return _plain_fact(warehouse.tables()["fact_job_posting"])


@query
def raw_zone_of_both_forms(spark, folder):
    """The newest raw day, half of it in lines and half in documents spread over many lines, staged without a hint."""
    root, table = _raw_zone(spark, folder), scratch_path(spark, "staging")
    day = raw_zone.latest_day_path(spark, root)
    documents = raw_zone.read_payloads(spark, day, multi_line=False)
    postings = documents.where(F.size("jobs") > 0).withColumn("number", F.col("jobs")[0]["ordinal"])
    text = F.to_json(F.struct("extracted_at", "jobs"), {"pretty": "true", "ignoreNullFields": "false"})
    mixed = scratch_path(spark, "raw-mixed")
    postings.where("number % 2 = 0").select("extracted_at", "jobs").write.json(f"{mixed}/lines")
    # Documents of some 2,000 postings, each in a file of its own.
    odd = postings.where("number % 2 = 1")
    n_documents = max(1, odd.count() // 2000)
    spread = odd.groupBy("extracted_at", F.pmod(F.xxhash64("number"), F.lit(n_documents)).alias("part")).agg(
        F.flatten(F.collect_list("jobs")).alias("jobs")
    )
    spread.select(F.concat(F.lit("part="), F.col("part").cast("string")).alias("file"), text.alias("value")).write.partitionBy(
        "file"
    ).text(f"{mixed}/spread")
    stage.stage_path(spark, mixed, table, LOADED_AT)
    return staging.read(spark, table).select("source", "external_id", "title", "url")


@query
def incremental_bridge(spark, folder):
    return _load_run_by_run(spark, folder).tables()["bridge_job_skill"]


@query
def incremental_dimensions(spark, folder):
    return _dimension_rows(_load_run_by_run(spark, folder).tables())


def _dimension_rows(tables: dict[str, DataFrame]) -> DataFrame:
    columns = {
        "dim_country": ("country", "country_id", "country_name", ["country_code"]),
        "dim_city": ("city", "city_id", "city_name", ["country_id"]),
        "dim_company": ("company", "company_id", "company_name", []),
        "dim_skill": ("skill", "skill_id", "skill_name", []),
        "dim_date": ("date", "date_id", "day_name", ["year", "month", "day", "week_of_year"]),
    }
    parts = [
        tables[t].select(
            F.lit(label).alias("dimension"), F.col(key).cast("string").alias("id"), F.col(name).alias("name"),
            F.concat_ws(" ", *[F.col(c).cast("string") for c in rest]).alias("rest"),
        )
        for t, (label, key, name, rest) in columns.items()
        if t in tables
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


@query
def published_marts(spark, folder):
    """Marts kept beside a published warehouse, read back."""
    warehouse = _published(spark, folder)
    load.refresh_marts(warehouse)
    return _mart_rows(warehouse.read_mart)


@query
def marts_kept_current(spark, folder):
    """Marts from counts that each of three loads has brought forward by what it changed."""
    postings = order_postings(spark, folder)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    for time in RUN_TIMES:
        run = written(postings.where(F.col("extracted_at") == time), "run")
        load.load_run(run, warehouse, time, LOADED_AT, keep_marts=True)
    kept = mart_state.marts_of(warehouse.mart_state(), warehouse.tables())
    return _mart_rows(kept.__getitem__)


def _mart_rows(mart_of: Callable[[str], DataFrame]) -> DataFrame:
    labels = {
        "mart_skill_demand": ["skill_name", "pct_du_total"],
        "mart_seniority_distribution": ["seniority_level", "pct_du_total"],
        "mart_geography_demand": ["country_name", "city_name", "source"],
        "mart_skill_by_seniority": ["skill_name", "seniority_level"],
        "mart_kpi_summary": ["total_companies", "pct_remote", "total_skills", "last_update"],
    }
    parts = []
    for mart, columns in labels.items():
        kept = mart_of(mart).withColumnRenamed("total_job_postings", "job_count")
        label = F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns]).alias("label")
        parts.append(kept.select(F.lit(mart).alias("mart"), label, "job_count"))
    return reduce(DataFrame.unionByName, parts)


# ---- one step after another -----------------------------------------------

@query
def feeds_to_kpis(spark, folder):
    """From feed jobs to headline figures without anything written between."""
    merged = N.merge_feeds(*_feeds(spark, folder))
    staged = staging.to_staging(merged, LOADED_AT)
    return marts.all_marts(M.build_warehouse(staged))["mart_kpi_summary"]


# ---- declarative variant --------------------------------------------------

def _declarative(spark: SparkSession, folder: str, *tables: str) -> dict[str, DataFrame]:
    return declarative.build_declarative(staging.latest_run(order_postings(spark, folder)), tables)


@query
def declarative_dimensions(spark, folder):
    return _dimension_rows(_declarative(spark, folder, "dim_country", "dim_city", "dim_company", "dim_skill"))


@query
def declarative_fact(spark, folder):
    return _plain_fact(_declarative(spark, folder, "fact_job_posting")["fact_job_posting"]).drop("publication_date_id")


@query
def declarative_bridge(spark, folder):
    return _declarative(spark, folder, "bridge_job_skill")["bridge_job_skill"]


# ---- upserts on their own -------------------------------------------------

@query
def insert_if_absent(spark, folder):
    """Companies by the run that brought them in."""
    relevant = M.relevant_postings(order_postings(spark, folder))
    seen = relevant.groupBy(rules.company_or_unknown().alias("company_name")).agg(F.min("extracted_at").alias("first_run"))
    later = relevant.where(F.col("extracted_at") > RUN_TIMES[0]).groupBy(
        rules.company_or_unknown().alias("company_name")
    ).agg(F.min("extracted_at").alias("first_run"))
    return dedup.insert_if_absent(seen.where(F.col("first_run") == RUN_TIMES[0]), later, ["company_name"])


@query
def country_name_overwrite(spark, folder):
    """Countries stored under their code, renamed by the later runs."""
    relevant = M.relevant_postings(order_postings(spark, folder))
    stored = M.countries_of(relevant, M.ModelOptions(country_name_mode="code"))
    later = M.countries_of(relevant.where(F.col("extracted_at") > RUN_TIMES[0]))
    return dedup.overwrite_by_key(stored, later, ["country_id"])


# ---- long texts -----------------------------------------------------------

def _skill_lists(texts: DataFrame, *keep: str) -> DataFrame:
    """Every text with the skills it names as one text."""
    masked = M.with_skill_mask(texts, "NULL", "text")
    return masked.select(*keep, F.concat_ws(",", rules.skills_in_mask()).alias("skills"))


@query
def skills_in_documents(spark, folder):
    return _skill_lists(read_table(spark, folder, "documents"), "doc_id")


@query
def work_mode_of_documents(spark, folder):
    return read_table(spark, folder, "documents").select(
        "doc_id", rules.work_mode("NULL", "text").alias("work_mode")
    )


@query
def skills_in_conversations(spark, folder):
    return _skill_lists(read_table(spark, folder, "conversations"), "conv_id", "turn")
