"""The fold and the run-by-run load against a plain row loop."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postingloom import schemas
from postingloom.functions import vocabulary as V
from postingloom.operators import mart_state, marts, merge
from postingloom.operators import modelling as M
from postingloom.plans import load
from postingloom.sources import staging
from postingloom.sources.warehouse import Warehouse

NOW = dt.datetime(2026, 9, 30)
TITLES = ["Data Engineer", "Senior Data Engineer", "Data Analyst (sales)", "Junior Data Analyst", "Cook", None]
TEXTS = ["Python and SQL", "Kafka", "", None, "Excel, remote"]
SCHEMA = (
    "source string, external_id string, title string, company_name string, location string, country string, "
    "work_mode string, salary_min string, salary_max string, job_type string, publication_date string, "
    "description string, url string, tags array<string>, extracted_at string, ordinal bigint, run_date date"
)


def sightings(seed, runs=4, rows=60):
    rnd = random.Random(seed)
    out = []
    for run in range(runs):
        day = dt.date(2026, 9, 1) + dt.timedelta(days=7 * run)
        for ordinal in range(rows):
            # One posting takes about a third of all rows.
            number = 0 if rnd.random() < 0.33 else rnd.randrange(25)
            out.append(
                (
                    rnd.choice(["remotive", "adzuna"]), str(number), rnd.choice(TITLES),
                    rnd.choice(["Acme", "Globex", "", None]),
                    rnd.choice(["Paris, France", "  Lyon , France", "Paris", None, ", x"]),
                    rnd.choice(["fr", "us", "", None]), rnd.choice(["remote", "on_site", None]),
                    rnd.choice(["None", "", None, "10.005", "abc"]), rnd.choice([None, "7"]),
                    rnd.choice(["full", None]), None, rnd.choice(TEXTS), f"u{run}-{ordinal}", [],
                    f"{day.isoformat()}T06:00:00", ordinal, day,
                )
            )
    return out


class RowLoop:
    """What loading row by row does, on dictionaries."""

    def __init__(self):
        self.facts, self.pairs = {}, set()
        self.countries, self.cities, self.companies, self.skills, self.dates = set(), set(), set(), set(), set()
        self.report = []

    def load(self, rows):
        inserted = updated = skipped = 0
        for row in rows:
            (source, number, title, company, location, country, mode, low, high, kind, _, text, url, _, _, _, day) = row
            self.dates.add(day)
            lowered = (title or "").lower()
            if not any(w in lowered for w in V.ROLE_WORDS) or any(w in lowered for w in V.OFF_TOPIC_WORDS):
                skipped += 1
                continue
            company = company or "Unknown"
            self.companies.add(company)
            city = None
            if country:
                self.countries.add(country.upper())
                if location and "," in location:
                    city = location.split(",")[0].strip() or None
                if city:
                    self.cities.add((city, country.upper()))
            level = "unknown"
            if any(w in lowered for w in V.SENIOR_WORDS):
                level = "senior"
            elif any(w in lowered for w in V.JUNIOR_WORDS):
                level = "junior"
            key = (source, number)
            if key in self.facts:
                self.facts[key].update(title=title, date_last_seen=day)
                updated += 1
            else:
                amounts = {"10.005": 10.01, "7": 7.0}
                self.facts[key] = dict(
                    title=title, company=company, city=city, country=country.upper() if city else None,
                    work_mode=mode, salary_min=amounts.get(low), salary_max=amounts.get(high), job_type=kind,
                    seniority_level=level, date_first_seen=day, date_last_seen=day, url=url, description=text,
                )
                inserted += 1
            both = f"{title or ''} {text or ''}".lower()
            for skill in V.SKILLS:
                if skill in both:
                    self.skills.add(skill)
                    self.pairs.add((*key, skill))
        self.report.append((inserted, updated, skipped))


def opened(tables):
    """Warehouse tables with keys replaced by what they stand for."""
    city = tables["dim_city"].join(tables["dim_country"], "country_id")
    fact = (
        tables["fact_job_posting"]
        .join(tables["dim_company"], "company_id")
        .join(city.select("city_id", "city_name", "country_code"), "city_id", "left")
    )
    facts = {
        (r.source, r.external_id): dict(
            title=r.title, company=r.company_name, city=r.city_name, country=r.country_code, work_mode=r.work_mode,
            salary_min=None if r.salary_min is None else float(r.salary_min),
            salary_max=None if r.salary_max is None else float(r.salary_max),
            job_type=r.job_type, seniority_level=r.seniority_level, date_first_seen=r.date_first_seen,
            date_last_seen=r.date_last_seen, url=r.url, description=r.description,
        )
        for r in fact.collect()
    }
    pairs = tables["bridge_job_skill"].join(tables["dim_skill"], "skill_id").join(
        tables["fact_job_posting"].select("job_posting_id", "source", "external_id"), "job_posting_id"
    )
    return facts, [tuple(r) for r in pairs.select("source", "external_id", "skill_name").collect()]


def check(tables, model):
    facts, pairs = opened(tables)
    assert facts == model.facts
    assert len(pairs) == len(set(pairs)) and set(pairs) == model.pairs
    assert {r.country_code for r in tables["dim_country"].collect()} == model.countries
    assert {r.company_name for r in tables["dim_company"].collect()} == model.companies
    assert {r.skill_name for r in tables["dim_skill"].collect()} == model.skills
    assert {r.date_id for r in tables["dim_date"].collect()} == model.dates
    cities = tables["dim_city"].join(tables["dim_country"], "country_id").select("city_name", "country_code")
    assert {tuple(r) for r in cities.collect()} == model.cities


def runs_of(rows):
    runs = {}
    for row in rows:
        runs.setdefault(row[14], []).append(row)
    return [runs[k] for k in sorted(runs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_row_loop(spark, seed):
    rows = sightings(seed)
    model = RowLoop()
    for run in runs_of(rows):
        model.load(run)
    shuffled = random.Random(seed).sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, SCHEMA).repartition(5)
    check(M.build_warehouse(frame), model)
    report = merge.replay_report(frame).orderBy("extracted_at")
    assert [(r.inserted, r.updated, r.skipped) for r in report.collect()] == model.report


@pytest.mark.parametrize("seed", [4, 5])
def test_run_by_run_equals_row_loop(spark, tmp_path, seed):
    rows = sightings(seed, runs=3)
    model, path = RowLoop(), str(tmp_path / "staging")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"), buckets=4)
    for run in runs_of(rows):
        model.load(run)
        staging.append(staging.to_staging(spark.createDataFrame(run, SCHEMA), NOW), path)
        report = load.load_latest_run(spark, path, warehouse, NOW)
        assert (report["inserted"], report["updated"], report["skipped"]) == model.report[-1]
        check(warehouse.tables(), model)

    # Loading the newest run again inserts nothing and changes nothing.
    before = {n: sorted(map(str, t.collect())) for n, t in warehouse.tables().items()}
    assert load.load_latest_run(spark, path, warehouse, NOW)["inserted"] == 0
    assert {n: sorted(map(str, t.collect())) for n, t in warehouse.tables().items()} == before

    # A replay of everything gives the same tables.
    load.replay(staging.read(spark, path), warehouse, NOW)
    assert {n: sorted(map(str, t.collect())) for n, t in warehouse.tables().items()} == before


def test_staging_a_run_twice_changes_counts_only(spark):
    rows = sightings(6, runs=2)
    once, twice = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows + rows, SCHEMA)
    for name, table in M.build_warehouse(once).items():
        other = M.build_warehouse(twice)[name]
        assert sorted(map(str, table.collect())) == sorted(map(str, other.collect())), name


def test_title_that_turns_irrelevant_leaves_the_posting_alone(spark):
    base = sightings(7, runs=1, rows=1)[0]
    row = lambda title, day, n: (*base[:2], title, *base[3:14], f"{day}T06:00:00", n, dt.date.fromisoformat(day))
    frame = spark.createDataFrame(
        [row("Data Analyst", "2026-09-01", 0), row("Sales Data Analyst", "2026-09-08", 0)], SCHEMA
    )
    fact = M.build_warehouse(frame)["fact_job_posting"].first()
    assert (fact.title, fact.date_last_seen) == ("Data Analyst", dt.date(2026, 9, 1))


def test_merging_an_older_run_keeps_the_newer_title(spark):
    rows = sightings(8, runs=2)
    early, late = runs_of(rows)
    fold = lambda r: M.fold(M.relevant_postings(spark.createDataFrame(r, SCHEMA))).drop("skill_mask", "sightings")
    forth, back = merge.merge_fact(fold(early), fold(late)), merge.merge_fact(fold(late), fold(early))
    assert sorted(map(str, forth.collect())) == sorted(map(str, back.collect()))


def test_options_change_names_cities_skills_and_companies(spark):
    frame = spark.createDataFrame(sightings(9, runs=1), SCHEMA).where(F.col("country") != "")
    options = M.ModelOptions("code", trim_city=False, seed_all_skills=True, blank_company_is_unknown=False)
    tables = M.build_warehouse(frame, options)
    assert all(r.country_name == r.country_code for r in tables["dim_country"].collect())
    assert "  Lyon " in {r.city_name for r in tables["dim_city"].collect()}
    assert tables["dim_skill"].count() == len(V.SKILLS)
    assert "" in {r.company_name for r in tables["dim_company"].collect()}


@pytest.mark.parametrize("n", [70, 200])
def test_a_vocabulary_of_any_length(spark, tmp_path, n):
    """Run by run with more skills than one mask holds: pairs add up as in the row loop."""
    skills = tuple(f"tool{k:03d}" for k in range(n))
    rnd = random.Random(n)
    rows = [
        (*r[:11], " ".join(rnd.choices([*skills, "filler"], k=rnd.randrange(6))), *r[12:])
        for r in sightings(n, runs=2, rows=40)
    ]
    options, pairs = M.ModelOptions(skills=skills), set()
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for run in runs_of(rows):
        load.load_run(spark.createDataFrame(run, SCHEMA), warehouse, run[0][14], NOW, options)
        for r in run:
            title = (r[2] or "").lower()
            if any(w in title for w in V.ROLE_WORDS) and not any(w in title for w in V.OFF_TOPIC_WORDS):
                pairs |= {(r[0], r[1], s) for s in skills if s in r[11]}
    _, found = opened(warehouse.tables())
    assert len(found) == len(set(found)) and set(found) == pairs
    assert {r.skill_name for r in warehouse.tables()["dim_skill"].collect()} == {s for _, _, s in pairs}


def test_marts_of_an_empty_warehouse(spark):
    tables = {n: spark.createDataFrame([], s) for n, s in schemas.WAREHOUSE.items()}
    frames = marts.all_marts(tables)
    assert tuple(frames["mart_kpi_summary"].first()) == (0, 0, None, 0, None)
    for name, frame in frames.items():
        if name != "mart_kpi_summary":
            assert frame.collect() == [], name


def test_marts_by_hand(spark):
    rows = [r for r in sightings(10, runs=1)]
    tables = M.build_warehouse(spark.createDataFrame(rows, SCHEMA))
    facts, pairs = opened(tables)
    total = len(facts)
    demand = marts.all_marts(tables)["mart_skill_demand"].collect()
    assert {r.skill_name: r.job_count for r in demand} == {
        s: sum(p[2] == s for p in pairs) for s in {p[2] for p in pairs}
    }
    assert all(abs(r.pct_du_total - 100 * r.job_count / total) <= 0.05 + 1e-9 for r in demand)
    assert [r.job_count for r in demand] == sorted((r.job_count for r in demand), reverse=True)
    assert len(marts.top_skills(marts.all_marts(tables)["mart_skill_demand"], 2).collect()) == 2
    places = marts.all_marts(tables)["mart_geography_demand"].collect()
    # A known country without a city is shown as unspecified.
    unplaced = sum(f["city"] is None for f in facts.values())
    assert sum(r.job_count for r in places if r.country_name == V.NO_COUNTRY_LABEL) == unplaced
    assert sum(r.job_count for r in places) == total


def test_views_answer_sql(spark):
    marts.create_views(M.build_warehouse(spark.createDataFrame(sightings(11, runs=1), SCHEMA)))
    a = spark.sql("SELECT total_job_postings FROM mart_kpi_summary").first()[0]
    assert a == spark.sql("SELECT count(*) FROM fact_job_posting").first()[0] > 0


def test_publication_days_are_keys_of_the_calendar(spark, tmp_path):
    texts = ["2026-08-30T10:00:00", "2026-08-31", "2026-02-30", "soon", "", None, "2026", "2026-08-30 and more"]
    rows = [(*r[:10], texts[k % len(texts)], *r[11:]) for k, r in enumerate(sightings(12, runs=2))]
    day = {texts[0]: dt.date(2026, 8, 30), texts[1]: dt.date(2026, 8, 31), texts[7]: dt.date(2026, 8, 30)}
    first = {}
    for r in rows:
        title = (r[2] or "").lower()
        if any(w in title for w in V.ROLE_WORDS) and not any(w in title for w in V.OFF_TOPIC_WORDS):
            first.setdefault((r[0], r[1]), day.get(r[10]))
    options = M.ModelOptions(publication_dates=True)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for run in runs_of(rows):
        load.load_run(spark.createDataFrame(run, SCHEMA), warehouse, run[0][14], NOW, options, run_date=run[0][16])
    tables = warehouse.tables()
    found = {(r.source, r.external_id): r.publication_date_id for r in tables["fact_job_posting"].collect()}
    assert found == first and any(first.values())
    days = {r.date_id for r in tables["dim_date"].collect()}
    assert {d for d in first.values() if d} <= days and {r[16] for r in rows} <= days
    off = M.build_warehouse(spark.createDataFrame(rows, SCHEMA))
    assert off["fact_job_posting"].where("publication_date_id IS NOT NULL").count() == 0
    assert {r.date_id for r in off["dim_date"].collect()} == {r[16] for r in rows}


def test_marts_kept_current_equal_recomputed_ones(spark, tmp_path):
    """After each of four runs, after a run loaded again and after an older one; counts follow the run alone."""
    runs = runs_of(sightings(13))
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for run in [runs[1], runs[2], runs[2], runs[0], runs[3]]:
        load.load_run(spark.createDataFrame(run, SCHEMA), warehouse, run[0][14], NOW, keep_marts=True)
        tables = warehouse.tables()
        kept, again = mart_state.marts_of(warehouse.mart_state(), tables), marts.all_marts(tables)
        for name in again:
            assert list(map(tuple, kept[name].collect())) == list(map(tuple, again[name].collect())), name
    none = {n: spark.createDataFrame([], s) for n, s in schemas.WAREHOUSE.items()}
    assert mart_state.difference(warehouse.tables(), none).count() == 0
    same = mart_state.difference(warehouse.tables(), {**none, "fact_job_posting": warehouse.tables()["fact_job_posting"]})
    assert same.count() == 0


def test_marts_start_from_a_version_without_counts(spark, tmp_path):
    first, second, *_ = runs_of(sightings(14))
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    load.load_run(spark.createDataFrame(first, SCHEMA), warehouse, first[0][14], NOW)
    assert warehouse.mart_state() is None
    load.load_run(spark.createDataFrame(second, SCHEMA), warehouse, second[0][14], NOW, keep_marts=True)
    kept = mart_state.marts_of(warehouse.mart_state(), warehouse.tables())["mart_skill_demand"].collect()
    assert kept == marts.all_marts(warehouse.tables())["mart_skill_demand"].collect()
