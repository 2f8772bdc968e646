"""Row rules on literal cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postingloom.functions import rules
from postingloom.functions import vocabulary as V
from postingloom.operators.modelling import skill_rows, with_skill_mask


def evaluate(spark, schema, rows, column):
    return [r.out for r in spark.createDataFrame(rows, schema).select(column.alias("out")).collect()]


def test_light_title_filter_drops_only_noise(spark):
    titles = ["Senior DevOps Engineer", "Data Engineer", "Random Marketing Role", "Data Analyst", "Misread title", None]
    noisy = evaluate(spark, "title string", [(t,) for t in titles], rules.is_noise())
    # "Misread" holds the letters s-r-e: tests are bare substrings.
    assert noisy == [True, False, False, False, True, False]


@pytest.mark.parametrize("n", [63, 64, 70, 200])
def test_more_skills_than_bits_of_a_number(spark, n):
    """Each skill alone, all of them, none; names that contain others."""
    skills = [f"skill{k:03d}" for k in range(n - 2)] + ["skill", "l00"]
    texts = [*skills, " ".join(skills), "nothing", None]
    rows = spark.createDataFrame([("", t, k) for k, t in enumerate(texts)], "title string, description string, k int")
    masked = with_skill_mask(rows, skills=skills)
    assert [c for c in masked.columns if c.startswith("skill_mask")] == rules.mask_names(skills)
    assert len(rules.mask_names(skills)) == -(-n // 63)
    found = {r.k: r.s for r in masked.select("k", rules.skills_in_mask(skills).alias("s")).collect()}
    for k, text in enumerate(texts):
        assert found[k] == [s for s in skills if s in (text or "")]


@pytest.mark.parametrize(
    "title, expected",
    [
        ("Senior Data Engineer", True),
        ("Data Analyst", True),
        ("Sales Jedi", False),
        ("Data Platform Developer", False),
        ("Data Engineer and writer", False),
        ("BUSINESS INTELLIGENCE Lead", True),
        ("", False),
        (None, False),
    ],
)
def test_relevance(spark, title, expected):
    assert evaluate(spark, "title string", [(title,)], rules.is_relevant()) == [expected]


@pytest.mark.parametrize(
    "title, description, expected",
    [
        ("Data Engineer", "We use Python and SQL daily", ["python", "sql"]),
        ("Sales Manager", "No tech skills mentioned here", []),
        ("PYTHON Developer", "We need PYTHON expertise", ["python"]),
        ("x", "PostgreSQL", ["sql", "postgresql"]),
        ("x", "excellent MySQL, NoSQL", ["sql", "excel", "mysql", "nosql"]),
        ("Data Engineer - Power", "BI tools", ["power bi"]),
        (None, None, []),
        (None, "kafka", ["kafka"]),
    ],
)
def test_skills(spark, title, description, expected):
    row = [(title, description)]
    schema = "title string, description string"
    frame = spark.createDataFrame(row, schema)
    assert with_skill_mask(frame).select(rules.skills_in_mask()).first()[0] == expected
    assert [r.skill_name for r in skill_rows(frame).collect()] == expected
    assert [(r.position, r.skill_name) for r in skill_rows(frame, positions=True).collect()] == list(enumerate(expected))


def test_every_skill_has_its_own_bit(spark):
    rows = spark.createDataFrame([("", skill) for skill in V.SKILLS], "title string, description string")
    found = [r[0] for r in with_skill_mask(rows).select(rules.skills_in_mask()).collect()]
    for skill, skills in zip(V.SKILLS, found):
        assert skills == [s for s in V.SKILLS if s in skill]


@pytest.mark.parametrize(
    "title, expected",
    [
        ("Senior Data Engineer", "senior"),
        ("Junior Data Analyst", "junior"),
        ("Data Engineer", "unknown"),
        ("Lead Data Engineer", "senior"),
        ("Junior Lead", "senior"),
        ("Sr Data Engineer", "senior"),
        ("Data Engineer Sr", "unknown"),
        ("sr.data", "senior"),
        ("srxdata", "unknown"),
        ("Internal Tools", "junior"),
        (None, "unknown"),
    ],
)
def test_seniority_both_ways(spark, title, expected):
    assert evaluate(spark, "title string", [(title,)], rules.seniority()) == [expected]
    assert evaluate(spark, "title string", [(title,)], rules.seniority_by_regex()) == [expected]


@pytest.mark.parametrize(
    "title, description, expected",
    [
        ("Data Engineer", "no remote, hybrid", "on_site"),
        ("Remote", "Hybrid", "hybrid"),
        ("x", "Work from HOME", "remote"),
        ("Remote", None, "remote"),
        ("this is no", "remote job", "on_site"),
        (None, None, "unknown"),
    ],
)
def test_work_mode_order(spark, title, description, expected):
    row = [(title, description)]
    assert evaluate(spark, "title string, description string", row, rules.work_mode()) == [expected]


@pytest.mark.parametrize(
    "country, location, code, city",
    [
        ("ch", "Zürich, Switzerland", "CH", "Zürich"),
        (None, "Worldwide", None, None),
        (None, "Paris, France", None, None),
        ("", "Paris, France", None, None),
        ("fr", "Paris", "FR", None),
        ("fr", None, "FR", None),
        ("fr", "\u00a0\t Paris\u2003\x1f, Ile, France", "FR", "Paris"),
        ("fr", ", France", "FR", ""),
    ],
)
def test_geography(spark, country, location, code, city):
    frame = spark.createDataFrame([(country, location)], "country string, location string")
    assert tuple(frame.select(rules.country_code(), rules.city_name()).first()) == (code, city)


def test_stripping_agrees_with_python(spark):
    candidates = [chr(c) for c in (*range(1, 0x300), *range(0x1FF0, 0x2070), 0x3000, 0xFEFF, 0x180E, 0x1680)]
    rows = [("xx", f"{c}a{c},b") for c in candidates if c != ","]
    got = evaluate(spark, "country string, location string", rows, rules.city_name())
    assert got == [location.split(",")[0].strip() for _, location in rows]


@pytest.mark.parametrize(
    "text, amount, malformed",
    [
        ("45000.125", "45000.13", False), ("45000.124", "45000.12", False), ("0", "0.00", False),
        ("-0.005", "-0.01", False), ("1e3", "1000.00", False), ("None", None, False), ("", None, False),
        (None, None, False), ("NaN", None, True), ("12d", None, True), ("100000000", None, True), ("n/a", None, True),
    ],
)
def test_salary(spark, text, amount, malformed):
    frame = spark.createDataFrame([(text,)], "s string")
    got = frame.select(rules.salary("s").cast("string"), rules.salary_is_malformed("s")).first()
    assert tuple(got) == (amount, malformed)


def test_country_name_and_company(spark):
    rows = [("ch",), ("GB",), ("us",), (None,)]
    assert evaluate(spark, "country_code string", rows, rules.country_name()) == [
        "Switzerland", "United Kingdom", "US", None,
    ]
    rows = [("Acme",), ("",), (None,)]
    assert evaluate(spark, "company_name string", rows, rules.company_or_unknown()) == ["Acme", "Unknown", "Unknown"]


def test_extraction_time_spellings(spark):
    rows = [
        ("2026-09-07T06:00:00.000120",), ("2026-09-07T06:00:00",), ("2026-09-07T06:00:00.5+00:00",),
        ("2026-09-07T08:00:00+02:00",), ("2026-09-07T06:00:00Z",), ("whenever",), (None,),
    ]
    expected = [
        "2026-09-07T06:00:00.000120", "2026-09-07T06:00:00.000000", "2026-09-07T06:00:00.500000",
        "2026-09-07T06:00:00.000000", "2026-09-07T06:00:00.000000", "whenever", None,
    ]
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert evaluate(spark, "extracted_at string", rows, rules.extraction_time_text()) == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert evaluate(spark, "extracted_at string", rows[1:2], rules.run_key()) == ["20260907T060000000000"]


def test_calendar(spark):
    days = [dt.date(2026, 9, 7), dt.date(2027, 1, 1), dt.date(2024, 12, 30)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(*rules.calendar_fields("d")).collect()
    for day, row in zip(days, rows):
        assert tuple(row) == (day, day.year, day.month, day.day, day.isocalendar()[1], day.strftime("%A"))


def test_percentages_are_half_up_and_null_for_nothing(spark):
    rows = [(1, 8, 12.5), (1, 16, 6.3), (1, 2000, 0.1), (1, 2001, 0.0), (3, 3, 100.0), (0, 5, 0.0), (0, 0, None)]
    frame = spark.createDataFrame([(p, t) for p, t, _ in rows], "p bigint, t bigint")
    assert [r[0] for r in frame.select(rules.percent_of("p", "t")).collect()] == [e for *_, e in rows]


def test_keys_tell_parts_apart_and_pass_null_on(spark):
    frame = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "c")], "a string, b string")
    first, second, third = [r[0] for r in frame.select(rules.surrogate_key("a", "b")).collect()]
    assert len(first) == 32 and first != second and third is None


def test_rules_need_no_python_worker(spark):
    from compare import plan_of

    schema = "title string, description string, country string, location string, salary_min string"
    frame = with_skill_mask(spark.createDataFrame([], schema)).select(
        rules.work_mode(), rules.is_relevant(), rules.seniority(), rules.city_name(), rules.salary("salary_min"),
        F.size(rules.skills_in_mask()),
    )
    assert "EvalPython" not in plan_of(frame)
