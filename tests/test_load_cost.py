"""What a load does once, and not once per row, pass or table."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from postingloom.functions import rules
from postingloom.operators import modelling as M
from postingloom.plans import load
from postingloom.registry.queries import queries
from postingloom.session import side_by_side
from postingloom.sources.warehouse import Warehouse

#: The spelling of a time as it was worked out before, by decimal seconds.
OLD_TIME = (
    "coalesce(date_format(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(CAST(unix_micros("
    "try_to_timestamp(IF(t RLIKE '(Z|[+-][0-9][0-9]:?[0-9][0-9])$', t, concat(t, 'Z')))) AS DECIMAL(18,0)) / 1000000"
    " AS DECIMAL(18,6))), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), t)"
)


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_times_and_keys_as_before(spark):
    texts = [
        "2026-09-07T06:00:00", "2026-09-21T08:00:00+02:00", "2026-09-14T23:00:00.123456-0300", "2026-02-30T00:00:00", "", None,
        "soon +02:00", "1969-12-31T23:59:59.999999Z", "0001-01-01T00:00:00", "-0044-03-15T00:00:00", "+12345-01-01T00:00:00",
        "2026-09-07", "2026", "12:00", "2026-09-07T06:00:00Z\n", "a:b-c.d+e/f é",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        rules.extraction_time_text("t").alias("time"), rules.run_key("t").alias("key"),
        F.expr(OLD_TIME).alias("old"), F.expr(f"regexp_replace({OLD_TIME}, '[^0-9A-Za-z]', '')").alias("old_key"),
    )
    for row in rows.collect():
        assert (row.time, row.key) == (row.old, row.old_key)
    assert "make_dt_interval" not in str(rules.extraction_time_text("t"))


def test_skill_keys_are_worked_out_once(spark):
    folded = spark.createDataFrame([("p", 0b101), ("q", 0)], "job_posting_id string, skill_mask bigint")
    pairs = M.bridge_of(folded, ["python", "sql", "o'caml"])
    named = folded.select("job_posting_id", F.explode(rules.skills_in_mask(["python", "sql", "o'caml"])).alias("s"))
    expected = named.select("job_posting_id", rules.surrogate_key("s").alias("skill_id")).collect()
    assert sorted(pairs.collect()) == sorted(expected) and len(expected) == 2
    assert "sha2" not in plan_of(pairs)


def test_empty_tables_start_no_worker(spark, tmp_path):
    for name, table in Warehouse(spark, str(tmp_path)).tables().items():
        assert table.count() == 0, name
        assert "RDD" not in plan_of(table), name


@pytest.mark.parametrize("name", ["load_with_faults", "marts_kept_current"])
def test_a_run_is_derived_once(spark, sf_dir, monkeypatch, name):
    plans, load_run = [], load.load_run

    def seen(staged, *args, **kwargs):
        plans.append(plan_of(staged))
        return load_run(staged, *args, **kwargs)

    monkeypatch.setattr(load, "load_run", seen)
    queries()[name](spark, sf_dir).collect()
    assert len(plans) == 3
    assert not any("Join" in plan for plan in plans)


def test_steps_side_by_side():
    both = threading.Barrier(2, timeout=20)
    assert side_by_side([lambda: both.wait() >= 0, lambda: both.wait() >= 0]) == [True, True]
    with pytest.raises(ZeroDivisionError):
        side_by_side([lambda: 1 / 0, lambda: 1])


def test_fold_and_outcomes_are_written_side_by_side(spark, monkeypatch):
    both, written = threading.Barrier(2, timeout=60), load.written

    def waiting(frame, purpose):
        both.wait()
        return written(frame, purpose)

    monkeypatch.setattr(load, "written", waiting)
    day = dt.date(2026, 9, 7)
    rows = [("src", str(k), "Data Engineer", "c", None, None, None, None, None, None, "sql", "u", "2026-09-07T06:00:00", k, day, None) for k in range(3)]
    staged = spark.createDataFrame(
        rows,
        "source string, external_id string, title string, company_name string, location string, country string, work_mode string,"
        " salary_min string, salary_max string, job_type string, description string, url string, extracted_at string,"
        " ordinal bigint, run_date date, publication_date string",
    )
    outcomes, fold = load.folded(staged)
    assert (outcomes.count(), fold.count()) == (3, 3)
