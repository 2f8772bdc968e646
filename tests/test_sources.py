"""Feeds, raw zone, staging, published versions, stream."""

import datetime as dt
import glob
import json
import os

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from postingloom import schemas, session
from postingloom.operators import marts, merge
from postingloom.operators import modelling as M
from postingloom.operators import normalize as N
from postingloom.plans import extract, load, stage
from postingloom.registry import queries as Q
from postingloom.sources import feeds, raw_zone, staging
from postingloom.sources.order_postings import order_postings
from postingloom.sources.warehouse import Warehouse
from postingloom.streaming.staging_stream import stage_new_documents

NOW = dt.datetime(2026, 9, 30)


def put(path, document):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(document, f, indent=2)


@pytest.fixture
def landing(tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    put(f"{a}/run=r1/term=00/x.json", {"jobs": [
        {"id": 7, "title": "Data Engineer", "description": "SQL", "tags": ["t"], "company_name": "Acme",
         "candidate_required_location": "Worldwide", "unexpected": {"k": 1}},
        {"id": 8, "title": "Data Analyst"},
        {"title": "no id"},
    ]})
    put(f"{a}/run=r1/term=01/x.json", {"jobs": [
        {"id": 7, "title": "Data Engineer II", "description": None},
        {"id": 8, "title": "DevOps now"},
        {"id": 9},
    ]})
    put(f"{a}/run=r1/term=02/x.json", {"message": "nothing found"})
    put(f"{b}/run=r1/country=ch/term=00/x.json", {"results": [
        {"id": "7", "title": "In CH", "company": {"display_name": "Globex"}, "location": {"display_name": "Bern, CH"},
         "salary_min": 50000.5, "contract_time": "full_time", "created": "2026-09-01", "redirect_url": "u"},
    ]})
    put(f"{b}/run=r1/country=fr/term=00/x.json", {"results": [{"id": "7", "title": "In FR"}, {"id": None}]})
    put(f"{b}/run=r1/country=ch/term=01/x.json", {"results": [{"id": "7", "title": "In CH again"}, {"id": "5", "title": "SRE"}]})
    return a, b


def test_feeds_are_merged_last_wins(spark, landing):
    merged = N.merge_feeds(feeds.read_source_a(spark, landing[0]), feeds.read_source_b(spark, landing[1]))
    rows = {(r.source, r.external_id): r for r in merged.collect()}
    assert set(rows) == {("remotive", "7"), ("remotive", "9"), ("adzuna", "7"), ("adzuna", "5")}
    # The later term won; its missing fields are not filled from the earlier.
    seven = rows["remotive", "7"]
    assert (seven.title, seven.description, seven.tags, seven.company_name) == ("Data Engineer II", "", [], None)
    # Posting 8 ended as noise and is gone; feed B keeps such titles.
    assert rows["remotive", "9"].title == ""
    # France is requested after Switzerland, whatever the term.
    b = rows["adzuna", "7"]
    assert (b.title, b.country, b.copies, b.tags) == ("In FR", "fr", 3, [])
    report = N.extraction_report(merged).first()
    assert (report.job_count, report.count_a, report.count_b) == (4, 2, 4)


def test_feed_counts_and_missing_ids(spark, landing):
    a, b = feeds.read_source_a(spark, landing[0]), feeds.read_source_b(spark, landing[1])
    counts = {(r.feed, r.country, r.term): (r.jobs, r.without_id) for r in extract.feed_counts(a, b).collect()}
    assert counts == {
        ("a", None, 0): (3, 1), ("a", None, 1): (3, 0), ("b", "ch", 0): (1, 0), ("b", "ch", 1): (2, 0), ("b", "fr", 0): (2, 1),
    }
    assert N.without_id(a).count() == 1


def test_nested_fields_and_numbers_as_text(spark, landing):
    jobs = feeds.read_source_b(spark, landing[1]).where("country = 'ch' AND feed_order.t = 0")
    row = N.normalize_source_b(jobs).first()
    assert (row.company_name, row.location, row.salary_min, row.job_type, row.url) == (
        "Globex", "Bern, CH", "50000.5", "full_time", "u")


def test_extract_stage_load(spark, landing, tmp_path):
    root, table = f"{tmp_path}/raw", f"{tmp_path}/staging"
    a, b = (f"{p}" for p in landing)
    # Runs are named by their extraction time.
    jobs_a = feeds.read_source_a(spark, a).withColumn("run", F.lit("2026-09-07T06:00:00"))
    jobs_b = feeds.read_source_b(spark, b).withColumn("run", F.lit("2026-09-07T06:00:00"))
    assert extract.extract(jobs_a, jobs_b, root).first().job_count == 4
    assert glob.glob(f"{root}/year=2026/month=09/day=07/*.json")
    assert stage.stage_latest_day(spark, root, table, NOW, run_date=dt.date(2026, 9, 8)) == 4
    envelope = raw_zone.read_payloads(spark, root).where("job_count IS NOT NULL").first()
    assert envelope.sources == ["remotive", "adzuna"] and envelope.job_count == 4
    assert envelope.job_count_by_source == {"remotive": 2, "adzuna": 4}
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    assert load.load_latest_run(spark, table, warehouse, NOW) == {"inserted": 1, "updated": 0, "skipped": 3, "quarantined": 0}
    fact = warehouse.tables()["fact_job_posting"].first()
    assert (fact.title, fact.date_first_seen) == ("Data Engineer II", dt.date(2026, 9, 8))
    load.refresh_marts(warehouse)
    assert warehouse.read_mart("mart_kpi_summary").first().total_job_postings == 1


def test_pretty_printed_document_of_a_whole_day(spark, tmp_path):
    root = f"{tmp_path}/raw"
    jobs = [{"source": "adzuna", "external_id": str(i), "title": "Data Engineer"} for i in range(5)]
    document = {"extracted_at": "2026-09-07T06:00:00+00:00", "sources": ["remotive", "adzuna"], "job_count": 5,
                "job_count_by_source": {"remotive": 0, "adzuna": 5}, "jobs": jobs}
    put(f"{root}/year=2026/month=09/day=07/jobs.json", document)
    put(f"{root}/year=2026/month=10/day=01/jobs.json", {**document, "extracted_at": "2026-10-01T06:00:00", "jobs": jobs[:2]})
    put(f"{root}/year=2025/month=12/day=31/jobs.json", {**document, "jobs": []})
    assert raw_zone.latest_day_path(spark, root).endswith("year=2026/month=10/day=01")
    table = f"{tmp_path}/staging"
    assert stage.stage_latest_day(spark, root, table, NOW, multi_line=True) == 2
    assert stage.stage_path(spark, f"{root}/year=2026/month=09/day=07", table, NOW, multi_line=True) == 5
    rows = staging.read(spark, table)
    assert sorted(r.ordinal for r in rows.where("run_key LIKE '202609%'").collect()) == [0, 1, 2, 3, 4]
    assert staging.latest_run_key(spark, table) == "20261001T060000000000"
    newest = staging.read_run(spark, table, "20261001T060000000000")
    assert newest.count() == 2 and "PartitionFilters: [isnotnull(run_key" in plan_of(newest)
    # Absent keys are NULL; a missing array stages nothing.
    assert newest.first().company_name is None
    put(f"{root}/year=2026/month=11/day=01/jobs.json", {"extracted_at": "x"})
    assert stage.stage_latest_day(spark, root, table, NOW, multi_line=True) == 0


def test_empty_raw_zone_is_an_error(spark, tmp_path):
    with pytest.raises(raw_zone.EmptyRawZone):
        raw_zone.latest_day_path(spark, str(tmp_path))


def test_broken_payload_is_an_error(spark, tmp_path):
    path = f"{tmp_path}/year=2026/month=01/day=01"
    os.makedirs(path)
    with open(f"{path}/jobs.json", "w") as f:
        f.write('{"jobs": [')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        raw_zone.read_payloads(spark, path).collect()


def test_day_path():
    assert raw_zone.day_path("s3a://x/raw/", dt.date(2026, 9, 4)) == "s3a://x/raw/year=2026/month=09/day=04"


def test_latest_run_of_nothing(spark, sf_dir):
    rows = order_postings(spark, sf_dir).withColumn("extracted_at", F.lit(None).cast("string"))
    assert staging.latest_run(rows).count() == 0


def test_unpublished_version_is_not_seen(spark, tmp_path, sf_dir):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    assert warehouse.current() is None and warehouse.tables()["fact_job_posting"].count() == 0
    rows = order_postings(spark, sf_dir)
    tables = M.build_warehouse(rows)
    warehouse.publish(tables, None, None, NOW)
    count = warehouse.tables()["fact_job_posting"].count()

    broken = dict(tables, dim_date=tables["dim_date"].withColumn("day", F.raise_error(F.lit("stop")).cast("int")))
    with pytest.raises(Exception, match="stop"):
        warehouse.publish(broken, warehouse.current(), None, NOW)
    assert warehouse.current().version == 1 and warehouse.tables()["fact_job_posting"].count() == count
    # The next load writes over what the failed one left.
    assert warehouse.publish(tables, warehouse.current(), None, NOW) == 2
    assert warehouse.tables()["fact_job_posting"].count() == count


def test_merge_leaves_stored_tables_where_they_are(spark, tmp_path, sf_dir):
    rows = staging.to_staging(order_postings(spark, sf_dir), NOW)
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=4)
    for time in Q.RUN_TIMES:
        load.load_run(rows.where(F.col("extracted_at").startswith(time)), warehouse, time, NOW)
    version = warehouse.current().version
    for table in ("fact_job_posting", "bridge_job_skill"):
        files = [f.rsplit("_", 1)[1][:5] for f in glob.glob(f"{tmp_path}/w/v{version:06d}/{table}/*.parquet")]
        assert len(files) == len(set(files)) <= 4

    stored = warehouse.tables()
    run = M.fold(M.relevant_postings(rows))
    path = str(tmp_path / "folded")
    run.write.parquet(path)
    run = spark.read.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = plan_of(merge.merge_fact(stored["fact_job_posting"], run.drop("skill_mask", "sightings")))
        bridge = plan_of(merge.merge_bridge(stored["bridge_job_skill"], M.bridge_of(run), 4))
        pairs = stored["bridge_job_skill"].join(stored["fact_job_posting"], "job_posting_id")
        joined = plan_of(pairs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert fact.count("Exchange") == 1 and bridge.count("Exchange") == 1 and joined.count("Exchange") == 0
    assert marts.skill_by_seniority(stored["fact_job_posting"], stored["bridge_job_skill"], stored["dim_skill"]).count()


def test_stream_stages_each_document_once(spark, tmp_path, sf_dir):
    root, table, state = f"{tmp_path}/raw", f"{tmp_path}/staging", f"{tmp_path}/state"
    a, b = Q._feeds(spark, sf_dir)
    first, second = Q.RUN_TIMES[:2]
    only = lambda jobs, time: jobs.where(F.col("run") == time)
    extract.extract(only(a, first), only(b, first), root)
    for _ in range(2):
        stage_new_documents(spark, root, table, state, NOW).awaitTermination()
    once = staging.read(spark, table).count()
    assert once == raw_zone.postings_of(raw_zone.read_payloads(spark, root)).count() > 0
    extract.extract(only(a, second), only(b, second), root)
    stage_new_documents(spark, root, table, state, NOW, files_per_batch=1).awaitTermination()
    assert staging.read(spark, table).count() == raw_zone.postings_of(raw_zone.read_payloads(spark, root)).count() > once


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/postingloom/x-")


def test_newest_partition_with_files_is_taken(spark, tmp_path):
    root = f"{tmp_path}/raw"
    put(f"{root}/year=2026/month=02/day=03/jobs.json", {"jobs": []})
    put(f"{root}/year=2026/month=01/day=30/jobs.json", {"jobs": []})
    os.makedirs(f"{root}/year=2026/month=03/day=01")
    assert raw_zone.latest_day_path(spark, root).endswith("/year=2026/month=02/day=03")
    assert staging.latest_run_key(spark, f"{tmp_path}/none") is None


def test_streamed_staging_is_loaded(spark, tmp_path, sf_dir):
    root, table = f"{tmp_path}/raw", f"{tmp_path}/staging"
    extract.extract(*Q._feeds(spark, sf_dir), root)
    stage_new_documents(spark, root, table, f"{tmp_path}/state", NOW).awaitTermination()
    key = staging.latest_run_key(spark, table)
    run = staging.read_run(spark, table, key)
    assert key.startswith("20260921") and run.count() == staging.read(spark, table).where(F.col("run_key") == key).count()
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    report = load.load_latest_run(spark, table, warehouse, NOW)
    assert report["inserted"] == warehouse.tables()["fact_job_posting"].count() > 0


def test_a_day_of_both_forms_needs_no_hint(spark, tmp_path):
    """Lines, a pretty-printed document, one on a single line, an empty file and a blank first line, side by side."""
    job = lambda n: {"source": "adzuna", "external_id": str(n), "title": "Data Engineer"}
    envelope = lambda *numbers: {"extracted_at": "2026-09-07T06:00:00", "jobs": [job(n) for n in numbers]}
    day = tmp_path / "raw" / "year=2026" / "month=09" / "day=07"
    day.mkdir(parents=True)
    (day / "a.json").write_text("".join(json.dumps(envelope(n)) + "\n" for n in range(50)))
    (day / "b.json").write_text(json.dumps(envelope(50, 51, 52), indent=2))
    (day / "c.json").write_text(json.dumps(envelope(53, 54)))
    (day / "d.json").write_text("")
    (day / "e.json").write_text("\n  \n" + json.dumps(envelope(55), indent=2) + "\n")
    (day / "f.json").write_text(json.dumps({"extracted_at": "2026-09-07T06:00:00", "jobs": []}, indent=2))
    assert sorted(os.path.basename(f) for f in raw_zone.spread_documents(spark, str(day))) == ["b.json", "e.json", "f.json"]
    table = f"{tmp_path}/staging"
    assert stage.stage_latest_day(spark, f"{tmp_path}/raw", table, NOW) == 56
    assert sorted(int(r.external_id) for r in staging.read(spark, table).collect()) == list(range(56))


def test_a_broken_line_fails_the_read_in_either_form(spark, tmp_path):
    whole = json.dumps({"extracted_at": "2026-09-07T06:00:00", "jobs": []})
    for name, text in (("one", whole + "\n" + whole[:-4] + "\n"), ("both", whole + "\n" + whole[:-4] + "\n")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.json").write_text(text)
        if name == "both":
            (folder / "b.json").write_text(json.dumps(json.loads(whole), indent=2))
        with pytest.raises(Exception, match="(?i)malformed"):
            raw_zone.read_payloads(spark, str(folder)).collect()


def test_a_batch_delivered_twice_changes_nothing(spark, tmp_path):
    from postingloom.streaming.load_stream import batch_loader

    rows = spark.createDataFrame(
        [("adzuna", str(n), "Data Engineer", "2026-09-07T06:00:00", n, dt.date(2026, 9, 7), "20260907T060000000000") for n in range(9)],
        "source string, external_id string, title string, extracted_at string, ordinal bigint, run_date date, run_key string",
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.STAGING.fields if f.name not in rows.columns]
    staged = rows.select("*", *missing)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    once, other = batch_loader(warehouse, "s", NOW), batch_loader(warehouse, "t", NOW)
    once(staged.where("ordinal < 6"), 0)
    assert warehouse.current().version == 1
    once(staged.where("ordinal < 6"), 0)
    assert warehouse.current().version == 1 and warehouse.tables()["fact_job_posting"].count() == 6
    once(staged.where("ordinal >= 4"), 1)
    other(staged, 0)
    assert warehouse.current().version == 3 and warehouse.tables()["fact_job_posting"].count() == 9

