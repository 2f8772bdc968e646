"""Joins on keys of which one holds a third of the rows."""

import glob
import json
import os
import random
import statistics
import subprocess
import sys

import pytest

from postingloom.operators import heavy


def rows_and_lookup(spark, n=900):
    rng = random.Random(n)
    keys = lambda: rng.choice(["hot", "hot", "hot", None, *(f"k{rng.randrange(200)}" for _ in range(4))])
    rows = [(k, keys(), rng.choice([None, "x", "x", "y"])) for k in range(n)]
    lookup = [(key, other, f"{key}-{other}") for key in ["hot", *(f"k{k}" for k in range(0, 200, 2))] for other in ("x", "y")]
    return rows, lookup, spark.createDataFrame(rows, "n int, a string, b string"), spark.createDataFrame(lookup, "a string, b string, v string")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.002, 0.3, 2.0])
def test_equals_a_plain_join(spark, how, share):
    rows, lookup, frame, table = rows_and_lookup(spark)
    known = {(a, b): v for a, b, v in lookup}
    expected = [(*row, known.get(row[1:])) for row in rows if how == "left" or row[1:] in known]
    found = heavy.join_unique(frame, table, ["a", "b"], how, share)
    assert found.columns == ["n", "a", "b", "v"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_few_keys_are_heavy(spark):
    frame = spark.createDataFrame([(f"k{k % 700}",) for k in range(7000)] + [("hot",)] * 3000 + [(None,)] * 5000, "a string")
    assert [r.a for r in heavy.heavy_keys(frame, ["a"]).collect()] == ["hot"]
    assert heavy.heavy_keys(frame, ["a"], 1 / 5000).count() < 5000


def test_no_rows(spark):
    _, _, frame, table = rows_and_lookup(spark)
    assert heavy.join_unique(frame.limit(0), table, ["a", "b"], "left").collect() == []


JOB = """
import sys
sys.path.insert(0, {root!r})
from postingloom.session import local_session, written
from postingloom.operators import heavy
from pyspark.sql import functions as F
spark = local_session(4, shuffle_partitions=16, **{{
    "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": "file://{log}", "spark.checkpoint.dir": "{scratch}",
    "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}})
name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 20011).cast("string")))
rows = written(spark.range(0, 300000, 1, 16).select("id", name.alias("company_name")), "rows")
lookup = written(rows.select("company_name").distinct().withColumn("company_id", F.sha2("company_name", 256)), "lookup")
spark.sparkContext.setJobGroup("join", "join")
heavy.join_unique(rows, lookup, ["company_name"]).write.parquet("{scratch}/joined")
assert spark.read.parquet("{scratch}/joined").count() == 300000
spark.stop()
"""


def test_no_task_gets_twice_the_median(tmp_path):
    """A company with a third of the rows: rows that each task of the join gets from a shuffle, from the event log."""
    log, scratch = tmp_path / "log", tmp_path / "scratch"
    log.mkdir(), scratch.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    job = JOB.format(root=root, log=log, scratch=scratch)
    subprocess.run([sys.executable, "-c", job], check=True, timeout=300, capture_output=True)
    events = [json.loads(line) for path in glob.glob(f"{log}/**/*", recursive=True) if os.path.isfile(path) for line in open(path)]
    of_join = {
        stage["Stage ID"]
        for e in events
        if e["Event"] == "SparkListenerJobStart" and e["Properties"].get("spark.jobGroup.id") == "join"
        for stage in e["Stage Infos"]
    }
    read = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in of_join:
            n = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            if n:
                read.setdefault(e["Stage ID"], []).append(n)
    joins = [n for n in read.values() if len(n) >= 16 and sum(n) > 100_000]
    assert joins
    for n in joins:
        assert max(n) <= 2 * statistics.median(n), sorted(n)
