"""Step 1: landed feed responses to the raw zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import normalize as N
from ..session import scratch_path
from ..sources import feeds, raw_zone


def extract_landed(
    spark: SparkSession, landing_a: str, landing_b: str, raw_root: str, run: str | None = None, **read
) -> DataFrame:
    """Read the landed responses of both feeds and write them to the raw zone.

    ``run`` is the directory name of one run; only its directories are listed and
    read, and its day is replaced even if it found nothing. Without it all runs are taken.
    """
    a = feeds.read_source_a(spark, landing_a, run=run, **read)
    b = feeds.read_source_b(spark, landing_b, run=run, **read)
    if run is None:
        return extract(a, b, raw_root)
    time = spark.range(1).select(rules.run_time(F.lit(run)).alias("extracted_at"))
    return extract(a, b, raw_root, time)


def extract(jobs_a: DataFrame, jobs_b: DataFrame, raw_root: str, runs: DataFrame | None = None) -> DataFrame:
    """Normalise, de-duplicate and write every run; returns the report.

    ``runs`` names runs (``extracted_at``) that are to be written even if neither
    feed has a posting of them.

    The merged postings are written once to the shared folder. The counts that
    go into each envelope are taken from that table, not from a second pass
    over the feeds.
    """
    spark = jobs_a.sparkSession
    path = scratch_path(spark, "extracted")
    merged = N.merge_feeds(jobs_a, jobs_b)
    merged.write.parquet(path)
    merged = spark.read.schema(merged.schema).parquet(path)
    report = N.extraction_report(merged)
    if runs is not None:
        none = [F.lit(0).cast("bigint").alias(c) for c in report.columns if c != "extracted_at"]
        report = report.unionByName(runs.join(report, "extracted_at", "left_anti").select("extracted_at", *none))
    raw_zone.write_days(raw_zone.payload_lines(merged, N.counts_by_source(report)), raw_root)
    return report


def feed_counts(jobs_a: DataFrame, jobs_b: DataFrame) -> DataFrame:
    """What arrived: jobs per run, feed, country and term, and how many of them
    have no id. A request that failed shows up as a missing row."""
    a = jobs_a.select("run", F.lit("a").alias("feed"), F.lit(None).cast("string").alias("country"),
                      F.col("feed_order.t").alias("term"), F.col("job.id").alias("id"))
    b = jobs_b.select("run", F.lit("b").alias("feed"), "country",
                      F.col("feed_order.t").alias("term"), F.col("job.id").alias("id"))
    return a.unionByName(b).groupBy("run", "feed", "country", "term").agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("id").isNull()).alias("without_id")
    )
