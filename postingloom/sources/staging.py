"""The staging table: every posting of every run, append-only, Parquet,
partitioned by run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from . import listing


#: Form of a run key: the extraction time in UTC to the microsecond.
RUN_KEY = r"\d{8}T\d{12}"


def to_staging(
    postings: DataFrame, loaded_at: dt.datetime, run_date: dt.date | Column | None = None
) -> DataFrame:
    """Postings in the staging layout; keys that were absent are NULL.

    The extraction time is brought to one spelling, in which the greatest text
    is the latest time. ``run_date`` is the day the run is processed; by default
    the day of its extraction.
    """
    if run_date is None:
        run_date = F.expr("try_cast(substring(extracted_at, 1, 10) AS DATE)")
    elif not isinstance(run_date, Column):
        run_date = F.lit(run_date)
    return postings.select(
        *schemas.POSTING_COLUMNS,
        rules.extraction_time_text().alias("extracted_at"),
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
        "ordinal",
        run_date.alias("run_date"),
        rules.run_key().alias("run_key"),
    )


def append(staging_rows: DataFrame, path: str) -> None:
    staging_rows.write.mode("append").partitionBy("run_key").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STAGING).parquet(path)


def latest_run_key(spark: SparkSession, path: str) -> str | None:
    """Greatest run key, from directory names alone."""
    for key in listing.partitions(spark, path, "run_key", RUN_KEY):
        if listing.has_files(spark, f"{path}/run_key={key}", ".parquet"):
            return key
    return None


def read_run(spark: SparkSession, path: str, run_key: str | None) -> DataFrame:
    """One run; only its partition is listed and scanned.

    A table written by the file stream is opened at its root, where the stream
    keeps the list of valid files, and is cut down by the partition filter.
    """
    run = F.col("run_key") == F.lit(run_key)
    if run_key is None or listing.exists(spark, f"{path}/_spark_metadata"):
        return read(spark, path).where(run)
    one = spark.read.schema(schemas.STAGING).option("basePath", path).parquet(f"{path}/run_key={run_key}")
    return one.where(run)


def latest_run(staging_rows: DataFrame) -> DataFrame:
    """The newest run of rows that are not partitioned by run.

    Times are compared in one spelling, which is worked out for each distinct text and not for each row; rows without
    a time never belong to it. What is sent to all tasks are the spellings of one instant: its offsets and fractions."""
    times = staging_rows.select("extracted_at").distinct().withColumn("time", rules.extraction_time_text())
    newest = F.max("time").over(Window.partitionBy())  # over one row per text
    spellings = times.withColumn("newest", newest).where("time = newest").select("extracted_at")
    return staging_rows.join(F.broadcast(spellings), "extracted_at", "left_semi").select(*staging_rows.columns)
