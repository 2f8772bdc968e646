"""Step 2: the newest raw day to the staging table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import raw_zone, staging


def stage_latest_day(
    spark: SparkSession,
    raw_root: str,
    staging_path: str,
    loaded_at: dt.datetime,
    run_date: dt.date | None = None,
    multi_line: bool | None = None,
) -> int:
    """Append the newest day's postings; returns how many there were."""
    return stage_path(
        spark, raw_zone.latest_day_path(spark, raw_root), staging_path, loaded_at, run_date, multi_line
    )


def stage_path(
    spark: SparkSession,
    raw_path: str,
    staging_path: str,
    loaded_at: dt.datetime,
    run_date: dt.date | None = None,
    multi_line: bool | None = None,
) -> int:
    """Append the postings of one raw directory, as often as it is called."""
    postings = raw_zone.postings_of(raw_zone.read_payloads(spark, raw_path, multi_line))
    written = Observation()
    rows = staging.to_staging(postings, loaded_at, run_date).observe(written, F.count(F.lit(1)).alias("rows"))
    staging.append(rows, staging_path)
    return written.get["rows"]
