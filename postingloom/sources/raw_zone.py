"""The raw zone: payload documents below ``year=YYYY/month=MM/day=DD``.

A payload document is an envelope (extraction time, feeds, counts) around an
array of postings. Documents written here are JSON lines with one posting per
envelope, so a day of any size is written without gathering it anywhere and is
read back in splits; one more line per run states its counts. Documents written elsewhere may be spread over many lines
and hold a whole day; which form a file has is told from its first line.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from . import listing

DAY_COLUMNS = ["year", "month", "day"]


class EmptyRawZone(ValueError):
    """There is no document to load."""


def day_path(root: str, day: dt.date) -> str:
    """Directory of a day; the zero padding makes names sort by date."""
    return f"{root.rstrip('/')}/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"


def day_columns(day: Column) -> list[Column]:
    return [
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    ]


def payload_lines(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """Wrap each posting in an envelope of its own, and state each run's counts once.

    ``counts`` holds one row per run: ``extracted_at``, ``job_count`` and
    ``job_count_by_source``. They become one document per run without postings, the
    run's manifest. So a run that found nothing has a document too, and no
    posting has to meet the counts of its run.
    """
    job = F.struct(*schemas.POSTING_COLUMNS, "ordinal")
    lines = postings.select("extracted_at", F.array(job).alias("jobs"))
    feeds = F.reverse(F.array_sort(F.map_keys("job_count_by_source")))
    manifests = counts.select("extracted_at", feeds.alias("sources"), "job_count", "job_count_by_source")
    documents = lines.unionByName(manifests, allowMissingColumns=True)
    return documents.select(
        "extracted_at",
        "sources",
        "job_count",
        "job_count_by_source",
        "jobs",
        *day_columns(F.expr("try_cast(substring(extracted_at, 1, 10) AS DATE)")),
    )


def write_days(payloads: DataFrame, root: str) -> None:
    """Write documents; a day that is written again replaces its old content,
    other days stay."""
    (
        payloads.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_COLUMNS)
        .json(root)
    )


def latest_day_path(spark: SparkSession, root: str) -> str:
    """Directory of the greatest document key; fails on an empty zone.

    Only names are listed, the greatest first; no document is opened.
    """
    root = root.rstrip("/")
    for year in listing.partitions(spark, root, "year", r"\d{4}"):
        for month in listing.partitions(spark, f"{root}/year={year}", "month", r"\d{2}"):
            for day in listing.partitions(spark, f"{root}/year={year}/month={month}", "day", r"\d{2}"):
                path = f"{root}/year={year}/month={month}/day={day}"
                if listing.has_files(spark, path, ".json"):
                    return path
    raise EmptyRawZone(f"no document in the raw zone {root}")


def spread_documents(spark: SparkSession, path: str) -> list[str]:
    """The files below ``path`` whose first line is not a whole document: each holds one, spread over its lines.

    Only the first split of a file is looked at, and its lines are reduced in the map tasks. What comes back are file names, as
    few as whole-day documents are."""
    line = F.trim("value")
    heads = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        .withColumn("at", F.monotonically_increasing_id())
        .where((F.col("start") == 0) & (line != ""))
    )
    whole = line.startswith("{") & line.endswith("}")
    # The place and the answer in one number, so that the least one has the answer of the first line.
    first = heads.groupBy("file").agg(F.min(F.col("at") * 2 + whole.cast("long")).alias("first"))
    return [row.file for row in first.where("first % 2 = 0").select("file").collect()]


def read_payloads(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Payload documents below ``path``, as lines or spread over many, also side by side. Broken documents fail the read.

    ``multi_line`` says which form all files have, if that is known; then none is looked at before."""

    def reader(spread: bool):
        options = {"multiLine": spread, "mode": "FAILFAST", "recursiveFileLookup": "true"}
        return spark.read.schema(schemas.PAYLOAD).options(**options)

    if multi_line is not None:
        return reader(multi_line).json(path)
    spread = spread_documents(spark, path)
    if not spread:
        return reader(False).json(path)
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .where(~F.col("_metadata.file_path").isin(spread) & (F.trim("value") != ""))
    )
    parsed = F.from_json("value", schemas.PAYLOAD, {"mode": "FAILFAST"})
    return lines.select(parsed.alias("document")).select("document.*").unionByName(
        reader(True).json([unquote(file) for file in spread])  # their names come as URIs
    )


def postings_of(payloads: DataFrame) -> DataFrame:
    """One row per posting, with the run's extraction time and an ordinal."""
    return payloads.select("extracted_at", F.posexplode("jobs").alias("pos", "job")).select(
        *[F.col(f"job.{c}") for c in schemas.POSTING_COLUMNS],
        "extracted_at",
        F.coalesce("job.ordinal", F.col("pos").cast("bigint")).alias("ordinal"),
    )
