"""From feed jobs to one posting schema, one row per posting and run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules
from ..functions import vocabulary as V
from ..sources.feeds import feed_order
from .dedup import keep_last


def normalize_source_a(jobs: DataFrame) -> DataFrame:
    """Posting columns from a ``job`` struct of feed A; other columns stay."""
    job = F.col("job")
    return _postings(
        jobs,
        source=F.lit(V.SOURCE_A),
        external_id=job["id"],
        title=job["title"],
        company_name=job["company_name"],
        location=job["candidate_required_location"],
        country=F.lit(None).cast("string"),
        salary_min=F.lit(None).cast("string"),
        salary_max=F.lit(None).cast("string"),
        job_type=job["job_type"],
        publication_date=job["publication_date"],
        description=job["description"],
        url=job["url"],
        tags=F.coalesce(job["tags"], F.array().cast("array<string>")),
    )


def normalize_source_b(jobs: DataFrame) -> DataFrame:
    """Posting columns from a ``job`` struct of feed B and its ``country``."""
    job = F.col("job")
    return _postings(
        jobs,
        source=F.lit(V.SOURCE_B),
        external_id=job["id"],
        title=job["title"],
        company_name=job["company"]["display_name"],
        location=job["location"]["display_name"],
        country=F.col("country"),
        salary_min=job["salary_min"],
        salary_max=job["salary_max"],
        job_type=job["contract_time"],
        publication_date=job["created"],
        description=job["description"],
        url=job["redirect_url"],
        tags=F.array().cast("array<string>"),
    )


def _postings(jobs: DataFrame, **fields: Column) -> DataFrame:
    fields["title"] = F.coalesce(fields["title"], F.lit(""))
    fields["description"] = F.coalesce(fields["description"], F.lit(""))
    fields["work_mode"] = rules.work_mode("job.title", "job.description")
    carried = [c for c in jobs.columns if c not in ("job", "country")]
    return jobs.select(*carried, *[fields[c].alias(c) for c in schemas.POSTING_COLUMNS])


def drop_noise(rows: DataFrame, title: str = "title") -> DataFrame:
    """The light title filter of feed A; everything else is kept."""
    return rows.where(~rules.is_noise(title))


def without_id(jobs: DataFrame) -> DataFrame:
    """Jobs that name no id. They cannot be told apart, so they are set aside."""
    return jobs.where(F.col("job.id").isNull())


def merge_feeds(jobs_a: DataFrame, jobs_b: DataFrame) -> DataFrame:
    """Both feeds as postings, the last copy of each id within its run.

    The key contains the source, so each feed is reduced on its own and a row
    is shuffled once. Feed A is reduced before its title filter: what counts is
    the title of the last copy. ``copies`` is the number of normalised rows a
    posting stands for.
    """
    a = keep_last(jobs_a.where(F.col("job.id").isNotNull()).withColumn("_id", F.col("job.id")),
                  ["run", "_id"], "feed_order")
    a = drop_noise(a, "job.title").withColumn("copies", F.lit(1).cast("bigint"))
    a = normalize_source_a(a.drop("_id"))

    b = normalize_source_b(jobs_b.where(F.col("job.id").isNotNull()))
    b = keep_last(b, ["run", "external_id"], "feed_order", copies="copies")

    return _with_ordinal(a, 1).unionByName(_with_ordinal(b, 2))


def _with_ordinal(postings: DataFrame, feed: int) -> DataFrame:
    """Replace the place in the feed by one number of the same order.

    A place that does not fit the number's digits is an error; countries outside the
    list share their digits, and the fold tells such sightings apart."""
    place = F.col("feed_order")
    listed = place["c"] if feed == 2 else F.lit(0)
    number = F.lit(feed).cast("bigint")
    for part, width in ((listed, 100), (place["t"], 100), (place["p"], 10**8), (place["i"], 10**5)):
        too_far = F.raise_error(F.lit(f"a place in the feed is beyond {width}")).cast("bigint")
        number = number * width + F.when(part >= width, too_far).otherwise(part)
    return postings.select(
        *schemas.POSTING_COLUMNS, F.col("run").alias("extracted_at"), number.alias("ordinal"), "copies"
    )


def place_in_feed(jobs: DataFrame) -> DataFrame:
    """Turn loose ``term, page, pos[, country]`` columns into ``feed_order``."""
    country = F.col("country") if "country" in jobs.columns else None
    order = feed_order(F.col("term"), F.col("page"), F.col("pos"), country)
    carried = [c for c in jobs.columns if c not in ("term", "page", "pos")]
    return jobs.select(*carried, order.alias("feed_order"))


def counts_by_source(report: DataFrame) -> DataFrame:
    """The extraction report as the counts of an envelope: postings after de-duplication, and per feed before it."""
    by_source = F.create_map(
        F.lit(V.SOURCE_A), F.col("count_a"), F.lit(V.SOURCE_B), F.col("count_b")
    )
    return report.select(
        "extracted_at", "job_count", by_source.alias("job_count_by_source")
    )


def extraction_report(merged: DataFrame) -> DataFrame:
    copies_of = lambda source: F.coalesce(
        F.sum(F.when(F.col("source") == source, F.col("copies"))), F.lit(0)
    ).cast("bigint")
    return merged.groupBy("extracted_at").agg(
        F.count(F.lit(1)).alias("job_count"),
        copies_of(V.SOURCE_A).alias("count_a"),
        copies_of(V.SOURCE_B).alias("count_b"),
    )
