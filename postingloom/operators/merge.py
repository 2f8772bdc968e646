"""Fold a newly loaded run into the stored warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from . import quality
from .dedup import insert_if_absent, overwrite_by_key

# Columns by the sighting they belong to.
_KEYS = ["job_posting_id", "source", "external_id"]
_LAST = ["title", "date_last_seen", "last_ord"]


def merge_fact(stored: DataFrame, run: DataFrame) -> DataFrame:
    """Stored postings with a run put over them; both have one row per posting.

    The earlier first sighting and the later last sighting win, whatever the
    order in which runs arrive; loading the same run again changes nothing.
    With both sides bucketed on the key only the run is shuffled.
    """
    old, new = stored.alias("old"), run.alias("new")
    in_old, in_new = F.col("old.job_posting_id").isNotNull(), F.col("new.job_posting_id").isNotNull()

    take_first = ~in_new | (in_old & (F.col("old.first_ord") <= F.col("new.first_ord")))
    take_last = ~in_new | (in_old & (F.col("old.last_ord") > F.col("new.last_ord")))

    def choose(column: str) -> Column:
        if column in _KEYS:
            return F.coalesce(f"old.{column}", f"new.{column}").alias(column)
        take_old = take_last if column in _LAST else take_first
        return F.when(take_old, F.col(f"old.{column}")).otherwise(F.col(f"new.{column}")).alias(column)

    joined = old.join(new, F.col("old.job_posting_id") == F.col("new.job_posting_id"), "full_outer")
    return joined.select(*[choose(c) for c in schemas.FACT.fieldNames()])


def merge_bridge(stored: DataFrame, run: DataFrame, buckets: int) -> DataFrame:
    """Pairs accumulate: none is ever removed.

    The run's pairs are brought to the layout of the stored ones. The union
    then keeps that layout, and duplicates are dropped bucket by bucket.
    """
    return stored.unionByName(run.repartition(buckets, "job_posting_id")).distinct()


def merge_dimensions(stored: dict[str, DataFrame], run: dict[str, DataFrame], overwrite_country: bool = True) -> dict:
    """Dimension rows are inserted once; a country's name follows the latest run."""
    keys = {"dim_city": "city_id", "dim_company": "company_id", "dim_skill": "skill_id", "dim_date": "date_id"}
    merged = {name: insert_if_absent(stored[name], run[name], [key]) for name, key in keys.items()}
    put = overwrite_by_key if overwrite_country else insert_if_absent
    merged["dim_country"] = put(stored["dim_country"], run["dim_country"], ["country_id"])
    return merged


def load_report(stored: DataFrame, folded: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row: postings inserted, rows that updated one, rows out of scope,
    rows set aside. The four add up to the rows of the run.

    Every accepted relevant row beyond the first of a new key counts as an
    update. ``outcomes`` is :func:`quality.outcome_counts` of the run.
    """
    known = stored.select("job_posting_id", F.lit(True).alias("known"))
    keyed = folded.select("job_posting_id").join(known, "job_posting_id", "left")
    inserted = keyed.agg(F.count_if(F.col("known").isNull()).alias("inserted"))
    of = {name: outcomes.select(name).scalar() for name in ("relevant", "skipped", "quarantined")}
    return inserted.select(
        "inserted",
        (of["relevant"] - F.col("inserted")).alias("updated"),
        of["skipped"].alias("skipped"),
        of["quarantined"].alias("quarantined"),
    )


def replay_report(staging_rows: DataFrame) -> DataFrame:
    """The load report of every run, had the runs been loaded one by one."""
    rows = staging_rows.select("extracted_at", "source", "external_id", quality.outcome().alias("outcome"))
    per_run = rows.groupBy("source", "external_id", "extracted_at").agg(*quality.outcome_totals())
    seen = F.when(F.col("relevant") > 0, F.col("extracted_at"))
    first = F.min(seen).over(Window.partitionBy("source", "external_id"))
    return (
        per_run.withColumn("is_first", F.coalesce(seen == first, F.lit(False)))
        .groupBy("extracted_at")
        .agg(
            F.count_if("is_first").alias("inserted"),
            (F.sum("relevant") - F.count_if("is_first")).alias("updated"),
            F.sum("skipped").alias("skipped"),
            F.sum("quarantined").alias("quarantined"),
        )
    )
