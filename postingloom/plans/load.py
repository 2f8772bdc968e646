"""Step 3: staged runs to the warehouse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mart_state, marts, merge
from ..operators import modelling as M
from ..operators import quality
from ..session import side_by_side, written
from ..sources import staging
from ..sources.warehouse import Warehouse


def load_latest_run(
    spark: SparkSession,
    staging_path: str,
    warehouse: Warehouse,
    now: dt.datetime,
    options: M.ModelOptions = M.DEFAULT,
    run_date: dt.date | None = None,
) -> dict[str, int]:
    """Fold the newest staged run into the warehouse; returns the load report.

    Runs that were staged in between and never loaded stay unloaded; use
    :func:`replay` to take them all.
    """
    run_key = staging.latest_run_key(spark, staging_path)
    return load_run(staging.read_run(spark, staging_path, run_key), warehouse, run_key, now, options, run_date)


def load_run(
    staged: DataFrame,
    warehouse: Warehouse,
    run_key: str | None,
    now: dt.datetime,
    options: M.ModelOptions = M.DEFAULT,
    run_date: dt.date | None = None,
    batch: str | None = None,
    keep_marts: bool = False,
) -> dict[str, int]:
    """Fold one run, or several at once, into the warehouse.

    ``run_date`` is the day of the load: with it, first-seen and last-seen dates
    are that day, and the calendar has it even if the run brought nothing; without it
    they are the days the run was staged for. Rows that cannot be stored are kept in
    the quarantine table of the version and counted apart. ``batch`` is noted in the publication log.
    With ``keep_marts`` the counts behind the marts are brought forward by what the run changes.
    """
    if run_date is not None:
        staged = staged.withColumn("run_date", F.lit(run_date))
    published = warehouse.current()
    stored = warehouse.tables(published)
    rows, fold = folded(staged, options)
    relevant = rows.where("outcome = 'relevant'")
    run = M.build_warehouse(rows, options, fold, relevant)
    if run_date is not None:
        day = warehouse.spark.range(1).select(F.lit(run_date).alias("run_date"))
        run["dim_date"] = M.dates_of(day, relevant if options.publication_dates else None)

    report = {}

    def set_aside() -> DataFrame:
        outcomes = rows.agg(*quality.outcome_totals())
        report.update(merge.load_report(stored["fact_job_posting"], fold, outcomes).first().asDict())
        # Most runs set nothing aside; the staged rows are then not read again.
        return quality.quarantined(staged if report["quarantined"] else staged.where("false"))

    beside = {"quarantine": set_aside, "batch": batch}
    if published is None:
        if keep_marts:
            beside["mart_state"] = mart_state.counts(run["fact_job_posting"], run["bridge_job_skill"])
        warehouse.publish(run, published, run_key, now, **beside)
        return report
    if keep_marts:
        state = warehouse.mart_state(published)
        if state is None:
            state = mart_state.counts(stored["fact_job_posting"], stored["bridge_job_skill"])
        beside["mart_state"] = mart_state.advanced(state, mart_state.difference(stored, run))

    tables = merge.merge_dimensions(stored, run, overwrite_country=options.country_name_mode == "name")
    tables["fact_job_posting"] = merge.merge_fact(stored["fact_job_posting"], run["fact_job_posting"])
    tables["bridge_job_skill"] = merge.merge_bridge(
        stored["bridge_job_skill"], run["bridge_job_skill"], published.buckets
    )
    warehouse.publish(tables, published, run_key, now, co_located=True, **beside)
    return report


def folded(staged: DataFrame, options: M.ModelOptions = M.DEFAULT) -> tuple[DataFrame, DataFrame]:
    """The outcome of every row with the few columns that dimensions are made from, and the folded postings, each written
    once to the shared folder. Dimensions, the calendar and the report's counts are made from the former, three
    tables and the rest of the report from the latter; so the staged rows are read twice, at the same time."""
    rows = staged.select(quality.outcome().alias("outcome"), "run_date", *M.dimension_sources(options))
    relevant = M.relevant_postings(quality.accepted(staged))
    fold = M.fold(relevant, options)
    fold, rows = side_by_side([lambda: written(fold, "folded"), lambda: written(rows, "outcomes")])
    return rows, fold


def replay(
    staged: DataFrame, warehouse: Warehouse, now: dt.datetime, options: M.ModelOptions = M.DEFAULT
) -> int:
    """Build the warehouse from all staged runs at once, as a new version with the
    bucket count that ``warehouse`` was opened with."""
    rows, fold = folded(staged, options)
    tables = M.build_warehouse(rows, options, fold, rows.where("outcome = 'relevant'"))
    return warehouse.publish(
        tables, warehouse.current(), None, now, quarantine=quality.quarantined(staged), rebucket=True
    )


def refresh_marts(warehouse: Warehouse) -> None:
    """Compute all marts of the current version and keep them."""
    warehouse.write_marts(marts.all_marts(warehouse.tables()))
