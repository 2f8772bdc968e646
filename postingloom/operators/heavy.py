"""Joins on keys of which a few hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: A key with more than this share of the rows is heavy; so there are fewer than 1 / SHARE of them.
SHARE = 1 / 500


def heavy_keys(rows: DataFrame, keys: list[str], share: float = SHARE) -> DataFrame:
    """The keys with more than ``share`` of the rows, fewer than 1 / ``share``; a key with a NULL is none.

    Rows are counted in the map tasks, so a heavy key reaches the shuffle once per task."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    return counted.where(_complete(keys) & (F.col("n") > share * total)).select(*keys)


def join_unique(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner", share: float = SHARE, counted: DataFrame | None = None
) -> DataFrame:
    """``rows`` joined with ``lookup``, which has at most one row per key, in the way ``how`` (inner or left).

    Rows of heavy keys meet their few lookup rows where they are, in a join that sends these to all tasks: there are fewer than
    1 / ``share`` of them. Rows with a NULL in the key, which match nothing, pass by. Only the rest is shuffled on the
    key, and no key holds more than ``share`` of it. ``counted`` is a stored table with the same keys that is
    cheaper to count than ``rows``."""
    heavy = F.broadcast(written(heavy_keys(rows if counted is None else counted, keys, share), "heavy-keys"))
    added = [c for c in lookup.columns if c not in keys]
    columns = [*rows.columns, *added]
    known = F.broadcast(lookup.join(heavy, keys, "left_semi"))
    parts = [
        rows.join(heavy, keys, "left_semi").join(known, keys, how),
        rows.where(_complete(keys)).join(heavy, keys, "left_anti").join(lookup, keys, how),
    ]
    if how == "left":
        nothing = [F.lit(None).cast(lookup.schema[c].dataType).alias(c) for c in added]
        parts.append(rows.where(~_complete(keys)).select("*", *nothing))
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])


def _complete(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
