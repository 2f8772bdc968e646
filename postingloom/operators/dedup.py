"""Keep-last, insert-if-absent and distinct keys.

Each groups on its key with partial aggregation, so a key that holds a large
share of the rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(rows: DataFrame, keys: list[str], order: str, copies: str | None = None) -> DataFrame:
    """The row with the greatest ``order``, per key; NULL keys form a group.

    The order column leads the compared struct, so the other columns only
    decide between rows of equal order, and always the same way. ``copies``
    names a column that counts the rows of the key.
    """
    rest = [order] + [c for c in rows.columns if c not in keys and c != order]
    measures = [F.max(F.struct(*rest)).alias("_last")]
    if copies:
        measures.append(F.count(F.lit(1)).alias(copies))
    kept = rows.groupBy(*keys).agg(*measures)
    return kept.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest], *([copies] if copies else []))


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` and those rows of ``new`` whose key it does not have."""
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti").select(*existing.columns))


def overwrite_by_key(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` put over it, key by key."""
    kept = existing.join(new.select(*keys), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))
