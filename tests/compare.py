"""Run a registered query and its SQL, compare rows as multisets; the plan of a frame as text."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def spark_rows(frame) -> tuple[list[str], Counter]:
    columns = sorted(frame.columns)
    return columns, Counter(tuple(_cell(r[c]) for c in columns) for r in frame.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    columns = sorted(names)
    place = [names.index(c) for c in columns]
    return columns, Counter(tuple(_cell(row[i]) for i in place) for row in cursor.fetchall())


def difference(frame, con, sql: str) -> str | None:
    """None if equal, else a short account of the first differences."""
    (sc, sr), (dc, dr) = spark_rows(frame), duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if sr == dr:
        return None
    return f"{sum(sr.values())} rows vs {sum(dr.values())}; only spark {list((sr - dr).items())[:2]}; only sql {list((dr - sr).items())[:2]}"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
