"""Published versions of the warehouse.

Parquet cannot be updated in place, and a half-written table must never be
seen. So a load writes a new version beside the old one and then appends one
line to the publication log; readers take the greatest version in the log. One
writer at a time is assumed.

Fact and bridge are bucketed on the posting key: merging a run and joining the
two need no shuffle of what is stored.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import side_by_side
from . import listing

#: Table of the rows a load set aside.
QUARANTINE = "quarantine"

#: Counts that marts are kept current by.
MART_STATE = "mart_state"
MART_STATE_SCHEMA = "kind string, a string, b string, n bigint"

BUCKETED = {"fact_job_posting": "job_posting_id", "bridge_job_skill": "job_posting_id"}

LOG_SCHEMA = "version bigint, run_key string, published_at timestamp, buckets int, batch string"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets`` is used when nothing is published yet and by a replay; a load
        keeps the published number, since merging relies on it. At least the number
        of shuffle partitions keeps Spark from re-shuffling the stored side."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # ---- log

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/published")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def current(self) -> Row | None:
        """The newest line of the publication log."""
        log = self._log()
        return None if log is None else log.orderBy(F.desc("version")).first()

    def has_batch(self, batch: str) -> bool:
        """Whether some version was made from this part of a stream."""
        log = self._log()
        return log is not None and not log.where(F.col("batch") == batch).isEmpty()

    # ---- read

    def tables(self, published: Row | None = None) -> dict[str, DataFrame]:
        """Tables of a version, given by its log line, by default the newest;
        empty ones if nothing is published."""
        line = published or self.current()
        if line is None:
            return {name: self._empty(name) for name in schemas.WAREHOUSE}
        return {name: self._read(name, line.version, line.buckets) for name in schemas.WAREHOUSE}

    def _empty(self, name: str) -> DataFrame:
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.WAREHOUSE[name].fields]
        return self.spark.range(1).where("false").select(*columns)

    def _read(self, name: str, version: int, buckets: int) -> DataFrame:
        if name not in BUCKETED:
            return self.spark.read.schema(schemas.WAREHOUSE[name]).parquet(self._path(name, version))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.WAREHOUSE[name].fields)
        table = self._table(name, version)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({BUCKETED[name]}) INTO {buckets} BUCKETS LOCATION '{self._path(name, version)}'"
        )
        return self.spark.table(table)

    # ---- write

    def publish(
        self,
        tables: dict[str, DataFrame],
        published: Row | None,
        run_key: str | None,
        now: dt.datetime,
        co_located: bool = False,
        quarantine: DataFrame | Callable[[], DataFrame] | None = None,
        rebucket: bool = False,
        batch: str | None = None,
        mart_state: DataFrame | None = None,
    ) -> int:
        """Write all tables as the version after ``published``, make it current.

        ``batch`` names the part of a stream that the version was made from. ``mart_state`` are the counts of
        ``operators.mart_state`` that go with the version.

        ``quarantine`` holds the rows that the load set aside, or makes them while the tables are written; they are
        kept beside the tables of the version. ``rebucket`` goes over to the bucket count of this
        object, which only tables built anew can.

        ``co_located`` says that the rows of fact and bridge already lie in one
        task per bucket; otherwise they are brought there first, so that each
        bucket becomes one file.
        """
        version = published.version + 1 if published else 1
        buckets = published.buckets if published and not rebucket else self._buckets
        def write(name: str) -> None:
            frame, path = tables[name].select(*schemas.WAREHOUSE[name].fieldNames()), self._path(name, version)
            if name not in BUCKETED:
                frame.write.mode("overwrite").parquet(path)
                return
            key, table = BUCKETED[name], self._table(name, version)
            if not co_located:
                frame = frame.repartition(buckets, key)
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            frame.write.mode("overwrite").format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)

        def write_beside(name: str, beside: DataFrame | Callable[[], DataFrame]) -> None:
            frame = beside if isinstance(beside, DataFrame) else beside()
            frame.write.mode("overwrite").parquet(self._path(name, version))

        # The large tables first; the others fit in where these leave cores idle.
        steps = [partial(write, name) for name in sorted(schemas.WAREHOUSE, key=lambda name: name not in BUCKETED)]
        besides = ((QUARANTINE, quarantine), (MART_STATE, mart_state))
        side_by_side(steps + [partial(write_beside, name, beside) for name, beside in besides if beside is not None])
        entry = self.spark.createDataFrame([(version, run_key, now, buckets, batch)], LOG_SCHEMA)
        entry.coalesce(1).write.mode("append").json(f"{self.root}/published")
        return version

    def quarantine(self, version: int | None = None) -> DataFrame:
        """Rows that the load of a version set aside, each with its reason."""
        return self.spark.read.parquet(self._path(QUARANTINE, version or self.current().version))

    def mart_state(self, published: Row | None = None) -> DataFrame | None:
        """The counts kept beside a version, by default the newest; None if it has none."""
        line = published or self.current()
        if line is None or not listing.exists(self.spark, self._path(MART_STATE, line.version)):
            return None
        return self.spark.read.schema(MART_STATE_SCHEMA).parquet(self._path(MART_STATE, line.version))

    def retain(self, versions: int) -> None:
        """Drop all but the newest ``versions`` versions and their tables."""
        oldest = self.current().version - versions + 1
        for name in listing.names(self.spark, self.root):
            version = int(name[1:]) if re.fullmatch(r"v\d{6}", name) else oldest
            if version < oldest:
                for table in BUCKETED:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._table(table, version)}")
                listing.remove(self.spark, f"{self.root}/{name}")

    def write_marts(self, marts: dict[str, DataFrame]) -> None:
        """Keep the marts of the current version as Parquet beside its tables."""
        version = self.current().version
        side_by_side(partial(marts[name].write.mode("overwrite").parquet, self._path(name, version)) for name in marts)

    def read_mart(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name, self.current().version))

    # ---- names

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/v{version:06d}/{name}"

    def _table(self, name: str, version: int) -> str:
        owner = hashlib.sha256(self.root.encode()).hexdigest()[:12]
        return f"postingloom_{owner}_v{version:06d}_{name}"
