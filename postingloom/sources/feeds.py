"""Landed feed responses: one row per job, with its place in the feed.

A response is one answer of a feed to one request. Whoever fetches it lands it
under ``run=<key>/[country=<code>/]term=<index>/``; many responses may share a
directory. The place of a job (request order, page, position) decides which of
several copies is the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import rules
from ..functions import vocabulary as V
from . import listing


def read_source_a(spark: SparkSession, path: str, multi_line: bool = True, run: str | None = None) -> DataFrame:
    """Jobs of feed A: ``run, feed_order, job``; of one run where it is named.

    A run's directory is named after its extraction time; the column has that time."""
    return _jobs(_responses(spark, path, schemas.SOURCE_A_RESPONSE, ["run", "term"], multi_line, run), "jobs")


def read_source_b(spark: SparkSession, path: str, multi_line: bool = True, run: str | None = None) -> DataFrame:
    """Jobs of feed B: ``run, country, feed_order, job``; the country is not in
    the response and comes from its directory."""
    columns = ["run", "country", "term"]
    return _jobs(_responses(spark, path, schemas.SOURCE_B_RESPONSE, columns, multi_line, run), "results")


def _responses(spark, path, schema, directories, multi_line, run) -> DataFrame:
    # Naming the directory columns in the schema keeps them text: "07" stays "07".
    full = T.StructType(schema.fields + [T.StructField(d, T.StringType()) for d in directories])
    reader = spark.read.schema(full).option("multiLine", multi_line).option("basePath", path)
    own = path if run is None else f"{path.rstrip('/')}/run={run}"
    if run is not None and not listing.exists(spark, own):
        return spark.createDataFrame([], full)
    return reader.json(own).withColumn("run", rules.run_time(F.col("run")))


def _jobs(responses: DataFrame, array: str) -> DataFrame:
    country = [F.col("country")] if "country" in responses.columns else []
    exploded = responses.select("run", *country, "term", "page", F.posexplode(array).alias("pos", "job"))
    order = feed_order(
        term=F.col("term"), page=F.col("page"), pos=F.col("pos"), country=country[0] if country else None
    )
    return exploded.select("run", *country, order.alias("feed_order"), "job")


def feed_order(term: Column, page: Column, pos: Column, country: Column | None = None) -> Column:
    """Sort key that reproduces the order in which a feed is requested:
    country by country, term by term, page by page."""
    fields = []
    if country is not None:
        listed = F.array_position(F.array(*[F.lit(c) for c in V.SOURCE_B_COUNTRIES]), country)
        # Countries outside the list come after it, in alphabetical order.
        fields += [
            F.when(listed > 0, listed).otherwise(F.lit(len(V.SOURCE_B_COUNTRIES) + 1)).cast("bigint").alias("c"),
            country.alias("cc"),
        ]
    fields += [
        term.cast("bigint").alias("t"),
        F.coalesce(page, F.lit(0)).cast("bigint").alias("p"),
        pos.cast("bigint").alias("i"),
    ]
    return F.struct(*fields)


def write_responses(responses: DataFrame, path: str) -> None:
    """Land responses as JSON lines below their directory columns."""
    directories = [c for c in ("run", "country", "term") if c in responses.columns]
    responses.write.mode("append").partitionBy(*directories).json(path)
