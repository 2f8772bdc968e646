"""Small helpers that the operators share."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

from postingloom.session import scratch_path

#: A word: no space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: Bytes of a batch that goes to a Python worker; a row that is larger goes by itself.
BATCH_BYTES = 4 << 20

#: Options of the Parquet writer for files that should be small.
SMALL = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}

#: Stands for a missing id where ids are ordered: after all others.
LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """While it holds, Spark removes the shuffle files of each query of the session once that has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(frame: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame, written to the folder all executors share, with ``options`` of the Parquet writer, and read again.

    Cuts lineage with files that outlive any executor."""
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stored_by(frame: DataFrame, key: str, purpose: str) -> DataFrame:
    """The frame, written like :func:`stored` in buckets of ``key``: each grouping by it then takes the rows as they lie.

    Rows are not shuffled for it. Each task writes a file per bucket, so the rows of a key should come from one task, in few keys."""
    spark = frame.sparkSession
    path = scratch_path(spark, purpose)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = "postingloom_" + re.sub(r"\W", "_", path.rsplit("/", 1)[1])
    writer = frame.write.format("parquet").bucketBy(buckets, key)
    writer.option("path", path).options(**SMALL).saveAsTable(table)
    return spark.table(table)


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's bound of bytes that a Python worker is handed at once to BATCH_BYTES.

    A batch is held several times over, by executor and worker; rows alone don't bound it where texts are long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    n, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", spark.conf.get(name, "64m").lower()).groups()
    if int(n) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit] > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shipped(module: str) -> None:
    """Send the module's functions to Python workers by value, so that workers need no path to the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(column: str | Column) -> Column:
    return F.regexp_extract_all(text_or_empty(column), F.lit(WORD), F.lit(0))


def helper_prefix(frame: DataFrame) -> str:
    """Underscores that no column of the frame begins with, to name helper columns that clash with none."""
    return "_" * (1 + max((len(name) - len(name.lstrip("_")) for name in frame.columns), default=0))


def digest_number(column: Column) -> Column:
    """The first 60 bits of a string's MD5 as a long; SQL has them too."""
    return F.conv(F.substring(F.md5(column), 1, 15), 16, 10).cast("long")


def row_key(frame: DataFrame, id_column: str, text_column: str) -> list[Column]:
    """Id and text hash: rows that share both are copies of one row and get the same result.

    The hash keeps rows without an id apart, so that a missing id is no hot key. Ids that are no whole numbers
    go by 60 bits of their digest."""
    own_id = F.col(id_column)
    if not isinstance(frame.select(id_column).schema[0].dataType, IntegralType | NullType):
        own_id = digest_number(own_id.cast("string"))
    return [
        F.coalesce(own_id.cast("long"), F.lit(LAST_ID)).alias("key_id"),
        F.xxhash64(text_or_empty(text_column)).alias("key_text"),
    ]


def numbered(frame: DataFrame, owner: str, coarse: str, fine: str, group: str, order: list[str], place: str) -> DataFrame:
    """Add each row's place among the rows of its owner, from 1, ordered by coarse, fine and ``order``.

    ``group`` spells owner, coarse and fine in one text that is never null. Groups are counted, sums over the groups of a coarse step
    and over the coarse steps of an owner give where each group begins, and only the rows of a
    group are ordered in one task; so no task needs to see all rows of an owner."""
    own = helper_prefix(frame) + "num_"
    counts = frame.groupBy(owner, coarse, fine, group).agg(F.count("*").alias(f"{own}n"))
    before = (Window.unboundedPreceding, -1)
    in_coarse = Window.partitionBy(owner, coarse).orderBy(fine).rowsBetween(*before)
    in_owner = Window.partitionBy(owner).orderBy(coarse).rowsBetween(*before)
    none = F.lit(0).cast("long")
    steps = (
        counts.groupBy(owner, coarse)
        .agg(F.sum(f"{own}n").alias(f"{own}n"))
        .select(F.col(owner).alias(f"{own}owner"), F.col(coarse).alias(f"{own}coarse"), F.coalesce(F.sum(f"{own}n").over(in_owner), none).alias(f"{own}step"))
    )
    starts = (
        counts.withColumn(f"{own}start", F.coalesce(F.sum(f"{own}n").over(in_coarse), none))
        .join(steps, F.col(owner).eqNullSafe(F.col(f"{own}owner")) & F.col(coarse).eqNullSafe(F.col(f"{own}coarse")))
        .select(F.col(group).alias(f"{own}group"), (F.col(f"{own}step") + F.col(f"{own}start")).alias(f"{own}start"))
    )
    row = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return (
        frame.join(starts, F.col(group) == F.col(f"{own}group"))
        .withColumn(place, F.col(f"{own}start") + row)
        .drop(f"{own}group", f"{own}start")
    )


def placed_in_order(rows: DataFrame, owner: str, order: list[str], purpose: str) -> DataFrame:
    """Add place, from 0 within each owner by ``order``, and n, the rows of the owner. owner is never null; ``order`` tells rows apart.

    Rows are sorted over range partitions, so an owner of any size is spread over tasks; only a row per owner and
    partition is summed up."""
    keys = [owner, *order]
    ranged = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), purpose
    ).withColumn("_part", F.shiftright("_at", 33))
    runs = ranged.groupBy(owner, "_part").agg(F.min("_at").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(owner)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col(owner).alias("_of_owner"),
        F.col("_part").alias("_of_part"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")) - F.col("first")).alias("_start"),
        F.sum("rows").over(whole).alias("n"),
    )
    return (
        ranged.join(starts, (F.col(owner) == F.col("_of_owner")) & (F.col("_part") == F.col("_of_part")))
        .withColumn("place", F.col("_at") + F.col("_start"))
        .drop("_at", "_part", "_of_owner", "_of_part", "_start")
    )
