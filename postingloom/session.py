"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postingloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master, whose executors share this machine, may fall back to
    a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="postingloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/postingloom/{purpose}-{uuid.uuid4().hex}"


def side_by_side(steps: Iterable[Callable[[], Any]]) -> list[Any]:
    """Run independent steps as concurrent Spark jobs, so that one fills the cores another leaves idle; their
    results in order. Any failure is raised."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once to the shared folder and read from there."""
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
