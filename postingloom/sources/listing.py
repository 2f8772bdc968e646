"""Names of directories and files, asked of the file system itself.

Finding the newest partition this way costs one listing per level, however
much data the partitions hold.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def partitions(spark: SparkSession, path: str, column: str, form: str) -> list[str]:
    """Values of partition ``column`` directly below ``path`` that have the form
    (a pattern), greatest first. Rows without a value lie in a partition whose
    name has no such form and sorts above every digit; it is never the newest."""
    values = (
        name.partition("=")[2] for name, is_directory in _entries(spark, path)
        if is_directory and name.startswith(f"{column}=")
    )
    return sorted((value for value in values if re.fullmatch(form, value)), reverse=True)


def names(spark: SparkSession, path: str) -> list[str]:
    return [name for name, _ in _entries(spark, path)]


def remove(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, True)


def has_files(spark: SparkSession, path: str, suffix: str) -> bool:
    return any(not is_directory and name.endswith(suffix) for name, is_directory in _entries(spark, path))


def _entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    file_system, hadoop_path = _file_system(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return [(s.getPath().getName(), s.isDirectory()) for s in file_system.listStatus(hadoop_path)]
