"""The staging step as a file stream.

Every raw document that has not been staged yet is staged, exactly once: the
stream's checkpoint remembers the files, and the Parquet sink publishes a
batch's files together. The batch step stages the newest day only, as often as
it is called; this one catches up on whatever is new.

The sink keeps its own list of valid files, so a directory filled by the
stream must not be appended to by the batch step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sources import raw_zone, staging


def stage_new_documents(
    spark: SparkSession,
    raw_root: str,
    staging_path: str,
    checkpoint: str,
    loaded_at: dt.datetime,
    files_per_batch: int = 1000,
    multi_line: bool = False,
) -> StreamingQuery:
    """Start the stream over all documents present now; it ends by itself.

    ``multi_line`` is for documents spread over many lines; all files of a stream have one form."""
    payloads = (
        spark.readStream.schema(schemas.PAYLOAD)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(raw_root)
    )
    rows = staging.to_staging(raw_zone.postings_of(payloads), loaded_at)
    return (
        rows.writeStream.format("parquet")
        .partitionBy("run_key")
        .option("path", staging_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
