"""The load step as a file stream over the staging table.

Whatever was staged and not loaded yet is folded into the warehouse, a version per batch. First and last sighting
and the union of skills are associative, so a batch may hold a run, several or a part of one, in any order. A batch is
noted in the publication log with the line that makes its version current; when the stream
repeats it after a failure, it is found there and changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import modelling as M
from ..plans import load
from ..sources.warehouse import Warehouse


def batch_loader(
    warehouse: Warehouse, stream: str, now: dt.datetime, options: M.ModelOptions = M.DEFAULT
) -> Callable[[DataFrame, int], None]:
    """What a batch does; ``stream`` tells the batches of one stream from those of others."""

    def load_batch(staged: DataFrame, batch_id: int) -> None:
        batch = f"{stream}#{batch_id}"
        if not warehouse.has_batch(batch):
            load.load_run(staged, warehouse, None, now, options, batch=batch)

    return load_batch


def load_new_rows(
    spark: SparkSession,
    staging_path: str,
    warehouse: Warehouse,
    checkpoint: str,
    now: dt.datetime,
    options: M.ModelOptions = M.DEFAULT,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start the stream over all staged rows present now; it ends by itself. The checkpoint's path names the stream."""
    staged = (
        spark.readStream.schema(schemas.STAGING).option("maxFilesPerTrigger", files_per_batch).parquet(staging_path)
    )
    return (
        staged.writeStream.foreachBatch(batch_loader(warehouse, checkpoint, now, options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
