"""Re-plan every batch that lands in a raw table folder.

The reference runs the pipeline once per ``batch_id``.  Here a Structured Streaming file source watches the folder a
raw table lands in; each micro-batch hands the ``batch_id`` values it contains to ``run_batch`` (for example: build a
``Plan`` for that batch and ``overwrite_batch`` its results).  Progress lives in the streaming checkpoint, so a
restarted job resumes after the last planned files, and ``overwrite_batch`` makes a re-run of a batch idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def plan_landed_batches(spark: SparkSession, landing_path: str, schema: StructType,
                        run_batch: Callable[[int], None], checkpoint: str, available_now: bool = True,
                        batch_col: str = "batch_id") -> StreamingQuery:
    """Start a stream that calls ``run_batch(batch_id)`` once per batch id seen in each micro-batch of new files.

    Only the distinct batch ids of a micro-batch reach the driver (a handful per landing), never the rows.
    """

    def each(micro: DataFrame, epoch_id: int) -> None:
        for (batch_id,) in micro.select(batch_col).distinct().orderBy(batch_col).toLocalIterator():
            run_batch(batch_id)

    writer = (spark.readStream.schema(schema).parquet(landing_path)
              .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
