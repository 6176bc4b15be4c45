"""The daily job as a Structured Streaming query.

New post files arriving in a folder are processed in micro-batches.  Daily stats
are a function of *all* posts of a (date, board), and their counts per thread and term add up, so each
micro-batch (``jobs.late_posts_job``):

  1. reads its own posts only and stores their counts under ``day_state/batch_id=<id>`` (overwrite: a
     retried batch rewrites the same folder, so the effect is exactly once);
  2. adds up the stored counts of the (date, board) pairs it touched (partition-pruned by date) and
     upserts exactly those days' stats and metrics.

The stored result always equals a batch run over the same posts.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wordtide import schemas
from wordtide.plans import jobs


def process_batch(batch: DataFrame, batch_id: int, warehouse: str, **job_kwargs) -> None:
    if not batch.isEmpty():
        jobs.late_posts_job(batch.sparkSession, batch, warehouse, batch_id, **job_kwargs)


def start_daily_stream(spark: SparkSession, source_dir: str, warehouse: str, checkpoint_location: str,
                       max_files_per_trigger: Optional[int] = None, available_now: bool = True,
                       **job_kwargs) -> StreamingQuery:
    """Start the stream over Parquet post files (schema ``schemas.POSTS``)."""
    reader = spark.readStream.schema(schemas.POSTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    w = (stream.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, warehouse, **job_kwargs))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
