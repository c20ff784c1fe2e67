"""Keep an incremental mart current from a file stream of new source rows.

The batch incremental run rebuilds everything at or after the target's
high-water mark, so rows that arrive late (dated before the mark) are
missed. Fed by a Structured Streaming file source instead, each micro-batch
says exactly which days received rows: those days are rebuilt from the full
source (a partition-pruned read) and merged into the target by key with the
same partition rewrite as the batch runs. Rebuilding whole days from the
source makes a retried micro-batch idempotent, so the checkpointed stream
gives exactly-once results in the target; late rows are picked up.

Run with ``trigger(availableNow=True)`` from the scheduler (process what
arrived, then stop) or with a processing-time trigger as a service.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from litreflow.session import shared_dir
from litreflow.sinks.incremental import merge_by_partition_rewrite


def start_day_rebuild_stream(spark: SparkSession, source_path: str, schema: StructType,
                             day_of: Callable[[DataFrame], Column],
                             rebuild: Callable[[list], DataFrame],
                             target_path: str, keys: Sequence[str], mark_column: str,
                             name: str, cluster_by: Sequence[str] = (),
                             available_now: bool = True,
                             checkpoint: str | None = None,
                             reader_options: dict | None = None) -> StreamingQuery:
    """Start the stream.

    ``day_of(df)`` gives the day of a source row; ``rebuild(days)`` returns
    the mart's rows for those days computed from the whole source.
    """
    checkpoint = checkpoint or f"{shared_dir(spark)}/litreflow-streams/{name}"
    stream = spark.readStream.schema(schema).options(**(reader_options or {})) \
        .parquet(source_path)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        # distinct days of one micro-batch: a short list of dates
        days = [r[0] for r in batch.select(day_of(batch).alias("d")).distinct().collect()
                if r[0] is not None]
        if not days:
            return
        rows = rebuild(sorted(days))
        merge_by_partition_rewrite(spark, lambda _mark: rows, target_path, keys, mark_column,
                                   cluster_by=cluster_by)

    writer = (stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .foreachBatch(merge_batch))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
