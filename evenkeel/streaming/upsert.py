"""Keyed change rows from a stream, added to a table in hash buckets batch by batch, each batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from evenkeel.sources.buckets import BucketTable, append_changes, compact


def upsert_batch(batch: DataFrame, batch_id: int, table: BucketTable, order: str, ratio: float = 0.5, most_changes: int = 8) -> bool:
    """Add one batch, and compact the buckets that are due; false if the batch was added before.

    The manifest and the batch number stand in one pointer file, so a batch that
    is delivered again after a crash finds its number and changes nothing. Only
    buckets that the batch touches get files.
    """
    if not append_changes(batch, table, order, batch_id):
        return False
    compact(batch.sparkSession, table, ratio, most_changes)
    return True


def upsert_stream(changes: DataFrame, table: BucketTable, order: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the stream; change rows have the table's columns and ``op`` (upsert or delete), and ``order`` tells the last one."""
    writer = changes.writeStream.foreachBatch(lambda df, i: upsert_batch(df, i, table, order) and None).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
