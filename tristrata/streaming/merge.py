"""Merge a stream of changes into a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tristrata.sinks.merge import merge_partitions
from tristrata.streaming.run import writer


def merge_stream(
    changes: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str],
    partition_by: list[str],
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Upsert each batch; a batch that comes again changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        work = f"{checkpoint}/merge/batch={number}"
        merge_partitions(path, batch, keys, order_by, partition_by, work)

    return writer(changes, checkpoint, trigger).foreachBatch(merge).start()
