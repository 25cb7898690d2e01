"""Start streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tristrata.sinks.files import MICROS

AVAILABLE_NOW = "available now"


def writer(
    df: DataFrame,
    checkpoint: str,
    trigger: str | None = None,
    mode: str = "append",
    name: str | None = None,
) -> DataStreamWriter:
    """A stream writer with checkpoint and trigger.

    ``trigger`` is a span such as ``"10 seconds"``, ``AVAILABLE_NOW`` to take what is there
    and stop, or ``None`` to run batch after batch. A query started again on its checkpoint
    goes on where it stopped.
    """
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    if trigger == AVAILABLE_NOW:
        return out.trigger(availableNow=True)
    return out.trigger(processingTime=trigger) if trigger else out


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    trigger: str | None = None,
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append to files, by directory of the keys given; ``options`` go to the format."""
    out = writer(df, checkpoint, trigger, name=name).format(fmt)
    if fmt in ("json", "csv"):
        out = out.option("timestampFormat", MICROS)
    out = out.options(**options)
    if partition_by:
        out = out.partitionBy(*partition_by)
    return out.start(path)


def to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    fmt: str | None = None,
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a catalog table."""
    out = writer(df, checkpoint, trigger, name=name)
    return (out.format(fmt) if fmt else out).toTable(table)


def to_console(df: DataFrame, trigger: str | None = None) -> StreamingQuery:
    """Print each batch, untruncated."""
    out = df.writeStream.format("console").outputMode("append").option("truncate", "false")
    if trigger == AVAILABLE_NOW:
        out = out.trigger(availableNow=True)
    elif trigger:
        out = out.trigger(processingTime=trigger)
    return out.start()


def drain(*queries: StreamingQuery) -> None:
    """Wait until every query has stopped. The first failure is raised, whichever query it hits,
    after the other queries have been stopped."""
    running = list(queries)
    try:
        while running:
            running = [query for query in running if not query.awaitTermination(1)]
    except Exception:
        for query in queries:
            query.stop()
        raise
