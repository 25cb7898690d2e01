"""The newest row per key as state of a stream, and the changes of it as the stream's output."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

# Kinds of changes.
INSERT, UPDATE, LATE, EXPIRED = "insert", "update", "late", "expired"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, which ``change_feed`` needs.
    The session's setting is put back at the end."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def _newer(one: Row, two: Row, names: list[str]) -> bool:
    """Whether ``one`` is as new as ``two`` or newer."""
    for c in names:
        a, b = one[c], two[c]
        if a is None or b is None:
            if (a is None) != (b is None):
                return b is None
        elif a != b:
            return a > b
    return True


class Newest(StatefulProcessor):
    """Holds the newest row of a key, and gives out how each batch changes it."""

    def __init__(self, row: StructType, order_by: list[str], keep_ms: int | None, clock: str):
        self.row, self.order_by, self.keep_ms, self.clock = row, order_by, keep_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("newest", self.row)
        if self.keep_ms is not None:
            self.until = handle.getValueState(
                "until", StructType([StructField("until", LongType())])
            )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = None
        for row in rows:
            if best is None or _newer(row, best, self.order_by):
                best = row
        names = self.row.names
        best = Row(*names)(*[best[c] for c in names])
        stored = self.state.get() if self.state.exists() else None
        if stored is not None:
            stored = Row(*names)(*stored)
        if stored is None or _newer(best, stored, self.order_by):
            self.state.update(tuple(best))
            self._set_timer(best)
            yield self._out(INSERT if stored is None else UPDATE, best)
        else:
            yield self._out(LATE, best)

    def _out(self, kind: str, row: Row) -> Row:
        return Row("change", *self.row.names)(kind, *row)

    def _set_timer(self, row: Row) -> None:
        if self.keep_ms is None:
            return
        if self.until.exists():
            self.handle.deleteTimer(self.until.get()[0])
            self.until.clear()
        # A row without a time never expires.
        if row[self.clock] is not None:
            until = row[self.clock] // 1000 + self.keep_ms
            self.until.update((until,))
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        row = Row(*self.row.names)(*self.state.get())
        self.state.clear()
        self.until.clear()
        yield self._out(EXPIRED, row)

    def close(self) -> None:
        pass


def cut_in_tasks(changes: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Each task's rows cut to the newest per key of every Arrow batch, before they are shuffled:
    a key with a third of all rows is a few rows of each task."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ordered = frame.sort_values(order_by, kind="stable", na_position="first")
            yield ordered.drop_duplicates(keys, keep="last")

    return changes.mapInPandas(cut, changes.schema)


def change_feed(
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    clock: str | None = None,
    keep_seconds: int | None = None,
) -> DataFrame:
    """The stream's rows as changes of a state that holds the newest row per key.

    A batch gives one row per key that it has: ``insert`` for a new key, ``update`` where the
    batch's newest row is as new by ``order_by`` as the stored one or newer, ``late`` where it is
    older and was ignored. With ``keep_seconds``, a key is forgotten, and given out as
    ``expired``, when the watermark on ``clock`` has passed its row by so much; a later row is an
    insert again. Nulls are older than any value, and null keys are keys like others.

    The state must be in RocksDB (``rocksdb_state``): it grows with the keys, not the rows.
    """
    keep_ms = None if keep_seconds is None else keep_seconds * 1000
    if keep_ms is not None and clock is None:
        raise ValueError("keep_seconds needs a clock column with a watermark")
    instants = [f.name for f in changes.schema.fields if isinstance(f.dataType, TimestampType)]
    if keep_ms is not None and clock not in instants:
        raise ValueError("the clock must be a timestamp")
    # State and worker hand instants over with and without a zone; microseconds have none.
    rows = changes.withColumns({c: F.unix_micros(c) for c in instants})
    schema = rows.schema
    if keep_ms is None:
        rows = cut_in_tasks(rows, keys, order_by)
    else:
        # The watermark stays with the column that it was set on.
        rows = changes.select(
            *[F.unix_micros(c).alias(c) if c in instants else F.col(c) for c in schema.names],
            F.col(clock).alias("_watermarked"),
        )
    feed = rows.groupBy(*[F.col(k) for k in keys]).transformWithState(
        statefulProcessor=Newest(schema, order_by, keep_ms, clock),
        outputStructType=StructType([StructField("change", StringType()), *schema.fields]),
        outputMode="Append",
        timeMode="None" if keep_ms is None else "EventTime",
    )
    return feed.withColumns({c: F.timestamp_micros(c) for c in instants})
