"""Keep what does not parse apart from what does."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tristrata.operators.silver import split_corrupt
from tristrata.schemas import CORRUPT
from tristrata.streaming.run import to_files, writer


def mark_invalid(df: DataFrame, bad: Column | None = None) -> DataFrame:
    """Add ``validation_status``: ``invalid`` where ``bad`` holds, else ``valid``.

    By default a row is bad whose text was kept as corrupt.
    """
    rule = F.col(CORRUPT).isNotNull() if bad is None else bad
    return df.withColumn("validation_status", F.when(rule, "invalid").otherwise("valid"))


def to_marked_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    bad: Column | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Write good and bad rows in one pass, in directories by ``validation_status``.

    Each row is parsed and written once; a reader of valid rows skips the other directory.
    """
    keys = ["validation_status", *(partition_by or [])]
    return to_files(mark_invalid(df, bad), path, checkpoint, fmt, keys, trigger)


def with_dead_letters(
    df: DataFrame,
    write_good: Callable[[DataFrame, int], None],
    write_bad: Callable[[DataFrame, int], None],
    checkpoint: str,
    column: str = CORRUPT,
    trigger: str | None = None,
) -> StreamingQuery:
    """Send good rows to one sink and bad rows to another, for sinks of different kinds.

    Both writers get the batch number; a batch may come again after a failure, so they must
    replace what they wrote for the same number. The batch is kept for the second write, on
    disk where memory is short, and parsed again where an executor was lost.
    """

    def split(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            good, bad = split_corrupt(batch, column)
            write_good(good, number)
            write_bad(bad, number)
        finally:
            batch.unpersist()

    return writer(df, checkpoint, trigger).foreachBatch(split).start()


def batch_files(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A writer that keeps each batch in a directory of its number and replaces it on replay."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={number}")

    return write
