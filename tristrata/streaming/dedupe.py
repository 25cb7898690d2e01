"""Remove repeated records from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedupe_stream(
    df: DataFrame, keys: list[str], ts: str = "timestamp", delay: str | None = None
) -> DataFrame:
    """The first record of each key.

    Without ``delay`` every key is remembered for good. With it a key is forgotten once the
    watermark on ``ts`` has moved past it by that span, which bounds the state; records that
    come later than that are dropped by the watermark, so choose the span in which repeats
    and late records can still come.
    """
    if delay is None:
        return df.dropDuplicates(keys)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
