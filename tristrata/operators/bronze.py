"""Bronze: raw records with ingest stamps and calendar keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.functions.timefns import to_event_time


def project_envelope(df: DataFrame) -> DataFrame:
    """The five kept Kafka columns, with the binary value as text."""
    return df.select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"
    )


def stamp_ingest(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"kafka_timestamp": F.col("timestamp"), "ingestion_ts": F.current_timestamp()}
    )


def derive_event_time(df: DataFrame, path: str = "$.timestamp", strict: bool = False) -> DataFrame:
    """Event time and its year, month and day from a field of the payload.

    The keys follow the session time zone. A missing field gives nulls; so does malformed
    text, unless ``strict`` asks for an error.
    """
    event_time = to_event_time(F.get_json_object("value", path), strict)
    return df.withColumn("event_time", event_time).withColumns(
        {
            "year": F.year("event_time"),
            "month": F.month("event_time"),
            "day": F.dayofmonth("event_time"),
        }
    )


def to_bronze(df: DataFrame, strict: bool = False) -> DataFrame:
    """Kafka rows to Bronze rows, batch or stream."""
    return derive_event_time(stamp_ingest(project_envelope(df)), strict=strict)
