"""One cleaned output per topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tristrata.operators.silver import clean_topic
from tristrata.schemas import SILVER_KEYS
from tristrata.sinks.files import gather
from tristrata.streaming.run import to_files


def fan_out(
    source: DataFrame | Callable[[str], DataFrame],
    schemas: dict[str, str | StructType],
    out: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
) -> dict[str, StreamingQuery]:
    """Start a query per topic: filter, decode, drop rows without keys, add the date, write.

    All queries run side by side; wait on them together. Give ``source`` as a function from
    topic to stream (a stream over that topic's directory, or a subscription to it) so that
    no query reads another topic's rows.
    """
    queries = {}
    for topic, schema in schemas.items():
        rows = source(topic) if callable(source) else source
        queries[topic] = to_files(
            gather(clean_topic(rows, topic, schema), SILVER_KEYS),
            f"{out}/{topic}",
            f"{checkpoint}/{topic}",
            partition_by=SILVER_KEYS,
            trigger=trigger,
        )
    return queries
