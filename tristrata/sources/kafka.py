"""Kafka stream source. Needs the spark-sql-kafka module on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topics: list[str] | str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """``min_partitions`` splits a hot topic partition's offset range over several tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka_stream(
    spark: SparkSession, servers: str, topics: list[str] | str, **settings
) -> DataFrame:
    """Subscribe to one or more topics; see ``kafka_options`` for the settings."""
    options = kafka_options(servers, topics, **settings)
    return spark.readStream.format("kafka").options(**options).load()
