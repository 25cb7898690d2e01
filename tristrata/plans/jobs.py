"""The five jobs, from files or Kafka to Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tristrata.operators.audit import run_with_audit
from tristrata.operators.bronze import to_bronze
from tristrata.operators.cleanse import cleanse_contacts
from tristrata.operators.gold import period_rollup
from tristrata.operators.quality import DataQualityError, any_null
from tristrata.operators.silver import to_silver
from tristrata.schemas import BRONZE, BRONZE_KEYS, INGEST_TOPICS, SILVER_KEYS
from tristrata.sinks.files import gather, write_cleansed, write_parquet, write_rollup
from tristrata.sinks.rollups import apply_increment, read_rollup
from tristrata.sources.catalog import create_table
from tristrata.sources.files import read_files, read_json_stream, read_topic_stream
from tristrata.sources.kafka import read_kafka_stream
from tristrata.streaming.run import to_files, to_table


def ingest_files(
    spark: SparkSession,
    input_path: str = "data/input/",
    output_path: str = "data/output/",
    fmt: str = "csv",
    audit_path: str | None = None,
    **read_options,
) -> DataFrame:
    """Files to Parquet, with the run record; its metrics hold the rows with nulls.

    An empty input is an error and leaves the output as it is. Rows, and rows with nulls, are
    counted while they are written.
    """
    df = read_files(spark, input_path, fmt, **read_options)

    def write(rows: DataFrame) -> None:
        if df.isEmpty():
            raise DataQualityError("No data found to process")
        write_parquet(rows, output_path)

    nulls = F.count_if(any_null(df))
    return run_with_audit("file-ingestion", df, write, audit_path, {"records_with_nulls": nulls})


def cleanse(
    spark: SparkSession,
    input_path: str = "data/raw/",
    output_path: str = "data/cleansed/",
    audit_path: str | None = None,
) -> DataFrame:
    """Cleanse contacts and store them by processing date."""
    rows = cleanse_contacts(spark.read.parquet(input_path))
    return run_with_audit(
        "data-cleansing", rows, lambda df: write_cleansed(df, output_path), audit_path
    )


def aggregate(
    spark: SparkSession,
    input_path: str = "data/cleansed/",
    output_path: str = "data/aggregated/",
    kind: str = "daily",
    audit_path: str | None = None,
) -> DataFrame:
    """Roll amounts up by period; the metrics hold the number of input rows."""
    rollup = period_rollup(spark.read.parquet(input_path), kind)
    return run_with_audit(
        "aggregation",
        rollup,
        lambda df: write_rollup(df, output_path, kind),
        audit_path,
        {"input_records": F.sum("total_records")},
    )


def aggregate_increment(
    spark: SparkSession,
    input_path: str,
    increment: str,
    state_path: str = "data/rollups/",
    output_path: str = "data/aggregated/",
    kind: str = "daily",
) -> bool:
    """Merge one increment's rows into the stored rollup and write the rollup out; earlier rows
    are not read. An increment of that name that was merged before changes nothing."""
    path = f"{state_path.rstrip('/')}/{kind}"
    merged = apply_increment(path, spark.read.parquet(input_path), increment, kind)
    write_rollup(read_rollup(spark, path, kind), output_path, kind)
    return merged


def kafka_to_bronze(
    spark: SparkSession,
    servers: str,
    output_path: str,
    checkpoint: str,
    topics: list[str] | str = INGEST_TOPICS,
    trigger: str | None = None,
    strict: bool = False,
    gather_files: bool = False,
    **kafka,
) -> StreamingQuery:
    """Kafka to partitioned JSON.

    A task holds a stretch of one topic, mostly of one day, and so writes few files.
    ``gather_files`` shuffles each batch by directory first, for a backlog of many days.
    """
    rows = to_bronze(read_kafka_stream(spark, servers, topics, **kafka), strict)
    if gather_files:
        rows = gather(rows, BRONZE_KEYS)
    return to_files(rows, output_path, checkpoint, "json", BRONZE_KEYS, trigger)


def bronze_to_silver(
    spark: SparkSession,
    input_path: str,
    table: str,
    checkpoint: str,
    topic: str | None = "sensors.temperature",
    fmt: str = "parquet",
    trigger: str | None = None,
    location: str | None = None,
    strict: bool = False,
    gather_files: bool = False,
    **stream,
) -> StreamingQuery:
    """Bronze JSON to the silver table, which is created if it is absent.

    Only the topic's own directory is read; ``topic=None`` takes all of them. Give
    ``max_bytes`` for a large backlog. ``gather_files`` shuffles each batch by day first, for
    a backlog of many days whose small files share tasks.
    """
    create_table(spark, table, fmt=fmt, location=location)
    if topic is None:
        bronze = read_json_stream(spark, input_path, f"{BRONZE}, topic STRING", **stream)
    else:
        bronze = read_topic_stream(spark, input_path, topic, **stream)
    rows = to_silver(bronze, topic, strict=strict)
    if gather_files:
        rows = gather(rows, SILVER_KEYS)
    return to_table(rows, table, checkpoint, fmt, trigger)
