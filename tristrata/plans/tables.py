"""The test tables in the shapes the operators take. All of it is derived by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.sources.files import read_parquet_stream

# What one micro-batch of a backlog may read.
BATCH_BYTES = 100 * 1024**3

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Micro-batches that a table is replayed in, and directories that its files are dealt out to.
BATCHES = 4
SLOTS = 8


def append_files(rows: DataFrame, path: str, slots: int = SLOTS) -> None:
    """Add rows to the input of a stream. Every task writes a file to each slot, so there are
    several files however few tasks there are, and as many tasks as the rows have."""
    slot = F.pmod(F.xxhash64(*rows.columns), F.lit(slots))
    rows.withColumn("slot", slot).write.mode("append").partitionBy("slot").parquet(path)


def replay(
    spark: SparkSession, rows: DataFrame, path: str, batches: int | None = BATCHES
) -> DataFrame:
    """The files of ``append_files`` as a stream of so many micro-batches of equally many files."""
    # Slots are no columns: files are looked for in all directories below.
    options = {"recursiveFileLookup": "true"}
    files = len(spark.read.options(**options).schema(rows.schema).parquet(path).inputFiles())
    return read_parquet_stream(
        spark, path, rows.schema, max_files=batches and -(-files // batches), **options
    )


def replayed(rows: DataFrame, path: str) -> DataFrame:
    """Rows as a stream of several micro-batches."""
    append_files(rows, path)
    return replay(rows.sparkSession, rows, path)


def iso_time(ts: str = "ts") -> Column:
    """ISO-8601 text with microseconds and the offset of the session time zone."""
    return F.date_format(ts, ISO_MICROS)


def sensor_payload(time: Column | None = None) -> Column:
    """An event as a temperature message."""
    return F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("device_id"),
            (iso_time() if time is None else time).alias("timestamp"),
            F.col("event_type").alias("sensor_type"),
            F.struct(
                (F.col("event_id") % 180 - 89.5).alias("latitude"),
                (F.col("event_id") % 360 - 179.5).alias("longitude"),
                F.concat(F.lit("city_"), F.col("user_id").cast("string")).alias("city"),
            ).alias("location"),
            F.col("value").alias("temperature"),
            (F.col("event_id") % 50 + 30.0).alias("humidity"),
            F.lit("°C").alias("unit"),
        )
    )


def kafka_rows(events: DataFrame, payload: Column | None = None) -> DataFrame:
    """Events, batch or stream, as rows of a Kafka source."""
    return events.select(
        (sensor_payload() if payload is None else payload).cast("binary").alias("value"),
        F.concat(F.lit("sensors."), "event_type").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def ntz(*names: str) -> dict[str, Column]:
    """Instants as wall-clock times, which is what the SQL twins give."""
    return {n: F.col(n).cast("timestamp_ntz") for n in names}
