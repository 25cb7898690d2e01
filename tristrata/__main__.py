"""Run a job: ``spark-submit … -m tristrata <job> …`` or ``python -m tristrata <job> …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tristrata.plans import jobs


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tristrata")
    commands = parser.add_subparsers(dest="job", required=True)
    ingest = commands.add_parser("ingest", help="files to Parquet")
    ingest.add_argument("input_path", nargs="?", default="data/input/")
    ingest.add_argument("output_path", nargs="?", default="data/output/")
    ingest.add_argument("fmt", nargs="?", default="csv")
    clean = commands.add_parser("cleanse", help="clean contacts")
    clean.add_argument("input_path", nargs="?", default="data/raw/")
    clean.add_argument("output_path", nargs="?", default="data/cleansed/")
    gold = commands.add_parser("aggregate", help="roll up by period")
    gold.add_argument("input_path", nargs="?", default="data/cleansed/")
    gold.add_argument("output_path", nargs="?", default="data/aggregated/")
    gold.add_argument("kind", nargs="?", default="daily")
    for batch in (ingest, clean, gold):
        batch.add_argument("--audit-path")
    bronze = commands.add_parser("bronze", help="Kafka to partitioned JSON")
    bronze.add_argument("servers")
    bronze.add_argument("output_path")
    bronze.add_argument("checkpoint")
    bronze.add_argument("--topics", default=",".join(jobs.INGEST_TOPICS))
    bronze.add_argument("--starting", default="earliest")
    bronze.add_argument("--min-partitions", type=int)
    bronze.add_argument("--max-offsets", type=int)
    silver = commands.add_parser("silver", help="partitioned JSON to the silver table")
    silver.add_argument("input_path")
    silver.add_argument("table")
    silver.add_argument("checkpoint")
    silver.add_argument("--topic", default="sensors.temperature")
    silver.add_argument("--fmt", default="parquet")
    silver.add_argument("--max-files", type=int, default=10)
    silver.add_argument("--max-bytes", type=int)
    for stream in (bronze, silver):
        stream.add_argument("--trigger")
        stream.add_argument("--gather-files", action="store_true")
    options = vars(parser.parse_args(argv))
    job = {
        "ingest": jobs.ingest_files,
        "cleanse": jobs.cleanse,
        "aggregate": jobs.aggregate,
        "bronze": jobs.kafka_to_bronze,
        "silver": jobs.bronze_to_silver,
    }[options.pop("job")]
    spark = SparkSession.builder.appName(f"tristrata-{job.__name__}").getOrCreate()
    result = job(spark, **options)
    if hasattr(result, "awaitTermination"):
        result.awaitTermination()
    else:
        result.show(truncate=False)


if __name__ == "__main__":
    main()
