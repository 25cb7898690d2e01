"""File sources, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tristrata.schemas import BRONZE, struct, with_corrupt

# Format -> reader options. Avro needs the spark-avro module on the class path.
FORMATS = {
    "csv": {"header": "true", "inferSchema": "true"},
    "json": {},
    "parquet": {},
    "avro": {},
}


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: str | StructType | None = None,
    glob: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a batch of files. ``topic=…/year=…`` directories become columns.

    Without ``schema``, CSV and JSON are read once more to infer one; give it for large inputs.
    """
    name = fmt.lower()
    if name not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    settings = {**FORMATS[name], **options}
    reader = spark.read.format(name)
    if schema is not None:
        reader = reader.schema(schema)
        settings.pop("inferSchema", None)
    if glob:
        settings["pathGlobFilter"] = glob
    return reader.options(**settings).load(path)


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = BRONZE,
    max_files: int | None = 10,
    max_bytes: int | None = None,
    glob: str = "*.json",
    keep_corrupt: bool = False,
    **options: str,
) -> DataFrame:
    """Stream JSON files under a fixed schema; bad lines give null rows, not errors.

    ``keep_corrupt`` adds the column that holds the text of a bad line. For a large backlog
    bound a micro-batch by ``max_bytes`` instead of by ``max_files``.
    """
    rate = {"maxBytesPerTrigger": str(max_bytes)} if max_bytes else {}
    if max_files and not max_bytes:
        rate = {"maxFilesPerTrigger": str(max_files)}
    return (
        spark.readStream.format("json")
        .schema(with_corrupt(schema) if keep_corrupt else struct(schema))
        .options(mode="PERMISSIVE", pathGlobFilter=glob, **rate, **options)
        .load(path)
    )


def read_topic_stream(spark: SparkSession, path: str, topic: str, **settings) -> DataFrame:
    """Stream one topic's directory of Bronze: files of other topics are not even listed."""
    rows = read_json_stream(spark, f"{path}/topic={topic}", **settings)
    return rows.withColumn("topic", F.lit(topic))


def read_parquet_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    max_files: int | None = None,
    max_bytes: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream Parquet files: with the Kafka row shape this replays a topic.

    ``path`` may be a glob that matches single files. A micro-batch is bounded by ``max_bytes``
    or ``max_files``.
    """
    rate = {"maxBytesPerTrigger": str(max_bytes)} if max_bytes else {}
    if max_files and not max_bytes:
        rate = {"maxFilesPerTrigger": str(max_files)}
    return spark.readStream.schema(struct(schema)).options(**rate, **options).parquet(path)
