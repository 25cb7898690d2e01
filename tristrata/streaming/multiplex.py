"""All topics of a stream by one query, those too that appear while it runs.

A micro-batch is written once, into directories by topic and day, with its payloads as variants: a
topic needs no schema to be stored, so none has to be known when the query starts. What shapes the
payloads have is then read from the batch's own files, and a topic whose schema they widen gets a new
version in the schema log. Readers type all rows of a topic under one version, by default the last.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType, VariantType

from tristrata.functions.lattice import ddl, join_structs, settled
from tristrata.operators.silver import add_partition_date, drop_null_keys
from tristrata.schemas import CORRUPT, SILVER_KEYS
from tristrata.sinks.files import gather
from tristrata.sinks.merge import any_files, discard
from tristrata.sources.inference import shape_type
from tristrata.streaming.run import writer

BATCH = "batch_id"
LOG = "topic STRING, version INT, kind STRING, batch_id BIGINT"


def as_variants(rows: DataFrame, keep: Iterable[str] = (), keys: list[str] = SILVER_KEYS) -> DataFrame:
    """Bronze rows with the payload as a variant. Text that is no JSON object is kept as it is in
    ``_corrupt_record``, with a null payload."""
    parsed = F.try_parse_json("value")
    rows = rows.select("topic", *keys, *keep, "value", parsed.alias("payload"))
    whole = F.schema_of_variant("payload").startswith("OBJECT<")
    return rows.select(
        "topic", *keys, *keep,
        F.when(whole, F.col("payload")).alias("payload"),
        F.when(F.coalesce(whole, F.lit(False)), None).otherwise(F.col("value")).alias(CORRUPT),
    )


def multiplex(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    trigger: str | None = None,
    keep: Iterable[str] = (),
    keys: list[str] = SILVER_KEYS,
) -> StreamingQuery:
    """Start the query. Rows have ``topic``, ``value`` as text, and the keys of a day; ``keep`` names
    further columns to store.

    One write per batch, whatever the number of topics, and one pass over the payloads it wrote for
    their shapes, of which one row per topic and task is shuffled. The driver holds one schema for
    each topic. A batch that is run again replaces what its earlier try left, rows and versions.
    """
    keep = list(keep)

    def store(batch: DataFrame, number: int) -> None:
        into = f"{out}/rows/{BATCH}={number}"
        stored = as_variants(batch, keep, keys)
        by = ["topic", *keys]
        gather(stored, by).write.mode("overwrite").partitionBy(*by).parquet(into)
        fields = [f for f in stored.schema.fields if f.name in ("topic", "payload")]
        written = batch.sparkSession.read.schema(StructType(fields)).parquet(into)
        widen(written, out, number)

    return writer(rows, checkpoint, trigger).foreachBatch(store).start()


def widen(rows: DataFrame, out: str, number: int) -> None:
    """Join the shapes of a batch's payloads with the schemas before it, and log those that grew."""
    spark = rows.sparkSession
    shapes = rows.groupBy("topic").agg(F.schema_of_variant_agg("payload").alias("shape"))
    known = _latest(spark, out, before=number)
    grown = []
    for row in shapes.collect():
        seen = shape_type(row.shape)
        if seen is None:
            continue
        version, kind = known.get(row.topic, (0, StructType([])))
        wider = join_structs(kind, seen)
        if version == 0 or wider != kind:
            grown.append((row.topic, version + 1, wider.json()))
    entry = f"{out}/schemas/{BATCH}={number}"
    if grown:
        log = spark.createDataFrame(grown, "topic STRING, version INT, kind STRING")
        log.coalesce(1).write.mode("overwrite").parquet(entry)
    else:
        discard(spark, entry, entry)


def schema_log(spark: SparkSession, out: str) -> DataFrame:
    """A row per topic and version: the schema as JSON text, and the batch that brought it."""
    path = f"{out}/schemas"
    if not any_files(spark, path):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(path)


def _latest(
    spark: SparkSession, out: str, before: int | None = None, version: int | None = None
) -> dict[str, tuple[int, StructType]]:
    log = schema_log(spark, out)
    if before is not None:
        log = log.filter(F.col(BATCH) < before)
    if version is not None:
        log = log.filter(F.col("version") <= version)
    last = log.groupBy("topic").agg(F.max_by(F.struct("version", "kind"), "version").alias("at"))
    return {
        row.topic: (row.at.version, StructType.fromJson(json.loads(row.at.kind)))
        for row in last.collect()
    }


def topic_types(
    spark: SparkSession, out: str, version: int | None = None
) -> dict[str, tuple[int, StructType]]:
    """Topic -> its last version (or the last up to ``version``) and the schema to read it with."""
    found = _latest(spark, out, version=version)
    return {topic: (number, settled(kind)) for topic, (number, kind) in found.items()}


def stored_topics(
    spark: SparkSession, out: str, keep: str = "", keys: list[str] = SILVER_KEYS
) -> DataFrame:
    """All stored rows, untyped. ``keep`` is the DDL of the further columns stored."""
    schema = StructType.fromDDL(keep) if keep else StructType()
    schema = schema.add("payload", VariantType()).add(CORRUPT, "string").add("topic", "string")
    for key in keys:
        schema = schema.add(key, "integer")
    return spark.read.schema(schema.add(BATCH, "long")).parquet(f"{out}/rows")


def read_topic(
    rows: DataFrame, topic: str, schema: StructType, required: list[str] | None = None
) -> DataFrame:
    """One topic of ``stored_topics``, typed: its payload's fields beside the stored columns that
    they do not hide. Other topics' directories are not read.

    A value that does not fit its field is null there. Rows that lack a key, by default those of
    device and time that the schema has, are left out, as are those that are no objects.
    """
    names = schema.names
    kept = [c for c in rows.columns if c not in ("payload", CORRUPT, *names)]
    typed = F.try_variant_get("payload", "$", ddl(schema))
    mine = rows.filter((F.col("topic") == topic) & F.col("payload").isNotNull())
    out = mine.select(*kept, F.inline(F.array(typed))) if names else mine.select(*kept)
    if required is None:
        required = [k for k in ("device_id", "timestamp") if k in names]
    if required:
        out = drop_null_keys(out, required)
    return add_partition_date(out) if "timestamp" in names else out


def read_corrupt(rows: DataFrame) -> DataFrame:
    """The rows whose payload was no JSON object, with its text."""
    return rows.filter(F.col("payload").isNull()).drop("payload")
