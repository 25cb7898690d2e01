"""Ingest: envelope, event time, routing and keys."""

from pyspark.sql import functions as F

from tristrata.functions.text import message_key as key_of
from tristrata.functions.timefns import now
from tristrata.operators.bronze import project_envelope, stamp_ingest, to_bronze
from tristrata.operators.cleanse import add_audit_columns
from tristrata.operators.routing import route
from tristrata.operators.silver import for_topic, list_topics
from tristrata.plans.registry import query
from tristrata.plans.tables import iso_time, kafka_rows, ntz, sensor_payload, table

BRONZE_COLUMNS = [
    "topic", "partition", "offset", "kafka_timestamp", "event_time", "year", "month", "day",
]

BRONZE_SQL = """
SELECT 'sensors.' || event_type AS topic,
       CAST(event_id % 3 AS INTEGER) AS "partition",
       event_id AS "offset",
       ts AS kafka_timestamp,
       ts AS event_time,
       CAST(year(ts) AS INTEGER) AS "year",
       CAST(month(ts) AS INTEGER) AS "month",
       CAST(day(ts) AS INTEGER) AS "day"
FROM events"""


def compared(bronze):
    return bronze.select(*BRONZE_COLUMNS).withColumns(ntz("kafka_timestamp", "event_time"))


@query(BRONZE_SQL)
def bronze_envelope(spark, sf_dir):
    return compared(to_bronze(kafka_rows(table(spark, sf_dir, "events"))))


def bad_time_rows(events):
    """Bronze rows whose payload holds no time, or text that is none, for two of the types."""
    time = F.when(F.col("event_type") == "error", F.lit("not a time")).when(
        F.col("event_type") != "view", iso_time()
    )
    return to_bronze(kafka_rows(events, sensor_payload(time)))


@query(
    """
SELECT 'sensors.' || event_type AS topic, event_id AS "offset",
       CASE WHEN event_type NOT IN ('error', 'view') THEN ts END AS event_time,
       CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(year(ts) AS INTEGER) END AS "year",
       CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(month(ts) AS INTEGER) END AS "month",
       CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(day(ts) AS INTEGER) END AS "day"
FROM events"""
)
def bronze_bad_times(spark, sf_dir):
    """Malformed and missing times give null keys; no row is lost and nothing is raised."""
    bronze = bad_time_rows(table(spark, sf_dir, "events"))
    return bronze.select("topic", "offset", "event_time", "year", "month", "day").withColumns(
        ntz("event_time")
    )


@query(
    """
SELECT event_id, 'sensors/' || kind || '/' || user_id AS path, 'sensors.' || kind AS topic
FROM (SELECT event_id, user_id,
             CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'air_quality'
                             WHEN 'purchase' THEN 'motion' ELSE 'weather' END AS kind
      FROM events) e
WHERE kind <> 'weather'"""
)
def route_topics(spark, sf_dir):
    kind = (
        F.when(F.col("event_type") == "click", "temperature")
        .when(F.col("event_type") == "view", "air_quality")
        .when(F.col("event_type") == "purchase", "motion")
        .otherwise("weather")
    )
    path = F.concat_ws("/", F.lit("sensors"), kind, F.col("user_id").cast("string"))
    return route(table(spark, sf_dir, "events").select("event_id", path.alias("path")), "path")


@query(
    """
SELECT event_id AS "offset",
       '{"device_id":"' || user_id || '","timestamp":"'
         || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"}' AS "key"
FROM events"""
)
def message_key(spark, sf_dir):
    rows = kafka_rows(table(spark, sf_dir, "events"))
    payload = F.col("value").cast("string")
    return rows.select("offset", key_of(["device_id", "timestamp"], payload).alias("key"))


@query(
    """
SELECT event_id, user_id, ts, value, event_type AS topic FROM events
WHERE event_type = 'purchase'"""
)
def topic_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return for_topic(
        events.select("event_id", "user_id", "ts", "value", F.col("event_type").alias("topic")),
        "purchase",
    )


@query("SELECT DISTINCT event_type AS topic FROM events")
def distinct_topics(spark, sf_dir):
    return list_topics(table(spark, sf_dir, "events").withColumnRenamed("event_type", "topic"))


@query(
    """
SELECT event_id AS "offset", true AS kafka_time_kept, true AS ingested, true AS dated_by_run,
       true AS local_clock_runs
FROM events"""
)
def clock_stamps(spark, sf_dir):
    """The run's stamps: set on every row, and in line with each other."""
    rows = stamp_ingest(project_envelope(kafka_rows(table(spark, sf_dir, "events"))))
    stamped = add_audit_columns(rows).withColumn("local_now", now())
    return stamped.select(
        "offset",
        (F.col("kafka_timestamp") == F.col("timestamp")).alias("kafka_time_kept"),
        (F.col("ingestion_ts") == F.col("created_at")).alias("ingested"),
        (F.col("processing_date") == F.to_date("created_at")).alias("dated_by_run"),
        (F.col("local_now").cast("timestamp") == F.col("created_at")).alias("local_clock_runs"),
    )
