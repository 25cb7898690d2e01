"""Decode, flatten, conform and cleanse."""

import re
from functools import reduce

from pyspark.sql import functions as F

from tristrata.functions import timefns
from tristrata.operators.bronze import to_bronze
from tristrata.operators.cleanse import (
    add_audit_columns,
    dedupe,
    partition_key,
)
from tristrata.operators.cleanse import cleanse_contacts as cleanse
from tristrata.operators.silver import (
    add_partition_date,
    decode_by_topic as by_topic,
    drop_null_keys as without_null_keys,
    expand,
    list_topics,
    to_silver,
)
from tristrata.plans.registry import query
from tristrata.plans.tables import iso_time, kafka_rows, ntz, table
from tristrata.schemas import PAYLOADS
from tristrata.scratch import scratch
from tristrata.sinks.files import gather, write_partitioned
from tristrata.sources.inference import infer_schemas

SILVER_SQL = """
SELECT CAST(user_id AS VARCHAR) AS device_id, ts AS device_ts, event_type AS sensor_type,
       CAST(event_id % 180 - 89.5 AS DOUBLE) AS latitude,
       CAST(event_id % 360 - 179.5 AS DOUBLE) AS longitude,
       'city_' || user_id AS city, value AS temperature,
       CAST(event_id % 50 + 30.0 AS DOUBLE) AS humidity, '°C' AS unit, ts AS event_time,
       CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
       CAST(day(ts) AS INTEGER) AS "day"
FROM events"""


@query(SILVER_SQL)
def silver_flatten(spark, sf_dir):
    bronze = to_bronze(kafka_rows(table(spark, sf_dir, "events")))
    return to_silver(bronze, topic=None).withColumns(ntz("device_ts", "event_time"))


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def silver_star_expand(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return expand(events, "k BIGINT", "props", keep=["event_id", "event_type"])


@query(
    """
SELECT event_id, event_type AS topic, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events"""
)
def silver_inferred_schema(spark, sf_dir):
    """Rows stored by topic; each topic's schema inferred from its payloads and used on them."""
    path = scratch(spark, "inferred")
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("topic"), F.col("props").alias("value")
    )
    write_partitioned(gather(rows, ["topic"]), path, ["topic"])
    stored = spark.read.schema(rows.schema).parquet(path)
    topics = [row.topic for row in list_topics(stored).collect()]
    decoded = by_topic(stored, infer_schemas(stored, topics))
    return reduce(lambda a, b: a.unionByName(b), decoded.values())


def kind_of_event():
    """Deal the events out to the eight payload kinds."""
    return F.element_at(
        F.array(*[F.lit(t) for t in PAYLOADS]), (F.col("event_id") % len(PAYLOADS) + 1).cast("int")
    )


# Payload field -> what it holds, in SQL that both engines read alike.
FIELDS = {
    "device_id": "CAST(user_id AS STRING)",
    "sensor_type": "event_type",
    "location.latitude": "CAST(event_id % 180 AS DOUBLE) - 89.5",
    "location.longitude": "CAST(event_id % 360 AS DOUBLE) - 179.5",
    "location.city": "'city_' || user_id",
    "temperature": "value",
    "humidity": "CAST(event_id % 50 AS DOUBLE) + 30",
    "unit": "'u' || (event_id % 3)",
    "pm25": "value",
    "pm10": "value * 2",
    "co2": "CAST(event_id % 1700 + 300 AS INT)",
    "aqi": "CAST(event_id AS INT)",
    "motion_detected": "value > 100",
    "confidence": "value",
    "battery_level": "CAST(event_id AS INT)",
    "power_consumption": "value / 4",
    "voltage": "value",
    "current": "CAST(event_id % 10 AS DOUBLE) / 4",
    "vehicle_id": "'v' || user_id",
    "speed": "value",
    "fuel_level": "CAST(event_id % 91 + 10 AS DOUBLE)",
    "engine_temp": "CAST(event_id % 26 + 80 AS DOUBLE)",
    "mileage": "CAST(event_id AS INT)",
    "pressure": "value",
    "wind_speed": "CAST(event_id % 31 AS DOUBLE)",
    "wind_direction": "CAST(event_id AS INT)",
    "precipitation": "CAST(event_id % 51 AS DOUBLE)",
    "user_id": "CAST(user_id AS STRING)",
    "session_id": "'s' || event_id",
    "event_type": "event_type",
    "ip_address": "'10.0.' || (event_id % 256) || '.' || (user_id % 256)",
    "user_agent": "'agent/' || (event_id % 7)",
    "page": "'/p/' || (event_id % 50)",
    "country": "'c' || (user_id % 20)",
    "device_type": "CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END",
    "transaction_id": "'t' || event_id",
    "account_id": "CAST(user_id AS STRING)",
    "amount": "value",
    "currency": "'EUR'",
    "transaction_type": "CASE event_id % 2 WHEN 0 THEN 'debit' ELSE 'credit' END",
    "merchant": "'m' || (user_id % 30)",
    "category": "CASE event_id % 2 WHEN 0 THEN 'food' ELSE 'transport' END",
    "location": "'place_' || user_id",
}
TIME_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def payload_names(topic):
    """The fields of a kind's payload; a place of its own for each part of a nested one."""
    names = []
    for name, kind in re.findall(r"(\w+) (STRUCT<[^>]*>|\w+)", PAYLOADS[topic]):
        parts = re.findall(r"(\w+):", kind)
        names += [f"{name}.{part}" for part in parts] or [name]
    return names


def payload_of(topic):
    """An event as a message of a kind, with every field filled."""
    fields, nested = {}, {}
    for name in payload_names(topic):
        whole, _, part = name.partition(".")
        value = iso_time() if name == "timestamp" else F.expr(FIELDS[name])
        if part:
            nested.setdefault(whole, []).append(value.alias(part))
            value = F.struct(*nested[whole])
        fields[whole] = value
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def mixed_rows(events):
    """Events as messages of all eight kinds, each with its own payload."""
    payload = F.lit(None).cast("string")
    for topic in PAYLOADS:
        payload = F.when(F.col("topic") == topic, payload_of(topic)).otherwise(payload)
    rows = events.withColumn("topic", kind_of_event())
    return rows.select("topic", F.col("event_id").alias("offset"), payload.alias("value"))


# Topic -> who sent it, and one field of its own.
MEASURES = {
    "sensors.temperature": ("device_id", "temperature"),
    "sensors.air_quality": ("device_id", "aqi"),
    "sensors.motion": ("device_id", "motion_detected"),
    "sensors.smart_meter": ("device_id", "voltage"),
    "sensors.vehicle": ("device_id", "mileage"),
    "sensors.weather": ("device_id", "wind_direction"),
    "events.user": ("user_id", "event_type"),
    "financial.transactions": ("account_id", "amount"),
}


@query(
    """
SELECT CASE event_id % 8
         WHEN 0 THEN 'sensors.temperature' WHEN 1 THEN 'sensors.air_quality'
         WHEN 2 THEN 'sensors.motion' WHEN 3 THEN 'sensors.smart_meter'
         WHEN 4 THEN 'sensors.vehicle' WHEN 5 THEN 'sensors.weather'
         WHEN 6 THEN 'events.user' ELSE 'financial.transactions' END AS topic,
       event_id AS "offset", CAST(user_id AS VARCHAR) AS sender,
       CASE event_id % 8
         WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN CAST(event_id AS VARCHAR)
         WHEN 2 THEN CASE WHEN value > 100 THEN 'true' ELSE 'false' END
         WHEN 3 THEN CAST(value AS VARCHAR) WHEN 4 THEN CAST(event_id AS VARCHAR)
         WHEN 5 THEN CAST(event_id AS VARCHAR) WHEN 6 THEN event_type
         ELSE CAST(value AS VARCHAR) END AS measure
FROM events"""
)
def decode_by_topic(spark, sf_dir):
    """All eight payload kinds, stored by topic and each read and decoded on its own."""
    decoded = by_topic(stored_kinds(spark, sf_dir))
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            decoded[topic].select(
                "topic",
                "offset",
                F.col(sender).alias("sender"),
                F.col(measure).cast("string").alias("measure"),
            )
            for topic, (sender, measure) in MEASURES.items()
        ],
    )


def stored_kinds(spark, sf_dir):
    """Messages of all kinds, stored by topic."""
    path = scratch(spark, "mixed")
    rows = mixed_rows(table(spark, sf_dir, "events"))
    write_partitioned(gather(rows, ["topic"]), path, ["topic"])
    return spark.read.parquet(path)


def flat(name):
    return name.replace(".", "_")


def register_kind(number, topic):
    """A query that decodes one kind and gives all fields of its payload."""
    names = payload_names(topic)

    def decode(spark, sf_dir):
        decoded = by_topic(stored_kinds(spark, sf_dir), {topic: PAYLOADS[topic]})[topic]
        return decoded.select("offset", *[F.col(n).alias(flat(n)) for n in names])

    decode.__name__ = f"decode_{topic.rsplit('.', 1)[1]}"
    decode.__doc__ = f"All fields of ``{topic}``."
    values = [f'{TIME_SQL if n == "timestamp" else FIELDS[n]} AS "{flat(n)}"' for n in names]
    where = f"event_id % {len(PAYLOADS)} = {number}"
    query(f'SELECT event_id AS "offset", {", ".join(values)} FROM events WHERE {where}')(decode)


for _number, _topic in enumerate(PAYLOADS):
    register_kind(_number, _topic)


@query(
    """
SELECT event_id, CAST(user_id AS VARCHAR) AS device_id, ts, value FROM events
WHERE event_type NOT IN ('error', 'view')"""
)
def drop_null_keys(spark, sf_dir):
    """Rows that lack the device or the time go."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("device_id"),
        F.when(F.col("event_type") != "view", F.col("ts")).alias("ts"),
        "value",
    )
    return without_null_keys(rows, ["device_id", "ts"])


@query("SELECT event_id, CAST(ts AS DATE) AS partition_date FROM events")
def partition_date(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", iso_time().alias("timestamp"))
    return add_partition_date(rows).drop("timestamp")


def contacts(customer, *keep):
    """Customers with an untidy e-mail, unusable in one segment, and phone; each row twice.

    ``keep`` names further columns to take along.
    """
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(
        F.translate("c_name", "#", ".")
    )
    rows = customer.select(
        "c_custkey",
        F.concat(F.lit("  "), name, F.lit("@Example.COM ")).alias("email"),
        F.concat(
            F.lit("+1 ("), F.col("c_nationkey").cast("string"), F.lit(") "),
            F.col("c_custkey").cast("string"), F.lit("-00"),
        ).alias("phone"),
        *keep,
    )
    return rows.unionAll(rows)


CONTACTS_SQL = """
SELECT DISTINCT c_custkey,
       lower(trim('  ' || CASE WHEN c_mktsegment = 'BUILDING' THEN c_name
                               ELSE translate(c_name, '#', '.') END || '@Example.COM ')) AS email,
       regexp_replace('+1 (' || c_nationkey || ') ' || c_custkey || '-00', '[^0-9+]', '', 'g')
         AS phone,
       CAST(1.0 AS DOUBLE) AS data_quality_score
FROM customer WHERE c_mktsegment <> 'BUILDING'"""


@query(CONTACTS_SQL)
def cleanse_contacts(spark, sf_dir):
    rows = contacts(table(spark, sf_dir, "customer"))
    return cleanse(rows).drop("processing_date", "created_at")


@query(
    """
SELECT event_id, 'events' AS source_system, 1 AS "version", false AS is_deleted,
       event_type || '|' || user_id AS partition_key
FROM events"""
)
def audit_columns(spark, sf_dir):
    rows = add_audit_columns(
        table(spark, sf_dir, "events"),
        source_system="events",
        version=1,
        is_deleted=False,
        partition_key=partition_key("event_type", "user_id"),
    )
    return rows.select("event_id", "source_system", "version", "is_deleted", "partition_key")


@query("SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events) e")
def dedupe_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dedupe(events.unionAll(events))


@query(
    """
SELECT 'sensors.' || event_type AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
       event_id AS "offset", ts AS "timestamp"
FROM events"""
)
def dedupe_records(spark, sf_dir):
    """Records read twice from the log, once each by topic, partition and offset."""
    rows = kafka_rows(table(spark, sf_dir, "events")).drop("value")
    once = dedupe(rows.unionAll(rows), ["topic", "partition", "offset"])
    return once.withColumns(ntz("timestamp"))


@query(
    """
SELECT o_orderkey, date_trunc('second', o_orderdate) AS strict_ts,
       CASE WHEN o_orderstatus <> 'P' THEN date_trunc('second', o_orderdate) END AS lenient_ts,
       o_orderdate AS iso_ts
FROM orders"""
)
def ts_parse(spark, sf_dir):
    text = F.date_format("o_orderdate", timefns.DEFAULT_FORMAT)
    untidy = F.when(F.col("o_orderstatus") == "P", "yesterday").otherwise(text)
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        timefns.parse_ts(text).alias("strict_ts"),
        timefns.parse_ts(untidy, strict=False).alias("lenient_ts"),
        timefns.parse_ts(iso, timefns.ISO_FORMAT).alias("iso_ts"),
    )


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y/%m') AS ts_month
FROM events"""
)
def ts_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        timefns.format_ts("ts").alias("ts_text"),
        timefns.format_ts("ts", "yyyy/MM").alias("ts_month"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_shipdate - INTERVAL 3 DAY AS three_days_before,
       l_shipdate + INTERVAL 30 HOUR AS thirty_hours_after,
       l_shipdate + to_days(CAST(l_linenumber AS INTEGER)) AS line_days_after
FROM lineitem"""
)
def ts_add(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        timefns.add_days("l_shipdate", -3).alias("three_days_before"),
        timefns.add_hours("l_shipdate", 30).alias("thirty_hours_after"),
        timefns.add_days("l_shipdate", F.col("l_linenumber")).alias("line_days_after"),
    )
