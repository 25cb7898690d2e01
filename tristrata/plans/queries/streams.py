"""Structured Streaming: each query runs to the end of its input and gives what it wrote."""

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.operators.bronze import to_bronze
from tristrata.operators.silver import list_topics, to_silver
from tristrata.plans.queries.bronze import BRONZE_SQL, bad_time_rows
from tristrata.plans.queries.bronze import compared as bronze_compared
from tristrata.plans.queries.silver import SILVER_SQL
from tristrata.plans.queries.storage import read_bronze, write_bronze
from tristrata.plans.queries.upserts import MERGED_SQL, first_state
from tristrata.plans.registry import query
from tristrata.plans.tables import (
    BATCH_BYTES,
    append_files,
    kafka_rows,
    ntz,
    replay,
    replayed,
    table,
)
from tristrata.schemas import BRONZE, BRONZE_KEYS, SILVER_KEYS
from tristrata.scratch import scratch
from tristrata.sources.files import (
    read_files,
    read_json_stream,
    read_parquet_stream,
    read_topic_stream,
)
from tristrata.sources.inference import infer_schemas
from tristrata.sinks.files import gather
from tristrata.sinks.merge import any_files, write_target
from tristrata.streaming.audit import END, StreamAudit, read_records
from tristrata.streaming.changes import change_feed, rocksdb_state
from tristrata.streaming.dedupe import dedupe_stream
from tristrata.streaming.fanout import fan_out
from tristrata.streaming.gate import gate_stream, read_ledger
from tristrata.streaming.merge import merge_stream
from tristrata.streaming.multiplex import (
    multiplex,
    read_topic,
    schema_log,
    stored_topics,
    topic_types,
)
from tristrata.streaming.quarantine import (
    batch_files,
    mark_invalid,
    to_marked_files,
    with_dead_letters,
)
from tristrata.streaming.run import AVAILABLE_NOW, drain, to_files


def event_records(spark, sf_dir):
    return kafka_rows(table(spark, sf_dir, "events"))


@query(BRONZE_SQL)
def stream_bronze(spark, sf_dir):
    """Kafka-shaped rows replayed to JSON by topic and day."""
    work = scratch(spark, "stream-bronze")
    records = replayed(event_records(spark, sf_dir), f"{work}/in")
    rows = gather(to_bronze(records), BRONZE_KEYS)
    drain(to_files(rows, f"{work}/out", f"{work}/cp", "json", BRONZE_KEYS, AVAILABLE_NOW))
    return bronze_compared(read_bronze(spark, f"{work}/out"))


@query(BRONZE_SQL)
def stream_restart(spark, sf_dir):
    """A query started again on its checkpoint takes what has come since, and nothing twice."""
    work = scratch(spark, "stream-restart")
    records = event_records(spark, sf_dir)
    late = F.col("offset") % 3 == 0
    for news in (records.filter(~late), records.filter(late), None):
        if news is not None:
            append_files(news, f"{work}/in")
        rows = gather(to_bronze(replay(spark, records, f"{work}/in")), BRONZE_KEYS)
        drain(to_files(rows, f"{work}/out", f"{work}/cp", "json", BRONZE_KEYS, AVAILABLE_NOW))
    return bronze_compared(read_bronze(spark, f"{work}/out"))


@query(
    """
SELECT 3 AS batches, count(*) AS records, count(DISTINCT event_id) AS offsets,
       max(event_id) AS last_offset FROM events"""
)
def stream_rate_limit(spark, sf_dir):
    """A third of the files to a micro-batch: three batches that hold each record once."""
    work = scratch(spark, "stream-rate-limit")
    records = event_records(spark, sf_dir)
    append_files(records, f"{work}/in")
    rows = replay(spark, records, f"{work}/in", batches=3)
    run = to_files(rows, f"{work}/out", f"{work}/cp", trigger=AVAILABLE_NOW)
    drain(run)
    batches = sum(1 for progress in run.recentProgress if progress["numInputRows"])
    return spark.read.parquet(f"{work}/out").agg(
        F.lit(batches).alias("batches"),
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("offset").alias("offsets"),
        F.max("offset").alias("last_offset"),
    )


@query(SILVER_SQL)
def stream_silver(spark, sf_dir):
    """Bronze JSON streamed, decoded and typed, to Parquet by day."""
    work = scratch(spark, "stream-silver")
    write_bronze(spark, sf_dir, f"{work}/bronze")
    bronze = read_json_stream(
        spark, f"{work}/bronze", f"{BRONZE}, topic STRING", max_bytes=BATCH_BYTES
    )
    rows = gather(to_silver(bronze, topic=None), SILVER_KEYS)
    drain(
        to_files(rows, f"{work}/out", f"{work}/cp", partition_by=SILVER_KEYS, trigger=AVAILABLE_NOW)
    )
    return spark.read.parquet(f"{work}/out").withColumns(ntz("device_ts", "event_time"))


@query("SELECT event_id, ts, user_id, value, props, event_type FROM events")
def stream_parquet(spark, sf_dir):
    """A stream appended to Parquet by event type."""
    work = scratch(spark, "stream-parquet")
    rows = gather(replayed(table(spark, sf_dir, "events"), f"{work}/in"), ["event_type"])
    drain(
        to_files(
            rows, f"{work}/out", f"{work}/cp", partition_by=["event_type"], trigger=AVAILABLE_NOW
        )
    )
    return spark.read.parquet(f"{work}/out")


FANOUT_SQL = """
SELECT 'sensors.' || event_type AS topic, CAST(user_id AS VARCHAR) AS device_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
       'city_' || user_id AS city, value AS temperature, CAST(ts AS DATE) AS partition_date,
       CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
       CAST(day(ts) AS INTEGER) AS "day"
FROM events"""


@query(FANOUT_SQL)
def stream_fanout(spark, sf_dir):
    """A query for each topic that the stored rows have, with the schema its payloads show, its
    own directory to read, output and checkpoint."""
    work = scratch(spark, "stream-fanout")
    write_bronze(spark, sf_dir, f"{work}/bronze")
    outputs = [
        spark.read.parquet(f"{work}/out/{topic}")
        for topic in fan_out_stored(spark, f"{work}/bronze", f"{work}/out", f"{work}/cp")
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outputs).select(*reading())


def reading():
    """The columns that the checks of topics compare."""
    return [
        "topic", "device_id", "timestamp", F.col("location.city").alias("city"),
        F.col("temperature").cast("double").alias("temperature"),
        "partition_date", "year", "month", "day",
    ]


def fan_out_stored(spark, bronze, out, checkpoint):
    """Run a query per topic of stored Bronze to the end of its input; gives the topics."""
    stored = read_files(spark, bronze, "json", f"{BRONZE}, topic STRING")
    topics = [row.topic for row in list_topics(stored).collect()]
    schemas = infer_schemas(stored, topics)

    def source(topic):
        return read_topic_stream(spark, bronze, topic, max_bytes=BATCH_BYTES)

    drain(*fan_out(source, schemas, out, checkpoint, AVAILABLE_NOW).values())
    return list(schemas)


def multiplexed(records, parts, work, keep=()):
    """Kafka-shaped records through one multiplexing query, a batch for each part."""
    spark = records.sparkSession
    for part in parts:
        records.filter(part).write.mode("append").parquet(f"{work}/in")
        rows = to_bronze(spark.readStream.schema(records.schema).parquet(f"{work}/in"))
        drain(multiplex(rows, f"{work}/out", f"{work}/cp", AVAILABLE_NOW, keep))


@query(
    f"""
SELECT f.*, CAST(CASE WHEN topic = 'sensors.purchase' THEN 2 ELSE 0 END AS BIGINT) AS first_batch
FROM ({FANOUT_SQL}) f"""
)
def stream_topics(spark, sf_dir):
    """All topics by one query; one of them is first seen in the third batch."""
    work = scratch(spark, "stream-topics")
    late = F.col("topic") == "sensors.purchase"
    even = F.col("offset") % 2 == 0
    multiplexed(event_records(spark, sf_dir), (even & ~late, ~even & ~late, late), work)
    stored = stored_topics(spark, f"{work}/out")
    outputs = [
        read_topic(stored, topic, schema)
        for topic, (_, schema) in topic_types(spark, f"{work}/out").items()
    ]
    first = schema_log(spark, f"{work}/out").groupBy("topic").agg(F.min("batch_id").alias("first_batch"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outputs)
    return rows.select(*reading()).join(F.broadcast(first), "topic")


@query(
    """
SELECT topic, CASE WHEN topic = 'sensors.error' THEN 3 ELSE 2 END AS version,
       CASE WHEN topic = 'sensors.error' THEN 'string' ELSE 'double' END AS v_type, id,
       CASE WHEN part = 0 AND topic = 'sensors.error' THEN CAST(id AS VARCHAR)
            WHEN part = 0 THEN CAST(CAST(id AS DOUBLE) AS VARCHAR)
            WHEN part = 1 THEN CAST(id + 0.5 AS VARCHAR) ELSE 'no. ' || id END AS v,
       CASE WHEN part > 0 THEN user_id END AS extra_user,
       CASE WHEN part = 2 THEN 'late' END AS extra_note
FROM (SELECT 'sensors.' || event_type AS topic, event_id AS id, user_id,
             CASE WHEN event_id % 3 = 2 AND event_type <> 'error' THEN 1 ELSE event_id % 3 END AS part
      FROM events) e"""
)
def stream_widening(spark, sf_dir):
    """Payloads that gain fields and widen while the query runs: all rows under the last version."""
    work = scratch(spark, "stream-widening")
    part = F.when((F.col("event_id") % 3 == 2) & (F.col("event_type") != "error"), 1)
    part = part.otherwise(F.col("event_id") % 3)
    number = F.col("event_id")
    fields = [
        [number.alias("v")],
        [(number + 0.5).alias("v"), F.struct(F.col("user_id").alias("user")).alias("extra")],
        [
            F.concat(F.lit("no. "), number.cast("string")).alias("v"),
            F.struct(F.col("user_id").alias("user"), F.lit("late").alias("note")).alias("extra"),
        ],
    ]
    payload = F.coalesce(
        *[
            F.when(part == n, F.to_json(F.struct(number.alias("id"), *more)))
            for n, more in enumerate(fields)
        ]
    )
    records = kafka_rows(table(spark, sf_dir, "events"), payload)
    third, wide = F.col("offset") % 3, F.col("topic") == "sensors.error"
    multiplexed(records, (third == 0, (third == 1) | (third == 2) & ~wide, (third == 2) & wide), work)
    stored = stored_topics(spark, f"{work}/out")
    outputs = []
    for topic, (version, schema) in topic_types(spark, f"{work}/out").items():
        extra = schema["extra"].dataType.names
        outputs.append(
            read_topic(stored, topic, schema).select(
                "topic",
                F.lit(version).alias("version"),
                F.lit(schema["v"].dataType.simpleString()).alias("v_type"),
                "id",
                F.col("v").cast("string").alias("v"),
                F.col("extra.user").alias("extra_user"),
                (F.col("extra.note") if "note" in extra else F.lit(None)).cast("string").alias("extra_note"),
            )
        )
    return reduce(DataFrame.unionByName, outputs)


def untidy_lines(spark, sf_dir, path):
    """Events as lines of JSON, broken where the type is ``error``."""
    line = F.when(
        F.col("event_type") == "error",
        F.concat(F.lit('{"broken": '), F.col("event_id").cast("string")),
    ).otherwise(F.to_json(F.struct("event_id", "user_id", "value")))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)


LINES = "event_id BIGINT, user_id BIGINT, value DOUBLE"

QUARANTINE_SQL = """
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN value END AS value,
       CASE WHEN event_type <> 'error' THEN 'valid' ELSE 'invalid' END AS validation_status,
       CASE WHEN event_type = 'error' THEN '{"broken": ' || event_id END AS _corrupt_record
FROM events"""


@query(QUARANTINE_SQL)
def stream_quarantine(spark, sf_dir):
    """Lines that do not parse are kept with their text, in a directory of their own."""
    work = scratch(spark, "stream-quarantine")
    untidy_lines(spark, sf_dir, f"{work}/in")
    rows = read_json_stream(spark, f"{work}/in", LINES, glob="*.txt", keep_corrupt=True)
    drain(to_marked_files(rows, f"{work}/out", f"{work}/cp", trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{work}/out")


@query(QUARANTINE_SQL)
def stream_dead_letters(spark, sf_dir):
    """Good and bad lines to two sinks of their own."""
    work = scratch(spark, "stream-dead-letters")
    untidy_lines(spark, sf_dir, f"{work}/in")
    rows = read_json_stream(spark, f"{work}/in", LINES, glob="*.txt", keep_corrupt=True)
    drain(
        with_dead_letters(
            rows,
            batch_files(f"{work}/good"),
            batch_files(f"{work}/bad"),
            f"{work}/cp",
            trigger=AVAILABLE_NOW,
        )
    )
    good, bad = spark.read.parquet(f"{work}/good"), spark.read.parquet(f"{work}/bad")
    return mark_invalid(good.unionByName(bad, allowMissingColumns=True)).drop("batch_id")


@query(
    """
SELECT 'sensors.' || event_type AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
       event_id AS "offset", ts AS "timestamp"
FROM events"""
)
def stream_dedupe(spark, sf_dir):
    """Records that come twice on a stream, kept once.

    The days come in order, five to a directory, each with the last day of the one before once
    more. A key is forgotten two days after it, so the state holds a few days, not the table.
    """
    work = scratch(spark, "stream-dedupe")
    records = event_records(spark, sf_dir).drop("value")
    day = F.unix_date(F.to_date("timestamp"))
    fifth = F.floor(day / 5)
    again = F.when(day % 5 == 4, fifth + 1)
    parts = F.explode(F.array_compact(F.array(fifth, again))).alias("part")
    records.select("*", parts).write.partitionBy("part").parquet(f"{work}/in")
    written = spark.read.parquet(f"{work}/in")
    numbers = sorted(row.part for row in written.select("part").distinct().collect())
    keys = ["topic", "partition", "offset"]
    for number in numbers:  # one run of the query for each directory, in the days' order
        rows = read_parquet_stream(spark, f"{work}/in/part={number}", records.schema)
        once = dedupe_stream(rows, keys, delay="2 days")
        drain(to_files(once, f"{work}/out", f"{work}/cp", trigger=AVAILABLE_NOW))
    return spark.read.parquet(f"{work}/out").withColumns(ntz("timestamp"))


@query(MERGED_SQL)
def stream_merge(spark, sf_dir):
    """A stream of changes, newest first, merged batch by batch into a stored state."""
    work = scratch(spark, "stream-merge")
    names = ["event_type", "user_id", "ts", "event_id", "value"]
    state = first_state(table(spark, sf_dir, "events"))
    write_target(state, f"{work}/state", "overwrite", ["event_type"])
    changes = table(spark, sf_dir, "events").select(*names).filter("event_type <> 'error'")
    at = F.col("ts").cast("timestamp").cast("long")
    midnight = F.col("ts").cast("date").cast("timestamp").cast("long")
    low, high = changes.agg(*[F.percentile_approx(midnight, p) for p in (0.4, 0.7)]).first()
    for part in (at >= high, (at >= low) & (at < high), at < low):
        changes.filter(part).write.mode("append").parquet(f"{work}/in")
        rows = read_parquet_stream(spark, f"{work}/in", changes.schema)
        drain(
            merge_stream(
                rows,
                f"{work}/state",
                ["event_type", "user_id"],
                ["ts", "event_id"],
                ["event_type"],
                f"{work}/cp",
                AVAILABLE_NOW,
            )
        )
    return spark.read.parquet(f"{work}/state")


@query(
    """
SELECT 'copy' AS job_name, 'Success' AS status, kind, count(*) AS records, FALSE AS has_error
FROM events, (VALUES ('batch'), ('end')) k(kind) GROUP BY kind
UNION ALL
SELECT 'broken', 'Success', 'batch', count(*), FALSE FROM events
WHERE event_type <> 'error' HAVING count(*) > 0
UNION ALL SELECT 'broken', 'Success', 'end', count(*), FALSE FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'broken', 'Failed', 'end', 0, TRUE"""
)
def stream_audit(spark, sf_dir):
    """The records of a run of several batches, and of a query whose second run fails on its rows."""
    work = scratch(spark, "stream-audit")
    audit = StreamAudit(spark, f"{work}/runs")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    spark.streams.addListener(audit)
    try:
        rows = replayed(events, f"{work}/in")
        run = to_files(rows, f"{work}/out", f"{work}/cp", trigger=AVAILABLE_NOW, name="copy")
        drain(run)
        runs = [run]
        failing = F.when(F.col("event_type") == "error", F.raise_error(F.lit("bad row")))
        for part in (F.col("event_type") != "error", F.col("event_type") == "error"):
            events.filter(part).write.mode("append").parquet(f"{work}/more")
            rows = spark.readStream.schema(events.schema).parquet(f"{work}/more")
            rows = rows.withColumn("checked", failing.cast("string"))
            places = (f"{work}/bad", f"{work}/cp-bad")
            runs.append(to_files(rows, *places, trigger=AVAILABLE_NOW, name="broken"))
            try:
                drain(runs[-1])
            except StreamingQueryException:
                pass
        audit.wait(*runs)
    finally:
        spark.streams.removeListener(audit)
    kind = F.when(F.col("batch_id") == END, "end").otherwise("batch")
    return (
        read_records(spark, f"{work}/runs")
        .groupBy("job_name", "status", kind.alias("kind"), F.col("error_message").isNotNull().alias("has_error"))
        .agg(F.sum("records_processed").alias("records"))
    )


@query(
    """
WITH parts AS (
  SELECT *, event_id % 3 AS part,
         (event_id % 3 = 0 AND event_type = 'error') OR event_id % 25 = 0 AS bad FROM events),
rates AS (SELECT part, count(*) AS n, count(*) FILTER (bad) AS errors FROM parts GROUP BY part)
SELECT event_id, event_type, value, n AS batch_records, errors AS batch_errors,
       CASE WHEN errors / n <= 0.05 THEN 'admitted' ELSE 'quarantined' END AS decision
FROM parts JOIN rates USING (part)"""
)
def stream_gate(spark, sf_dir):
    """Three batches, admitted or refused by their error rate, with the ledger's figures."""
    work = scratch(spark, "stream-gate")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    bad = (F.col("event_id") % 3 == 0) & (F.col("event_type") == "error")
    bad |= F.col("event_id") % 25 == 0
    for number in range(3):
        events.filter(F.col("event_id") % 3 == number).write.mode("append").parquet(f"{work}/in")
        rows = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        places = [f"{work}/{name}" for name in ("admitted", "quarantined", "ledger", "cp")]
        drain(gate_stream(rows, bad, *places, trigger=AVAILABLE_NOW))
    ledger = read_ledger(spark, f"{work}/ledger").select(
        "batch_id",
        F.col("total_records").alias("batch_records"),
        F.col("records_in_error").alias("batch_errors"),
    )
    # Where no batch was refused, or all were, there is no directory of that name.
    kept = spark.read.schema("event_id BIGINT, event_type STRING, value DOUBLE, batch_id BIGINT")
    parts = [
        kept.option("basePath", f"{work}/{name}").parquet(f"{work}/{name}/*").withColumn("decision", F.lit(name))
        for name in ("admitted", "quarantined")
        if any_files(spark, f"{work}/{name}")
    ]
    return reduce(DataFrame.unionByName, parts).join(ledger, "batch_id").drop("batch_id")


@query(
    """
WITH parts AS (
  SELECT *, CASE WHEN event_id % 7 = 0 THEN 1 WHEN day(ts) > 20 THEN 0
                 WHEN day(ts) >= 8 THEN 1 ELSE 2 END AS part FROM events),
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type, user_id, part
                                 ORDER BY ts DESC, event_id DESC) AS rn FROM parts) p
  WHERE rn = 1),
seen AS (
  SELECT *, max((ts, event_id)) OVER (PARTITION BY event_type, user_id ORDER BY part
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM newest)
SELECT CASE WHEN before IS NULL THEN 'insert' WHEN (ts, event_id) >= before THEN 'update'
            ELSE 'late' END AS change, event_type, user_id, ts, event_id, value
FROM seen"""
)
def stream_changes(spark, sf_dir):
    """A stream's changes of the newest row per key, over three batches, the newest days first; the
    state lies in RocksDB from run to run."""
    work = scratch(spark, "stream-changes")
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "ts", "event_id", "value")
    day = F.day("ts")
    part = F.when(F.col("event_id") % 7 == 0, 1).when(day > 20, 0).when(day >= 8, 1).otherwise(2)
    for number in range(3):
        events.filter(part == number).write.mode("append").parquet(f"{work}/in")
        rows = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        feed = change_feed(rows, ["event_type", "user_id"], ["ts", "event_id"])
        with rocksdb_state(spark):
            run = to_files(feed, f"{work}/out", f"{work}/cp", trigger=AVAILABLE_NOW)
        drain(run)
    return spark.read.parquet(f"{work}/out")


@query(
    """
SELECT 'sensors.' || event_type AS topic, event_id AS "offset",
       CASE WHEN event_type IN ('error', 'view') THEN 'invalid' ELSE 'valid' END
         AS validation_status,
       CASE WHEN event_type NOT IN ('error', 'view') THEN ts END AS event_time
FROM events"""
)
def stream_untimed(spark, sf_dir):
    """Records whose payload has no readable time are kept apart from the others."""
    work = scratch(spark, "stream-untimed")
    events = replayed(table(spark, sf_dir, "events"), f"{work}/in")
    rows = bad_time_rows(events)
    untimed = F.col("event_time").isNull()
    drain(to_marked_files(rows, f"{work}/out", f"{work}/cp", untimed, trigger=AVAILABLE_NOW))
    kept = spark.read.parquet(f"{work}/out").withColumns(ntz("event_time"))
    return kept.select("topic", "offset", "validation_status", "event_time")
