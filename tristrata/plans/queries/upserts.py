"""Keyed merge and insert-if-absent."""

import uuid

from pyspark.sql import functions as F

from tristrata.operators.merge import insert_if_absent as absent
from tristrata.operators.merge import newest_per_key, upsert
from tristrata.plans.registry import ORACLES, query
from tristrata.plans.tables import table
from tristrata.scratch import scratch
from tristrata.sinks import bucketed
from tristrata.sinks.merge import write_target


@query(
    """
WITH newest AS (
  SELECT order_key, changed_at, line, amount FROM (
    SELECT l_orderkey AS order_key, l_shipdate AS changed_at, l_linenumber AS line,
           l_extendedprice AS amount,
           row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
    FROM lineitem) l WHERE rn = 1)
SELECT order_key, changed_at, line, amount FROM newest
UNION ALL
SELECT o_orderkey, o_orderdate, CAST(0 AS INTEGER), o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.order_key = o.o_orderkey)"""
)
def upsert_merge(spark, sf_dir):
    """Each order's row replaced by that of its line shipped last."""
    target, changes = orders_and_lines(spark, sf_dir)
    newest = newest_per_key(changes, ["order_key"], ["changed_at", "line"])
    return upsert(target, newest, ["order_key"], [])


def orders_and_lines(spark, sf_dir):
    target = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").alias("changed_at"),
        F.lit(0).alias("line"),
        F.col("o_totalprice").alias("amount"),
    )
    changes = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").alias("changed_at"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("amount"),
    )
    return target, changes


@query(
    """
SELECT order_key, changed_at, line, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY order_key
                               ORDER BY changed_at DESC, line DESC, amount DESC) AS rn
  FROM (SELECT l_orderkey AS order_key, l_shipdate AS changed_at, l_linenumber AS line,
               l_extendedprice AS amount FROM lineitem
        UNION ALL SELECT o_orderkey, o_orderdate, CAST(0 AS INTEGER), o_totalprice FROM orders) u
) r WHERE rn = 1"""
)
def upsert_newer(spark, sf_dir):
    """Each order's row, or that of its line shipped last where this is newer."""
    target, changes = orders_and_lines(spark, sf_dir)
    return upsert(target, changes, ["order_key"], ["changed_at", "line"])


@query(
    """
SELECT DISTINCT l_partkey AS part_key, l_suppkey AS supplier_key FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
                  AND r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey)"""
)
def insert_if_absent(spark, sf_dir):
    """Parts by supplier: all that were sold, against a list of those that came back."""
    sold = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        "l_returnflag",
    )
    returned = sold.filter("l_returnflag = 'R'").drop("l_returnflag")
    return absent(returned, sold.drop("l_returnflag"), ["part_key", "supplier_key"])


UPSERT_NEWER_SQL = ORACLES["upsert_newer"]


def own_table(name):
    """A table name of this run's own."""
    return f"{name}_{uuid.uuid4().hex}"


@query(UPSERT_NEWER_SQL)
def upsert_bucketed(spark, sf_dir):
    """Orders bucketed by key, their lines merged in two parts; the orders are not shuffled."""
    name, keys = own_table("orders_by_key"), ["order_key"]
    target, changes = orders_and_lines(spark, sf_dir)
    bucketed.write_bucketed(target, name, keys, 16)
    for part in (F.col("line") % 2 == 0, F.col("line") % 2 == 1):
        bucketed.upsert_bucketed(spark, name, changes.filter(part), keys, ["changed_at", "line", "amount"])
    return spark.table(name)


@query(UPSERT_NEWER_SQL)
def upsert_bucketed_changes(spark, sf_dir):
    """The same where the changes are bucketed too, in another number of buckets."""
    name, news, keys = own_table("orders_by_key"), own_table("lines_by_key"), ["order_key"]
    target, changes = orders_and_lines(spark, sf_dir)
    bucketed.write_bucketed(target, name, keys, 8)
    bucketed.write_bucketed(changes, news, keys, 24)
    order = ["changed_at", "line", "amount"]
    bucketed.upsert_bucketed(spark, name, spark.table(news), keys, order)
    return spark.table(name)


@query(
    """
SELECT DISTINCT l_partkey AS part_key, l_suppkey AS supplier_key FROM lineitem"""
)
def insert_absent_bucketed(spark, sf_dir):
    """Pairs of part and supplier, first those that came back, then twice all that were sold."""
    name, keys = own_table("sold"), ["part_key", "supplier_key"]
    lines = table(spark, sf_dir, "lineitem")
    sold = lines.select(F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supplier_key"), "l_returnflag")
    returned = sold.filter("l_returnflag = 'R'").drop("l_returnflag").distinct()
    bucketed.write_bucketed(returned, name, keys, 16)
    for _ in range(2):
        bucketed.insert_absent_bucketed(spark, name, sold.drop("l_returnflag"), keys)
    return spark.table(name)


MERGED_SQL = """
SELECT event_type, user_id, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC)
              AS rn FROM events) e
WHERE rn = 1 AND event_type <> 'error'
UNION ALL
SELECT event_type, user_id, min(ts), CAST(0 AS BIGINT), min(value) FROM events
WHERE event_type = 'error' GROUP BY event_type, user_id"""


def first_state(events):
    return events.groupBy("event_type", "user_id").agg(
        F.min("ts").alias("ts"), F.lit(0).cast("bigint").alias("event_id"),
        F.min("value").alias("value"),
    )


@query(MERGED_SQL)
def merge_partitions(spark, sf_dir):
    """Every event merged into a stored state by type and user; one directory has no changes."""
    path = scratch(spark, "state")
    names = ["event_type", "user_id", "ts", "event_id", "value"]
    events = table(spark, sf_dir, "events").select(*names)
    write_target(first_state(events), path, "overwrite", ["event_type"])
    write_target(
        events.filter("event_type <> 'error'"),
        path,
        "merge",
        ["event_type"],
        ["event_type", "user_id"],
        ["ts", "event_id"],
    )
    return spark.read.parquet(path)


@query(
    """
SELECT event_type, user_id, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC)
              AS rn FROM events) e
WHERE rn = 1"""
)
def merge_late_changes(spark, sf_dir):
    """A first merge makes the table; older changes that come later undo nothing."""
    path = scratch(spark, "late")
    names = ["event_type", "user_id", "ts", "event_id", "value"]
    events = table(spark, sf_dir, "events").select(*names)
    for part in ("day(ts) > 20", "day(ts) BETWEEN 8 AND 20", "day(ts) < 8"):
        write_target(
            events.filter(part),
            path,
            "merge",
            ["event_type"],
            ["event_type", "user_id"],
            ["ts", "event_id"],
        )
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def write_modes(spark, sf_dir):
    """Open orders written, written again in their place, and the others appended."""
    path = scratch(spark, "modes")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    for _ in range(2):
        write_target(orders.filter("o_orderstatus = 'O'"), path, "overwrite", ["o_orderstatus"])
    write_target(orders.filter("o_orderstatus <> 'O'"), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path)
