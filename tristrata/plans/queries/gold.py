"""Period rollups."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tristrata.operators.gold import period_rollup
from tristrata.plans.registry import query
from tristrata.plans.tables import table
from tristrata.scratch import scratch
from tristrata.sinks.files import write_rollup
from tristrata.sinks.rollups import apply_increment, read_rollup


def cents(amount: str) -> Column:
    """Money as whole cents: sums are exact, whatever the order in which rows arrive."""
    return F.round(F.col(amount) * 100).cast("bigint")


def of_events(spark, sf_dir, kind):
    events = table(spark, sf_dir, "events").select("ts", "user_id", cents("value").alias("value"))
    return period_rollup(events, kind, "ts", "value", "user_id")


def of_orders(spark, sf_dir, kind):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderdate", "o_custkey", cents("o_totalprice").alias("o_totalprice")
    )
    return period_rollup(orders, kind, "o_orderdate", "o_totalprice", "o_custkey")


def rollup_sql(source: str, unit: str, label: str, ts: str, amount: str, customer: str) -> str:
    return f"""
SELECT CAST(date_trunc('{unit}', {ts}) AS TIMESTAMP) AS period,
       count(*) AS total_records,
       CAST(sum(CAST(round({amount} * 100) AS BIGINT)) AS BIGINT) AS total_amount,
       avg(CAST(round({amount} * 100) AS BIGINT)) AS avg_amount,
       max(CAST(round({amount} * 100) AS BIGINT)) AS max_amount,
       min(CAST(round({amount} * 100) AS BIGINT)) AS min_amount,
       count(DISTINCT {customer}) AS unique_customers,
       '{label}' AS aggregation_type
FROM {source} GROUP BY 1"""


EVENT_COLUMNS = ("ts", "value", "user_id")
ORDER_COLUMNS = ("o_orderdate", "o_totalprice", "o_custkey")


@query(rollup_sql("events", "hour", "hourly", *EVENT_COLUMNS))
def gold_rollup_hourly(spark, sf_dir):
    return of_events(spark, sf_dir, "hourly").drop("generated_at")


@query(rollup_sql("events", "day", "daily", *EVENT_COLUMNS))
def gold_rollup_daily(spark, sf_dir):
    return of_events(spark, sf_dir, "daily").drop("generated_at")


@query(rollup_sql("orders", "month", "monthly", *ORDER_COLUMNS))
def gold_rollup_monthly(spark, sf_dir):
    return of_orders(spark, sf_dir, "monthly").drop("generated_at")


@query(rollup_sql("orders", "day", "weekly", *ORDER_COLUMNS))
def gold_rollup_other_label(spark, sf_dir):
    return of_orders(spark, sf_dir, "weekly").drop("generated_at")


@query(
    rollup_sql(
        """(SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS created_at,
                   CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS amount,
                   CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS customer_id
            FROM orders) o""",
        "month",
        "monthly",
        "created_at",
        "amount",
        "customer_id",
    )
)
def gold_rollup_nulls(spark, sf_dir):
    """Rows without a time form one group; null amounts and customers are not counted."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("created_at"),
        F.when(F.col("o_orderpriority") != "5-LOW", cents("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("customer_id"),
    )
    return period_rollup(orders, "monthly").drop("generated_at")


@query(rollup_sql("events", "day", "daily", *EVENT_COLUMNS))
def gold_layout(spark, sf_dir):
    """The rollup written under its label twice, and read back with the label as a column."""
    out = scratch(spark, "gold")
    write_rollup(of_events(spark, sf_dir, "daily"), out, "daily")
    return spark.read.parquet(f"{out}/daily").drop("generated_at")


def in_increments(spark, rows, parts, kind, columns):
    """The rollup of rows that come part by part; the last part comes twice."""
    path = scratch(spark, "rollup")
    for number, part in enumerate([*parts, parts[-1]]):
        apply_increment(path, rows.filter(part), f"part-{min(number, len(parts) - 1)}", kind, *columns)
    return read_rollup(spark, path, kind).drop("generated_at")


@query(rollup_sql("events", "day", "daily", *EVENT_COLUMNS))
def gold_incremental_daily(spark, sf_dir):
    """Three increments, the third with late rows of the first one's days."""
    events = table(spark, sf_dir, "events").select(
        "ts", "user_id", "event_id", cents("value").alias("value")
    )
    late = F.col("event_id") % 10 == 0
    parts = [(F.day("ts") <= 10) & ~late, F.day("ts") > 10, (F.day("ts") <= 10) & late]
    return in_increments(spark, events, parts, "daily", EVENT_COLUMNS)


@query(rollup_sql("events", "hour", "hourly", *EVENT_COLUMNS))
def gold_incremental_hourly(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "user_id", cents("value").alias("value"))
    return in_increments(spark, events, [F.hour("ts") % 3 == k for k in range(3)], "hourly", EVENT_COLUMNS)


@query(
    rollup_sql(
        """(SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS created_at,
                   CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS amount,
                   CASE WHEN o_orderstatus <> 'F' THEN 'c' || o_custkey END AS customer_id
            FROM orders) o""",
        "month",
        "monthly",
        "created_at",
        "amount",
        "customer_id",
    )
)
def gold_incremental_nulls(spark, sf_dir):
    """Nulls in every column, and customers that are no numbers."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("created_at"),
        F.when(F.col("o_orderpriority") != "5-LOW", cents("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("c"), "o_custkey")).alias("customer_id"),
    )
    parts = [F.col("o_orderkey") % 3 == k for k in range(3)]
    return in_increments(spark, orders, parts, "monthly", ("created_at", "amount", "customer_id"))
