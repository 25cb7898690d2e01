"""Quality checks and gates."""

from pyspark.sql import functions as F

from tristrata.functions.text import EMAIL_PATTERN, normalise_email
from tristrata.operators import quality as q
from tristrata.plans.queries.silver import contacts
from tristrata.plans.registry import query
from tristrata.plans.tables import table
from tristrata.scratch import scratch
from tristrata.sinks.profiles import (
    DISTINCT_ERROR,
    OVERLAP_ERROR,
    RANK_ERROR,
    add_profiles,
    compact_profiles,
    key_overlap,
    profile_of,
    read_profiles,
)


def holey_events(spark, sf_dir):
    """Events without a value where the type is ``error``."""
    return table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )


HOLEY_SQL = """(SELECT event_id, ts, user_id, event_type, props,
                       CASE WHEN event_type <> 'error' THEN value END AS value FROM events) e"""


@query(
    f"""
SELECT count(*) AS total_records, count(*) - count(value) AS records_with_nulls
FROM {HOLEY_SQL}"""
)
def dq_basic(spark, sf_dir):
    return q.basic_report(holey_events(spark, sf_dir))


@query(
    """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
                  CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS o_totalprice
           FROM orders),
     c AS (SELECT 'o_orderkey' AS column_name, count(*) AS total_rows,
                  count(o_orderkey) AS non_null_rows FROM o
           UNION ALL SELECT 'o_custkey', count(*), count(o_custkey) FROM o
           UNION ALL SELECT 'o_totalprice', count(*), count(o_totalprice) FROM o),
     a AS (SELECT * FROM c
           UNION ALL
           SELECT '*', CAST(sum(total_rows) AS BIGINT), CAST(sum(non_null_rows) AS BIGINT) FROM c)
SELECT column_name, total_rows, non_null_rows,
       round(non_null_rows / CAST(total_rows AS DOUBLE), 9) AS completeness,
       non_null_rows / CAST(total_rows AS DOUBLE) >= 0.95 AS passed
FROM a"""
)
def dq_completeness(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("o_totalprice"),
    )
    report = q.completeness(orders, 0.95)
    return report.withColumn("completeness", F.round("completeness", 9))


@query(
    """
SELECT column_name, total_rows, distinct_values,
       round(distinct_values / CAST(total_rows AS DOUBLE), 9) AS uniqueness,
       distinct_values / CAST(total_rows AS DOUBLE) >= 0.95 AS passed
FROM (SELECT 'o_orderkey' AS column_name, count(*) AS total_rows,
             count(DISTINCT o_orderkey) AS distinct_values FROM orders
      UNION ALL SELECT 'o_custkey', count(*), count(DISTINCT o_custkey) FROM orders
      UNION ALL SELECT 'o_custkey,o_orderdate', count(*),
                       count(DISTINCT (o_custkey, o_orderdate)) FROM orders) u"""
)
def dq_uniqueness(spark, sf_dir):
    keys = ["o_orderkey", "o_custkey", ("o_custkey", "o_orderdate")]
    report = q.uniqueness(table(spark, sf_dir, "orders"), keys)
    return report.withColumn("uniqueness", F.round("uniqueness", 9))


@query(
    f"""
SELECT 'email' AS rule, count(*) AS total_rows,
       count(*) FILTER (regexp_matches(email, '{EMAIL_PATTERN}')) AS passed_rows,
       count(*) FILTER (NOT regexp_matches(email, '{EMAIL_PATTERN}')) AS failed_rows,
       count(*) FILTER (email IS NULL) AS null_rows
FROM (SELECT CASE WHEN c_nationkey <> 7 THEN
               lower(trim('  ' || CASE WHEN c_mktsegment = 'BUILDING' THEN c_name
                                       ELSE translate(c_name, '#', '.') END || '@Example.COM '))
             END AS email
      FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer) u) c"""
)
def dq_format(spark, sf_dir):
    """E-mails that match, that do not, and that are missing."""
    rows = contacts(table(spark, sf_dir, "customer"), "c_nationkey")
    email = F.when(F.col("c_nationkey") != 7, normalise_email("email"))
    return q.format_check(rows.select(email.alias("email")), {"email": EMAIL_PATTERN})


@query(
    """
SELECT 'l_discount' AS rule, count(*) AS total_rows,
       count(*) FILTER (l_discount BETWEEN 0.02 AND 0.05) AS passed_rows,
       count(*) FILTER (NOT l_discount BETWEEN 0.02 AND 0.05) AS failed_rows,
       count(*) FILTER (l_discount IS NULL) AS null_rows FROM lineitem
UNION ALL
SELECT 'l_quantity', count(*), count(*) FILTER (l_quantity >= 10),
       count(*) FILTER (l_quantity < 10), count(*) FILTER (l_quantity IS NULL) FROM lineitem"""
)
def dq_range(spark, sf_dir):
    ranges = {"l_discount": (0.02, 0.05), "l_quantity": (10, None)}
    return q.range_check(table(spark, sf_dir, "lineitem"), ranges)


@query(
    """
SELECT 'big_line' AS rule, count(*) AS total_rows,
       count(*) FILTER (l_extendedprice > 100 * l_quantity) AS passed_rows,
       count(*) FILTER (NOT l_extendedprice > 100 * l_quantity) AS failed_rows,
       count(*) FILTER (l_extendedprice > 100 * l_quantity IS NULL) AS null_rows FROM lineitem
UNION ALL
SELECT 'not_returned', count(*), count(*) FILTER (l_returnflag <> 'R'),
       count(*) FILTER (l_returnflag = 'R'), count(*) FILTER (l_returnflag IS NULL)
FROM lineitem"""
)
def dq_custom(spark, sf_dir):
    rules = {
        "big_line": F.expr("l_extendedprice > 100 * l_quantity"),
        "not_returned": F.col("l_returnflag") != "R",
    }
    return q.custom_check(table(spark, sf_dir, "lineitem"), rules)


@query(
    f"""
WITH m AS (
  SELECT CAST(count(*) AS DOUBLE) AS n,
         count(*) FILTER (value IS NULL OR value > 400) AS bad,
         5 * count(*) + count(value) AS filled, count(DISTINCT event_id) AS ids
  FROM {HOLEY_SQL})
SELECT 'error_rate' AS metric, round(bad / n, 9) AS value, CAST(0.05 AS DOUBLE) AS threshold,
       bad / n <= 0.05 AS passed FROM m
UNION ALL SELECT 'completeness', round(filled / (6 * n), 9), 0.95, filled / (6 * n) >= 0.95 FROM m
UNION ALL SELECT 'uniqueness', round(ids / n, 9), 0.95, ids / n >= 0.95 FROM m"""
)
def dq_error_gate(spark, sf_dir):
    report = q.apply_policy(
        holey_events(spark, sf_dir),
        q.QualityPolicy(uniqueness_check=True),
        ranges={"value": (None, 400.0)},
        unique=["event_id"],
    )
    return report.withColumn("value", F.round("value", 9))


@query(
    f"""
SELECT event_id,
       round(((CASE WHEN value IS NULL THEN 0 ELSE 1 END)
            + (CASE WHEN value <= 250 THEN 1 ELSE 0 END)
            + (CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END)) / CAST(3 AS DOUBLE), 9)
         AS data_quality_score,
       CASE WHEN value <= 250 AND event_type <> 'view' THEN 'valid' ELSE 'invalid' END
         AS validation_status,
       nullif(concat_ws('; ', CASE WHEN value IS NULL THEN 'value_present' END,
                              CASE WHEN value IS NULL OR value > 250 THEN 'value_in_range' END,
                              CASE WHEN event_type = 'view' THEN 'type_allowed' END), '')
         AS error_message
FROM {HOLEY_SQL}"""
)
def dq_annotate(spark, sf_dir):
    rules = {
        "value_present": F.col("value").isNotNull(),
        "value_in_range": F.col("value") <= 250,
        "type_allowed": F.col("event_type") != "view",
    }
    rows = q.annotate(holey_events(spark, sf_dir), rules)
    return rows.select(
        "event_id",
        F.round("data_quality_score", 9).alias("data_quality_score"),
        "validation_status",
        "error_message",
    )


@query(
    """
SELECT column_name, expected_type, actual_type, passed, non_null_rows FROM (
  SELECT 'event_id' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type,
         true AS passed, count(event_id) AS non_null_rows FROM events
  UNION ALL SELECT 'ts', 'timestamp_ntz', 'timestamp_ntz', true, count(ts) FROM events
  UNION ALL SELECT 'user_id', 'int', 'bigint', false, count(user_id) FROM events
  UNION ALL SELECT 'city', 'string', NULL, false, NULL
  UNION ALL SELECT 'event_type', NULL, 'string', false, count(event_type) FROM events
  UNION ALL SELECT 'value', NULL, 'double', false, count(value) FROM events
  UNION ALL SELECT 'props', NULL, 'string', false, count(props) FROM events) e"""
)
def dq_schema_check(spark, sf_dir):
    """Expected against actual columns, with how many values each has."""
    events = table(spark, sf_dir, "events")
    wanted = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id INT, city STRING"
    filled = q.completeness(events).select("column_name", "non_null_rows")
    return q.schema_check(events, wanted).join(filled, "column_name", "left")


@query(
    """
SELECT total_rows, compliant_rows,
       round(compliant_rows / CAST(total_rows AS DOUBLE), 9) AS schema_compliance,
       compliant_rows / CAST(total_rows AS DOUBLE) >= 0.95 AS passed
FROM (SELECT count(*) AS total_rows,
             count(*) FILTER (event_type NOT IN ('error', 'view')) AS compliant_rows
      FROM events) e"""
)
def dq_schema(spark, sf_dir):
    """Payloads that are no JSON, or hold text where a number belongs, do not comply."""
    payload = (
        F.when(F.col("event_type") == "error", "no json")
        .when(F.col("event_type") == "view", '{"k": "many"}')
        .otherwise(F.col("props"))
    )
    rows = table(spark, sf_dir, "events").select(payload.alias("value"))
    report = q.schema_compliance(rows, "k BIGINT")
    return report.withColumn("schema_compliance", F.round("schema_compliance", 9))


@query(
    """
SELECT user_id, event_type, count(*) AS copies FROM events
GROUP BY user_id, event_type HAVING count(*) > 1"""
)
def dq_duplicates(spark, sf_dir):
    return q.duplicates(table(spark, sf_dir, "events"), ["user_id", "event_type"])


def _profile_sql(table_name: str, columns: list[tuple[str, str, bool]]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS total_rows,
       count(*) - count({name}) AS null_rows, count(DISTINCT {name}) AS distinct_values,
       CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value,
       {f'round(avg({name}), 6)' if number else 'CAST(NULL AS DOUBLE)'} AS avg_value
FROM {table_name}"""
        for name, kind, number in columns
    )


@query(
    _profile_sql(
        "customer",
        [
            ("c_custkey", "bigint", True),
            ("c_name", "string", False),
            ("c_nationkey", "int", True),
            ("c_acctbal", "double", True),
            ("c_mktsegment", "string", False),
        ],
    )
)
def dq_profile(spark, sf_dir):
    report = q.profile(table(spark, sf_dir, "customer"), exact=True)
    return report.withColumn("avg_value", F.round("avg_value", 6))


def profiled_events(spark, sf_dir):
    """Events with holes in two columns and their day, as three increments would bring them."""
    error = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(~error, F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(F.col("event_type") != "view", F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        F.to_date("ts").alias("day"),
    )


def stored_profiles(spark, sf_dir, name):
    """The events' states by day, from increments whose rows fall into the same days."""
    path = scratch(spark, name)
    events = profiled_events(spark, sf_dir)
    for number in range(3):
        part = events.filter(F.col("event_id") % 3 == number)
        add_profiles(path, part, f"part-{number}", ["day"], keys=["user_id", "event_id"])
    add_profiles(path, events, "part-2", ["day"])  # a name counts once
    compact_profiles(spark, path, f"{path}-by-day", ["day"])
    return read_profiles(spark, f"{path}-by-day")


PROFILED_SQL = """(SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type,
       CASE WHEN event_type <> 'view' THEN CAST(round(value * 100) AS BIGINT) END AS cents
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-24') e"""


@query(
    "SELECT * EXCLUDE (distinct_values), TRUE AS distinct_within, TRUE AS quantiles_within FROM ("
    + _profile_sql(
        PROFILED_SQL,
        [
            ("event_id", "bigint", True),
            ("user_id", "bigint", True),
            ("event_type", "string", False),
            ("cents", "bigint", True),
        ],
    )
    + ") p"
)
def profile_range(spark, sf_dir):
    """Twenty days profiled from the stored states of days; the sketched parts are held against
    the exact ones of the rows, which the profile itself does not read."""
    days = F.col("day").between("2024-01-05", "2024-01-24")
    cuts = (0.25, 0.5, 0.75)
    report = profile_of(stored_profiles(spark, sf_dir, "profile-range").filter(days), cuts)
    rows = profiled_events(spark, sf_dir).filter(days).drop("day")
    sketched = {r.column_name: r for r in report.collect()}  # a line for each column
    checks = []
    for name in rows.columns:
        got, value = sketched[name], F.col(name)
        distinct, filled = F.count_distinct(value), F.count(value)
        near = F.abs(F.lit(got.distinct_values) - distinct) <= DISTINCT_ERROR * distinct
        ranks = [
            (F.count_if(value < cut) <= (q + RANK_ERROR) * filled)
            & (F.count_if(value <= cut) >= (q - RANK_ERROR) * filled)
            for q, cut in zip(cuts, got.quantiles or [])
        ]
        within = F.lit(True)
        for rank in ranks:
            within &= rank
        held = rows.agg(near.alias("distinct_within"), within.alias("quantiles_within"))
        checks.append(held.withColumn("column_name", F.lit(name)))
    exact = checks[0]
    for check in checks[1:]:
        exact = exact.unionByName(check)
    report = report.drop("distinct_values", "quantiles").withColumn("avg_value", F.round("avg_value", 6))
    return report.join(exact, "column_name")


@query(
    """
SELECT key, TRUE AS left_within, TRUE AS right_within, TRUE AS shared_within
FROM (VALUES ('user_id'), ('event_id')) k(key)"""
)
def profile_overlap(spark, sf_dir):
    """Keys that two ranges of days share, from the states' theta sketches, held against a join."""
    states = stored_profiles(spark, sf_dir, "profile-overlap")
    early, late = F.col("day") <= "2024-01-20", F.col("day") >= "2024-01-10"
    events = profiled_events(spark, sf_dir)
    out = []
    for key in ("user_id", "event_id"):
        got = key_overlap(states.filter(early), states.filter(late), key)
        sides = events.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.max(early).alias("a"), F.max(late).alias("b")
        )
        exact = sides.agg(
            F.count_if("a").alias("a"),
            F.count_if("b").alias("b"),
            F.count_if(F.col("a") & F.col("b")).alias("ab"),
            F.count(F.lit(1)).alias("any"),
        )
        # Both sides are one row: the rows are put together without a join.
        pair = got.unionByName(exact, allowMissingColumns=True)
        both = pair.agg(F.lit(key).alias("key"), *[F.max(c).alias(c) for c in pair.columns])

        def near(estimate, truth):
            return F.abs(F.col(estimate) - F.col(truth)) <= OVERLAP_ERROR * F.col("any")

        out.append(
            both.select(
                "key",
                near("left_keys", "a").alias("left_within"),
                near("right_keys", "b").alias("right_within"),
                near("shared_keys", "ab").alias("shared_within"),
            )
        )
    return out[0].unionByName(out[1])
