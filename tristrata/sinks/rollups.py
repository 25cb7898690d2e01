"""Rollups kept up by increments: a stored table of states that merge.

A period's state is one row of totals, and its customers: whole numbers as bitmaps of 32,768 ids
each, other values as one row each. Bitmaps merge by "or", so distinct counts stay exact however the
rows are cut. An increment is rolled up by itself and merged with the stored states of the days that
it falls into; other days, and the detail rows of earlier increments, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tristrata.operators.gold import UNITS, period_of
from tristrata.sinks.files import gather
from tristrata.sinks.merge import discard, finished, stored_rows

DAY = "period_day"
PART = ["period", "bucket", "customer"]


def increment_states(
    df: DataFrame,
    kind: str = "daily",
    ts: str = "created_at",
    amount: str = "amount",
    customer: str = "customer_id",
) -> DataFrame:
    """The states of an increment's periods: rows of totals, and rows of customers.

    Both are combined in each task before the shuffle. A row without a time belongs to the null
    period; null amounts and customers are not counted.
    """
    rows = df.select(
        period_of(df, ts, UNITS.get(kind, "day")).alias("period"),
        F.col(amount).alias("amount"),
        F.col(customer).alias("customer"),
    )
    totals = rows.groupBy("period").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("amount").alias("amounts"),
        F.sum("amount").alias("total_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
    )
    who = rows.where(F.col("customer").isNotNull())
    if isinstance(rows.schema["customer"].dataType, IntegralType):
        who = who.groupBy("period", F.bitmap_bucket_number("customer").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("customer")).alias("bits")
        )
    else:
        who = who.select("period", "customer").distinct()
    return totals.unionByName(who, allowMissingColumns=True).select(*_columns(totals, who))


def _columns(totals: DataFrame, who: DataFrame) -> list:
    """All columns of a state, in order; those that neither side has are null."""
    known = {f.name: f.dataType.simpleString() for f in totals.schema.fields + who.schema.fields}
    types = {"bucket": "bigint", "customer": "string", "bits": "binary"}
    names = ["period", "bucket", "customer", "bits", *[c for c in totals.columns if c != "period"]]
    return [
        (F.col(c) if c in known else F.lit(None)).cast(types.get(c, known.get(c, ""))).alias(c)
        for c in names
    ] + [F.col("period").cast("date").alias(DAY)]


def merge_states(states: DataFrame) -> DataFrame:
    """States of one period and one set of customers made one."""
    return states.groupBy(DAY, *PART).agg(
        F.bitmap_or_agg("bits").alias("bits"),
        F.sum("total_records").alias("total_records"),
        F.sum("amounts").alias("amounts"),
        F.sum("total_amount").alias("total_amount"),
        F.max("max_amount").alias("max_amount"),
        F.min("min_amount").alias("min_amount"),
    )


def apply_increment(
    path: str,
    df: DataFrame,
    increment: str,
    kind: str = "daily",
    ts: str = "created_at",
    amount: str = "amount",
    customer: str = "customer_id",
    work: str | None = None,
) -> bool:
    """Merge the rows of one increment into the states at ``path``; false if that was done before.

    ``increment`` names it: a name is taken once, so that a job that is run again counts
    nothing twice. The new states are first written whole under ``work``, by default beside the
    table, and moved in from there; a run that was cut short is made good by the next of that name.
    """
    spark = df.sparkSession
    ledger = f"{path}/_increments/{increment}"
    work = work or f"{path}/_work/{increment}"
    rows = f"{work}/rows"
    if finished(spark, ledger):
        discard(spark, rows, work)
        return False
    if not finished(spark, rows):
        states = increment_states(df, kind, ts, amount, customer)
        gather(states, [DAY]).write.mode("overwrite").partitionBy(DAY).parquet(f"{work}/new")
        new = spark.read.schema(states.schema).parquet(f"{work}/new")
        old = stored_rows(path, new, f"{work}/new", [DAY])
        # The kinds of sums stay those of the first increment.
        merged = merge_states(old.unionByName(new).withColumn("bits", _bits()))
        one = merged.withColumn("bits", F.when(F.col("bucket").isNotNull(), F.col("bits")))
        one.select(*states.columns).write.mode("overwrite").parquet(rows)
    (
        gather(spark.read.parquet(rows), [DAY])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
    spark.range(0).write.mode("overwrite").parquet(ledger)
    discard(spark, rows, work)
    return True


def _bits():
    """Rows of totals and of single values take part in the "or" with nothing."""
    return F.coalesce("bits", F.lit(b""))


def read_rollup(spark: SparkSession, path: str, kind: str = "daily") -> DataFrame:
    """The rollup that the stored states amount to; the columns are those of ``period_rollup``."""
    states = spark.read.parquet(path)
    count = F.sum("amounts")
    return (
        states.groupBy("period")
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("total_amount").alias("total_amount"),
            F.try_divide(F.sum("total_amount").cast("double"), count).alias("avg_amount"),
            F.max("max_amount").alias("max_amount"),
            F.min("min_amount").alias("min_amount"),
            (F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)) + F.count("customer")).alias(
                "unique_customers"
            ),
        )
        .withColumns({"aggregation_type": F.lit(kind), "generated_at": F.current_timestamp()})
    )
