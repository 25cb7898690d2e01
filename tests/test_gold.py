from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tristrata.operators.gold import period_rollup
from tristrata.sinks.files import write_rollup

SALES = [
    (datetime(2024, 1, 31, 23, 59, 59), 10.0, "a"),
    (datetime(2024, 1, 31, 23, 0, 0), 20.0, "a"),
    (datetime(2024, 1, 31, 1, 0, 0), None, "b"),
    (datetime(2024, 2, 1, 0, 0, 0), 5.0, None),
    (None, 7.0, "c"),
    (None, 9.0, "c"),
]
COLUMNS = ["period", "total_records", "total_amount", "avg_amount", "max_amount", "min_amount",
           "unique_customers"]


def sales(spark, kind="TIMESTAMP"):
    return spark.createDataFrame(SALES, f"created_at {kind}, amount DOUBLE, customer_id STRING")


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_columns_and_types(spark, kind):
    out = period_rollup(sales(spark, kind), "daily")
    assert out.columns == [*COLUMNS, "aggregation_type", "generated_at"]
    assert out.schema["period"].dataType == sales(spark, kind).schema["created_at"].dataType


def test_daily_values(spark):
    out = {r.period: tuple(r)[1:7] for r in period_rollup(sales(spark), "daily").collect()}
    assert out == {
        None: (2, 16.0, 8.0, 9.0, 7.0, 1),
        datetime(2024, 1, 31): (3, 30.0, 15.0, 20.0, 10.0, 2),
        datetime(2024, 2, 1): (1, 5.0, 5.0, 5.0, 5.0, 0),
    }


@pytest.mark.parametrize(
    ("kind", "periods"),
    [
        ("hourly", {None, datetime(2024, 1, 31, 23), datetime(2024, 1, 31, 1), datetime(2024, 2, 1)}),
        ("monthly", {None, datetime(2024, 1, 1), datetime(2024, 2, 1)}),
        ("weekly", {None, datetime(2024, 1, 31), datetime(2024, 2, 1)}),
        ("Daily", {None, datetime(2024, 1, 31), datetime(2024, 2, 1)}),
        ("HOURLY", {None, datetime(2024, 1, 31), datetime(2024, 2, 1)}),
    ],
)
def test_granularity(spark, kind, periods):
    out = period_rollup(sales(spark), kind).collect()
    assert {r.period for r in out} == periods
    assert {r.aggregation_type for r in out} == {kind}


def test_written_under_its_label_twice(spark, tmp_path):
    write_rollup(period_rollup(sales(spark), "daily"), str(tmp_path), "daily")
    write_rollup(period_rollup(sales(spark), "daily"), str(tmp_path), "daily")
    assert (tmp_path / "daily" / "aggregation_type=daily").is_dir()
    assert spark.read.parquet(f"{tmp_path}/daily").count() == 3


def test_hot_period_is_spread_by_customer(spark, plan):
    """The first shuffle is by period and customer, after a partial aggregation."""
    text = plan(period_rollup(sales(spark), "daily"))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert "customer_id" in exchanges[1]
    assert "partial_sum" in text.split("Exchange")[-1]


def test_hot_period_counts(spark):
    """A third of all rows in one period, a third of those by one customer."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit("2024-01-01"))
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        .cast("timestamp").alias("created_at"),
        F.lit(1).alias("amount"),
        F.when(F.col("id") < n // 9, F.lit(-1)).otherwise(F.col("id")).alias("customer_id"),
    )
    hot = period_rollup(df).filter("period = '2024-01-01'").first()
    assert (hot.total_records, hot.total_amount, hot.unique_customers) == (
        n // 3, n // 3, n // 3 - n // 9 + 1,
    )
