"""Gold: amounts rolled up by period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tristrata.functions.timefns import truncate_ntz

# Label -> truncation unit.
UNITS = {"hourly": "hour", "daily": "day", "monthly": "month"}


def period_of(df: DataFrame, ts: str, unit: str) -> Column:
    """The start of the period that a row's time lies in; a wall-clock time stays one."""
    wall_clock = isinstance(df.schema[ts].dataType, TimestampNTZType)
    return truncate_ntz(ts, unit) if wall_clock else F.date_trunc(unit, F.col(ts))


def period_rollup(
    df: DataFrame,
    kind: str = "daily",
    ts: str = "created_at",
    amount: str = "amount",
    customer: str = "customer_id",
) -> DataFrame:
    """Counts, sum, average, extremes and exact distinct customers per period.

    An unknown label truncates to the day and is kept as given. Rows without a time form one
    group of their own. Spark aggregates by (period, customer) before and after the first
    shuffle and by period only after that, so one period holding most of the rows is spread
    over all customers' tasks.
    """
    period = period_of(df, ts, UNITS.get(kind, "day"))
    totals = df.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
        F.max(amount).alias("max_amount"),
        F.min(amount).alias("min_amount"),
        F.count_distinct(F.col(customer)).alias("unique_customers"),
    )
    return totals.withColumns(
        {"aggregation_type": F.lit(kind), "generated_at": F.current_timestamp()}
    )
