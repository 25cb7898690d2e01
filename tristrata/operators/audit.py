"""Run records: what a job did, when, and on how many rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "job_name STRING, status STRING, start_time TIMESTAMP, end_time TIMESTAMP, "
    "duration_ms BIGINT, records_processed BIGINT, error_message STRING, "
    "metrics MAP<STRING, DOUBLE>"
)

# Run statuses.
RUNNING, SUCCESS, FAILED, CANCELLED = "Running", "Success", "Failed", "Cancelled"


def run_record(
    spark,
    name: str,
    status: str,
    start: datetime,
    end: datetime | None = None,
    records: int = 0,
    error: str | None = None,
    metrics: dict[str, float] | None = None,
) -> DataFrame:
    """One row. A run that has not ended has no end and no duration."""
    took = None if end is None else int((end - start).total_seconds() * 1000)
    row = (name, status, start, end, took, records, error, metrics or {})
    return spark.createDataFrame([row], RUN_SCHEMA)


def run_with_audit(
    name: str,
    df: DataFrame,
    write: Callable[[DataFrame], None],
    audit_path: str | None = None,
    metrics: dict | None = None,
) -> DataFrame:
    """Write ``df`` and give the run's record; append it at ``audit_path`` if that is set.

    Rows are counted while they are written, with no scan of their own. ``metrics`` maps
    names to further aggregates taken in the same pass. ``write`` must not shuffle: the count
    is then taken in the writing tasks, where a task run again counts once. A failed write
    leaves a failed record and is raised again.
    """
    spark = df.sparkSession
    start = datetime.now(timezone.utc)
    seen = Observation()
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("_records"),
        *[agg.cast("double").alias(k) for k, agg in (metrics or {}).items()],
    )
    try:
        write(watched)
    except Exception as error:
        record = run_record(
            spark, name, FAILED, start, datetime.now(timezone.utc), error=str(error)
        )
        if audit_path:
            record.write.mode("append").parquet(audit_path)
        raise
    found = dict(seen.get)
    count = found.pop("_records")
    record = run_record(
        spark, name, SUCCESS, start, datetime.now(timezone.utc), count, metrics=found
    )
    if audit_path:
        record.write.mode("append").parquet(audit_path)
    return record
