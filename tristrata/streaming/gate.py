"""A quality gate on a stream: each micro-batch is admitted or put into quarantine whole, once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tristrata.operators.quality import DataQualityError, QualityPolicy
from tristrata.sinks.merge import file_at, finished
from tristrata.streaming.run import writer

LEDGER = (
    "batch_id BIGINT, total_records BIGINT, records_in_error BIGINT, error_rate DOUBLE, "
    "admitted BOOLEAN, decided_at TIMESTAMP"
)


def admits(policy: QualityPolicy, total: int, errors: int) -> bool:
    """Whether a batch meets the policy: its share of rows in error is within the error rate. An
    empty batch does, and every batch where checks are disabled."""
    return not policy.enabled or not total or errors / total <= policy.error_rate


def decide(
    batch: DataFrame, number: int, in_error: Column, policy: QualityPolicy, ledger: str, staged: str
) -> bool:
    """Write the batch's rows to ``staged``, counting on the way, and enter the decision into the
    ledger. A batch that the ledger has is not judged again, so a replay decides alike."""
    spark = batch.sparkSession
    entry = f"{ledger}/batch_id={number}"
    known = finished(spark, entry)
    seen = Observation()
    bad = F.coalesce(in_error, F.lit(True))
    watched = batch.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("errors"))
    watched.write.mode("overwrite").parquet(staged)
    if known:
        return spark.read.parquet(entry).first().admitted
    total, errors = seen.get["total"], seen.get["errors"]
    admitted = admits(policy, total, errors)
    row = spark.range(1).select(
        F.lit(total).cast("bigint").alias("total_records"),
        F.lit(errors).cast("bigint").alias("records_in_error"),
        F.lit(errors / total if total else None).cast("double").alias("error_rate"),
        F.lit(admitted).alias("admitted"),
        F.current_timestamp().alias("decided_at"),
    )
    row.write.mode("overwrite").parquet(entry)
    return admitted


def publish(spark: SparkSession, staged: str, into: str) -> None:
    """Move a staged directory into its place, in place of what an earlier try left there."""
    files, source = file_at(spark, staged)
    _, target = file_at(spark, into)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{staged} could not be moved to {into}")


def gate_stream(
    rows: DataFrame,
    in_error: Column,
    good: str,
    quarantine: str,
    ledger: str,
    checkpoint: str,
    policy: QualityPolicy = QualityPolicy(),
    trigger: str | None = None,
) -> StreamingQuery:
    """Each batch goes whole to ``good`` or, where too many of its rows are in error, to
    ``quarantine``, under ``batch_id=<n>``; a null in ``in_error`` is an error.

    Rows are written once, counted in the same pass, and moved. With ``fail_on_error`` the query
    stops at a batch that is refused, after that is in quarantine; a restart takes the batch again,
    with the decision of the ledger.
    """

    def judge(batch: DataFrame, number: int) -> None:
        staged = f"{checkpoint}/gate/batch={number}"
        admitted = decide(batch, number, in_error, policy, ledger, staged)
        publish(batch.sparkSession, staged, f"{good if admitted else quarantine}/batch_id={number}")
        if not admitted and policy.fail_on_error:
            raise DataQualityError(f"batch {number} is over the error rate of {policy.error_rate}")

    return writer(rows, checkpoint, trigger).foreachBatch(judge).start()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """A row for each batch that was judged."""
    names = [part.split()[0] for part in LEDGER.split(", ")]
    return spark.read.schema(LEDGER).parquet(ledger).select(*names)
