from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tristrata.operators.audit import CANCELLED, RUNNING, run_record, run_with_audit
from tristrata.sinks.files import write_parquet


def test_success(spark, tmp_path):
    df = spark.range(100)
    record = run_with_audit(
        "copy", df, lambda d: write_parquet(d, f"{tmp_path}/o"), f"{tmp_path}/runs",
        {"top": F.max("id")},
    ).first()
    assert (record.job_name, record.status, record.records_processed) == ("copy", "Success", 100)
    assert record.error_message is None and record.duration_ms >= 0
    assert record.metrics == {"top": 99.0}
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 1


def test_failure_is_recorded_and_raised(spark, tmp_path):
    def broken(df):
        raise OSError("disk full")

    with pytest.raises(OSError, match="disk full"):
        run_with_audit("copy", spark.range(1), broken, f"{tmp_path}/runs")
    row = spark.read.parquet(f"{tmp_path}/runs").first()
    assert (row.status, row.error_message, row.records_processed) == ("Failed", "disk full", 0)


def test_other_statuses(spark):
    start = datetime.now(timezone.utc)
    for status in (RUNNING, CANCELLED):
        row = run_record(spark, "j", status, start).first()
        assert (row.status, row.end_time, row.duration_ms) == (status, None, None)


def test_count_takes_no_scan_of_its_own(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def touch(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    df = spark.range(50).mapInPandas(touch, "id BIGINT")
    run_with_audit("copy", df, lambda d: write_parquet(d, f"{tmp_path}/o"))
    assert seen.value == 50
