import json
import threading
import time
from datetime import datetime

import pytest

from tristrata.__main__ import main
from tristrata.operators.bronze import to_bronze
from tristrata.operators.quality import DataQualityError
from tristrata.plans import jobs
from tristrata.schemas import BRONZE_KEYS, ENVELOPE
from tristrata.sinks.files import write_partitioned
from tristrata.sources.catalog import create_table, read_table


def test_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,x\n2,\n")
    record = jobs.ingest_files(spark, f"{tmp_path}/in", f"{tmp_path}/out").first()
    assert record.records_processed == 2
    assert record.metrics == {"records_with_nulls": 1.0}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_empty_input_fails_and_leaves_the_output(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n")
    spark.range(3).write.parquet(f"{tmp_path}/out")
    with pytest.raises(DataQualityError, match="No data found to process"):
        jobs.ingest_files(
            spark, f"{tmp_path}/in", f"{tmp_path}/out", audit_path=f"{tmp_path}/runs"
        )
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    assert spark.read.parquet(f"{tmp_path}/runs").first().status == "Failed"


def test_cleanse_and_aggregate(spark, tmp_path):
    data = [
        (" A@x.org", "1", datetime(2024, 1, 1, 3), 2.0, "c1"),
        (" A@x.org", "1", datetime(2024, 1, 1, 3), 2.0, "c1"),
        ("b@x.org", "2", datetime(2024, 1, 1, 4), 3.0, "c2"),
        ("no mail", "3", datetime(2024, 1, 1, 5), 9.0, "c3"),
    ]
    spark.createDataFrame(
        data, "email STRING, phone STRING, created_at TIMESTAMP, amount DOUBLE, customer_id STRING"
    ).write.parquet(f"{tmp_path}/raw")
    rows = spark.read.parquet(f"{tmp_path}/raw")
    assert rows.count() == 4
    # The cleansing job stamps created_at anew, so the rollup is over the time of the run.
    assert jobs.cleanse(spark, f"{tmp_path}/raw", f"{tmp_path}/clean").first().records_processed == 2
    record = jobs.aggregate(spark, f"{tmp_path}/raw", f"{tmp_path}/gold", "daily").first()
    assert (record.records_processed, record.metrics) == (1, {"input_records": 4.0})
    gold = spark.read.parquet(f"{tmp_path}/gold/daily").first()
    assert (gold.total_amount, gold.unique_customers, gold.aggregation_type) == (16.0, 3, "daily")


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"id": 1}) + "\n")
    main(["ingest", f"{tmp_path}/in", f"{tmp_path}/out", "json"])
    assert "Success" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        jobs.ingest_files(spark, str(tmp_path), str(tmp_path / "o"), "xml")


def test_silver_command_line(spark, tmp_path):
    """The stream is started by the command line and stopped from here."""
    at = datetime(2024, 5, 6, 7)
    value = json.dumps({"device_id": "d", "timestamp": "2024-05-06T07:00:00+00:00"})
    rows = [(value, topic, 0, 1, at) for topic in ("sensors.temperature", "sensors.motion")]
    bronze = to_bronze(spark.createDataFrame(rows, ENVELOPE))
    write_partitioned(bronze, f"{tmp_path}/bronze", BRONZE_KEYS, "json")
    create_table(spark, "silver_cli_test", location=f"{tmp_path}/table", recreate=True)

    def stop_when_done():
        while not spark.streams.active:
            time.sleep(0.1)
        query = spark.streams.active[0]
        query.processAllAvailable()
        query.stop()

    stopper = threading.Thread(target=stop_when_done)
    stopper.start()
    main(["silver", f"{tmp_path}/bronze", "silver_cli_test", f"{tmp_path}/cp", "--max-bytes", "999"])
    stopper.join(60)
    assert read_table(spark, "silver_cli_test").count() == 1
    spark.sql("DROP TABLE silver_cli_test")
