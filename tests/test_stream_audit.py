import pytest
from pyspark.sql import functions as F

from tristrata.streaming.audit import END, StreamAudit, read_records
from tristrata.streaming.run import AVAILABLE_NOW, drain, to_files

SCHEMA = "k int"


@pytest.fixture
def audit(spark, tmp_path):
    own = StreamAudit(spark, f"{tmp_path}/runs")
    spark.streams.addListener(own)
    yield own
    spark.streams.removeListener(own)


def stream(spark, tmp_path, name, trigger=AVAILABLE_NOW, column=None):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    rows = rows.withColumn("x", F.lit(1) if column is None else column)
    return to_files(rows, f"{tmp_path}/out-{name}", f"{tmp_path}/cp-{name}", trigger=trigger, name=name)


def records(spark, audit):
    found = read_records(spark, audit.path).orderBy("job_name", "batch_id").collect()
    return [(r.job_name, r.batch_id, r.status, r.records_processed) for r in found], found


def test_a_record_for_each_batch_and_end(spark, tmp_path, audit):
    for size in (3, 4):
        spark.range(size).selectExpr("CAST(id AS INT) AS k").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    runs = [stream(spark, tmp_path, "fine"), stream(spark, tmp_path, None)]
    drain(*runs)
    audit.wait(*runs)
    got, full = records(spark, audit)
    assert sorted(got)[0] == ("fine", END, "Success", 7)
    assert sorted((r[1], r[3]) for r in got[1:]) in ([(0, 3), (1, 4)], [(0, 4), (1, 3)])
    assert all(r.end_time >= r.start_time and r.run_id == str(runs[0].runId) for r in full)


def test_failed_and_cancelled_runs(spark, tmp_path, audit):
    spark.range(3).selectExpr("CAST(id AS INT) AS k").coalesce(1).write.parquet(f"{tmp_path}/in")
    bad = stream(spark, tmp_path, "bad", column=F.raise_error(F.lit("no good")).cast("int"))
    with pytest.raises(Exception, match="no good"):
        drain(bad)
    long = stream(spark, tmp_path, "long", trigger="1 second")
    long.processAllAvailable()
    audit.cancel(long)
    audit.wait(bad, long)
    got, full = records(spark, audit)
    assert got == [("bad", END, "Failed", 0), ("long", END, "Cancelled", 3), ("long", 0, "Success", 3)]
    assert "no good" in full[0].error_message and full[1].error_message is None


def test_waiting_has_an_end(spark, audit):
    class Query:
        runId = "none"

    with pytest.raises(TimeoutError):
        audit.wait(Query(), seconds=0.2)
