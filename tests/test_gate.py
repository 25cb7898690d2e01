import pytest
from pyspark.sql import functions as F

from tristrata.operators.quality import QualityPolicy
from tristrata.streaming import gate
from tristrata.streaming.gate import admits, gate_stream, read_ledger
from tristrata.streaming.run import AVAILABLE_NOW, drain

SCHEMA = "k int, v string"


def feed(spark, tmp_path, rows, policy=QualityPolicy()):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    places = [f"{tmp_path}/{name}" for name in ("good", "bad", "ledger", "cp")]
    return gate_stream(stream, F.col("v") == "x", *places, policy, AVAILABLE_NOW)


def batch(errors, size=20, null=0):
    return [(k, "x" if k < errors else None if k < errors + null else "ok") for k in range(size)]


def stored(spark, path):
    return {r[0]: r[1] for r in spark.read.parquet(str(path)).groupBy("batch_id").count().collect()}


def test_batches_go_whole_by_their_error_rate(spark, rows, tmp_path):
    for part in (batch(1), batch(2), batch(0, null=2), batch(0)):
        drain(feed(spark, tmp_path, part))
    assert stored(spark, tmp_path / "good") == {0: 20, 3: 20}
    assert stored(spark, tmp_path / "bad") == {1: 20, 2: 20}
    ledger = read_ledger(spark, f"{tmp_path}/ledger").drop("decided_at")
    assert rows(ledger) == [(0, 20, 1, 0.05, True), (1, 20, 2, 0.1, False), (2, 20, 2, 0.1, False), (3, 20, 0, 0.0, True)]


def test_a_replay_decides_as_the_ledger_says(spark, rows, tmp_path, monkeypatch):
    with monkeypatch.context() as patch:

        def lost(*args):
            raise RuntimeError("lost")

        patch.setattr(gate, "publish", lost)
        with pytest.raises(Exception, match="lost"):
            drain(feed(spark, tmp_path, batch(1)))
    # The policy is stricter now, but the batch was judged before.
    drain(feed(spark, tmp_path, batch(1), QualityPolicy(error_rate=0.0)))
    assert stored(spark, tmp_path / "good") == {0: 20} and stored(spark, tmp_path / "bad") == {1: 20}
    assert rows(read_ledger(spark, f"{tmp_path}/ledger").select("batch_id", "admitted")) == [(0, True), (1, False)]


def test_fail_on_error_stops_the_query_behind_the_quarantine(spark, tmp_path):
    with pytest.raises(Exception, match="over the error rate"):
        drain(feed(spark, tmp_path, batch(9), QualityPolicy(fail_on_error=True)))
    assert stored(spark, tmp_path / "bad") == {0: 20}


def test_policy():
    assert admits(QualityPolicy(), 100, 5) and not admits(QualityPolicy(), 100, 6)
    assert admits(QualityPolicy(), 0, 0) and admits(QualityPolicy(enabled=False), 1, 1)
    assert admits(QualityPolicy(error_rate=0.1), 100, 10)
