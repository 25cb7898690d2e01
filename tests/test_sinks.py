import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tristrata.operators.bronze import to_bronze
from tristrata.schemas import BRONZE, BRONZE_KEYS, ENVELOPE
from tristrata.sources.files import read_parquet_stream
from tristrata.streaming.run import AVAILABLE_NOW, drain, to_files
from tristrata.sinks.files import gather, write_cleansed, write_parquet, write_partitioned


def test_overwrite(spark, tmp_path):
    path = f"{tmp_path}/o"
    for n in (5, 3):
        write_parquet(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3


def bronze(spark):
    at = datetime(2024, 5, 6, 7, 8, 9, 123456)
    good = json.dumps({"timestamp": "2024-05-06T07:08:09.123456+00:00"})
    data = [(good, "t1", 0, 1, at), ("no json", "t1", 0, 2, at), (good, "t2", 0, 3, at)]
    return to_bronze(spark.createDataFrame(data, ENVELOPE))


def test_bronze_layout(spark, tmp_path, rows):
    write_partitioned(bronze(spark), str(tmp_path), BRONZE_KEYS, "json")
    assert (tmp_path / "topic=t1" / "year=2024" / "month=5" / "day=6").is_dir()
    lost = tmp_path / "topic=t1" / "year=__HIVE_DEFAULT_PARTITION__"
    assert lost.is_dir()
    line = json.loads(next((tmp_path / "topic=t2").rglob("*.json")).read_text())
    assert set(line) == {
        "value", "partition", "offset", "timestamp", "kafka_timestamp", "ingestion_ts", "event_time",
    }
    assert line["event_time"] == "2024-05-06T07:08:09.123456Z"
    back = spark.read.schema(f"{BRONZE}, topic STRING").json(str(tmp_path))
    assert rows(back, "topic", "offset", "year", "month", "day") == [
        ("t1", 1, 2024, 5, 6),
        ("t1", 2, None, None, None),
        ("t2", 3, 2024, 5, 6),
    ]


def test_cleansed_layout(spark, tmp_path):
    df = spark.range(2).withColumn("processing_date", F.lit("2024-05-06").cast("date"))
    write_cleansed(df, str(tmp_path))
    assert (tmp_path / "processing_date=2024-05-06").is_dir()


def files(path):
    return [f for f in path.rglob("*.parquet")]


def test_gather_writes_few_files(spark, tmp_path):
    """Eight tasks with rows of five directories each: one file per directory, not forty."""
    df = spark.range(0, 8000, 1, 8).withColumn("p", F.col("id") % 5)
    write_partitioned(df, f"{tmp_path}/plain", ["p"])
    write_partitioned(gather(df, ["p"]), f"{tmp_path}/gathered", ["p"])
    assert len(files(tmp_path / "plain")) == 40
    assert len(files(tmp_path / "gathered")) == 5
    assert spark.read.parquet(f"{tmp_path}/gathered").count() == 8000


def test_gather_splits_a_hot_directory(spark, tmp_path):
    """Two thirds of the rows in one directory do not end in one task."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "64k")
    try:
        df = spark.range(0, 90_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("p")
        )
        write_partitioned(gather(df, ["p"]), f"{tmp_path}/hot", ["p"])
    finally:
        spark.conf.set(advisory, before)
    assert len(files(tmp_path / "hot" / "p=0")) > 1
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 90_000


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_formats(spark, tmp_path, fmt):
    df = spark.range(4).withColumn("p", F.col("id") % 2)
    write_partitioned(df, f"{tmp_path}/{fmt}", ["p"], fmt)
    assert spark.read.format(fmt).load(f"{tmp_path}/{fmt}").filter("p = 1").count() == 2


def test_gather_on_a_stream(spark, tmp_path):
    df = spark.range(0, 8000, 1, 8).withColumn("p", F.col("id") % 5)
    df.write.parquet(f"{tmp_path}/in")
    stream = read_parquet_stream(spark, f"{tmp_path}/in", "id BIGINT, p BIGINT")
    for name, rows in (("plain", stream.repartition(8)), ("gathered", gather(stream.repartition(8), ["p"]))):
        drain(
            to_files(
                rows, f"{tmp_path}/{name}", f"{tmp_path}/cp-{name}", partition_by=["p"],
                trigger=AVAILABLE_NOW,
            )
        )
    assert len(files(tmp_path / "plain")) == 40
    assert len(files(tmp_path / "gathered")) == 5
    assert spark.read.parquet(f"{tmp_path}/gathered").count() == 8000
