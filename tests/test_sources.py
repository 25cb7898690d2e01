import pytest

from tristrata.schemas import BRONZE
from tristrata.scratch import scratch, staged, sweep
from tristrata.sources.catalog import create_table, read_table
from tristrata.sources.files import read_files
from tristrata.sources.jdbc import jdbc_options, read_table_jdbc
from tristrata.sources.kafka import kafka_options, read_kafka_stream


def test_csv_header_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,score\n1,x,1.5\n2,,2.5\n")
    df = read_files(spark, str(tmp_path), "CSV")
    assert df.dtypes == [("id", "int"), ("name", "string"), ("score", "double")]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "x", 1.5), (2, None, 2.5)]


def test_given_schema_is_taken(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    df = read_files(spark, str(tmp_path), "csv", schema="id BIGINT, name STRING")
    assert df.dtypes == [("id", "bigint"), ("name", "string")]


def test_json_and_glob(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    (tmp_path / "b.txt").write_text("other\n")
    df = read_files(spark, str(tmp_path), "json", glob="*.json")
    assert df.dtypes == [("id", "bigint")] and df.count() == 2


def test_parquet(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/p")
    assert read_files(spark, f"{tmp_path}/p", "Parquet").count() == 3


@pytest.mark.parametrize("fmt", ["xml", "excel", ""])
def test_unknown_format(spark, fmt):
    with pytest.raises(ValueError, match=f"Unsupported format: {fmt}"):
        read_files(spark, "/nowhere", fmt)


def test_avro_when_its_module_is_there(spark, tmp_path):
    try:
        spark.range(3).write.format("avro").save(f"{tmp_path}/a")
    except Exception as error:
        pytest.skip(f"spark-avro is not on the class path: {str(error)[:80]}")
    assert read_files(spark, f"{tmp_path}/a", "avro").count() == 3


def test_directories_become_columns(spark, tmp_path, plan):
    leaf = tmp_path / "topic=t1" / "year=2024" / "month=02" / "day=01"
    leaf.mkdir(parents=True)
    (leaf / "a.json").write_text('{"value": "v", "offset": 7}\n')
    (tmp_path / "topic=t2" / "year=2024" / "month=02" / "day=01").mkdir(parents=True)
    df = read_files(spark, str(tmp_path), "json", schema=BRONZE)
    row = df.first()
    assert (row.topic, row.year, row.month, row.day) == ("t1", 2024, 2, 1)
    pruned = plan(df.filter("topic = 't1' AND day = 1"))
    assert "PartitionFilters: [" in pruned and "topic" in pruned.split("PartitionFilters")[1]


def test_kafka_options():
    assert kafka_options("h:9092", ["a", "b"]) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    more = kafka_options("h", "a", "latest", True, min_partitions=64, max_offsets=1000)
    assert (more["startingOffsets"], more["failOnDataLoss"]) == ("latest", "true")
    assert (more["minPartitions"], more["maxOffsetsPerTrigger"]) == ("64", "1000")


def test_kafka_without_its_module_says_so(spark):
    try:
        read_kafka_stream(spark, "192.0.2.1:9092", "t")
    except Exception as error:
        assert "kafka" in str(error).lower()
    else:
        pytest.skip("spark-sql-kafka is on the class path")


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t", "s", "u", "p") == {
        "url": "jdbc:x", "dbtable": "s.t", "driver": "org.postgresql.Driver", "user": "u",
        "password": "p",
    }
    assert jdbc_options("jdbc:x", "t")["dbtable"] == "t"


def test_jdbc_ranges_are_complete(spark):
    with pytest.raises(ValueError, match="lower, upper and partitions"):
        read_table_jdbc(spark, jdbc_options("jdbc:x", "t"), column="id", lower=0)


def test_table_is_created_once_and_recreated_when_told(spark, tmp_path):
    name = "registry_test"
    create_table(spark, name, location=str(tmp_path / "t"), recreate=True)
    create_table(spark, name, location=str(tmp_path / "t"))
    assert len(read_table(spark, name).columns) == 13
    create_table(spark, name, "a INT", [], location=str(tmp_path / "u"), recreate=True)
    assert read_table(spark, name).columns == ["a"]
    spark.sql(f"DROP TABLE {name}")


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, **conf):
        self.conf = conf


def test_scratch_is_fresh_and_below_a_shared_folder(spark):
    assert scratch(spark, "x") != scratch(spark, "x")
    plain = {"spark.sql.warehouse.dir": "hdfs:///house"}
    assert scratch(Session(**plain), "x").startswith("hdfs:///house/tristrata/x-")
    named = plain | {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert scratch(Session(**named), "x").startswith("hdfs:///shared/tristrata/x-")


def test_staged_rows_are_the_same(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    assert sorted(r.k for r in staged(df, "numbers").collect()) == [0, 1, 2]


def test_sweep_deletes_old_folders_only(spark, tmp_path):
    here = Session(**{"spark.checkpoint.dir": str(tmp_path)})
    here._jvm, here._jsc = spark._jvm, spark._jsc
    assert sweep(here, 1) == []
    spark.range(3).write.parquet(scratch(here, "mine"))
    assert sweep(here, 1) == []
    assert [name.startswith("mine-") for name in sweep(here, -1)] == [True]
    assert sweep(here, -1) == []
