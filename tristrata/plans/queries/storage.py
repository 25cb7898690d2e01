"""Sources and sinks: each query writes a table out, reads it back and gives its rows."""

from pyspark.sql import functions as F

from tristrata.operators.audit import run_with_audit
from tristrata.operators.bronze import to_bronze
from tristrata.plans import jobs
from tristrata.plans.queries.bronze import BRONZE_SQL
from tristrata.plans.queries.bronze import compared as bronze_compared
from tristrata.plans.queries.silver import CONTACTS_SQL, SILVER_SQL, contacts
from tristrata.plans.registry import query
from tristrata.plans.tables import BATCH_BYTES, kafka_rows, ntz, table
from tristrata.schemas import BRONZE, BRONZE_KEYS
from tristrata.scratch import scratch
from tristrata.sinks.files import gather, write_parquet, write_partitioned
from tristrata.sources.catalog import create_table, read_table
from tristrata.sources.files import read_files
from tristrata.streaming.run import AVAILABLE_NOW, drain

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query(CUSTOMER_SQL)
def ingest_csv(spark, sf_dir):
    """CSV with a header and inferred types, to Parquet."""
    work = scratch(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", "true").csv(f"{work}/in")
    jobs.ingest_files(spark, f"{work}/in", f"{work}/out", "CSV")
    key = F.col("c_custkey").cast("bigint")
    return spark.read.parquet(f"{work}/out").withColumn("c_custkey", key)


@query(CUSTOMER_SQL)
def ingest_json(spark, sf_dir):
    """JSON lines with inferred types, to Parquet."""
    work = scratch(spark, "json")
    table(spark, sf_dir, "customer").write.json(f"{work}/in")
    jobs.ingest_files(spark, f"{work}/in", f"{work}/out", "json", glob="*.json")
    nation = F.col("c_nationkey").cast("int")
    return spark.read.parquet(f"{work}/out").withColumn("c_nationkey", nation)


@query("SELECT * FROM lineitem")
def ingest_parquet(spark, sf_dir):
    work = scratch(spark, "parquet")
    jobs.ingest_files(spark, f"{sf_dir}/lineitem.parquet", f"{work}/out", "parquet")
    return read_files(spark, f"{work}/out", "parquet")


def write_bronze(spark, sf_dir, path):
    """All events as Bronze JSON, by topic and day."""
    rows = to_bronze(kafka_rows(table(spark, sf_dir, "events")))
    write_partitioned(gather(rows, BRONZE_KEYS), path, BRONZE_KEYS, "json")


def read_bronze(spark, path):
    """Stored Bronze with its times and partition number typed again."""
    times = ("event_time", "kafka_timestamp")
    typed = {name: F.try_to_timestamp(name) for name in times}
    rows = read_files(spark, path, "json", f"{BRONZE}, topic STRING")
    return rows.withColumns({**typed, "partition": F.col("partition").cast("int")})


@query(BRONZE_SQL)
def partitioned_layout(spark, sf_dir):
    """Bronze by topic and day; the directories come back as columns."""
    path = scratch(spark, "bronze")
    write_bronze(spark, sf_dir, path)
    return bronze_compared(read_bronze(spark, path))


@query(CONTACTS_SQL)
def cleansed_layout(spark, sf_dir):
    """The cleansing job: contacts to Parquet by processing date."""
    work = scratch(spark, "cleansed")
    write_parquet(contacts(table(spark, sf_dir, "customer")), f"{work}/raw")
    jobs.cleanse(spark, f"{work}/raw", f"{work}/out")
    return spark.read.parquet(f"{work}/out").drop("processing_date", "created_at")


@query(
    """
SELECT 'orders' AS job_name, 'Success' AS status, count(*) AS records_processed,
       CAST(NULL AS VARCHAR) AS error_message, max(o_totalprice) AS max_amount
FROM orders"""
)
def audit_counts(spark, sf_dir):
    """The run record of a write, counted during the write, as stored in the audit table."""
    work = scratch(spark, "audit")
    run_with_audit(
        "orders",
        table(spark, sf_dir, "orders"),
        lambda df: write_parquet(df, f"{work}/out"),
        f"{work}/runs",
        {"max_amount": F.max("o_totalprice")},
    )
    return spark.read.parquet(f"{work}/runs").select(
        "job_name",
        "status",
        "records_processed",
        "error_message",
        F.col("metrics")["max_amount"].alias("max_amount"),
    )


@query(SILVER_SQL)
def table_append(spark, sf_dir):
    """Bronze JSON streamed into a recreated catalog table, by way of the silver job."""
    work = scratch(spark, "silver")
    name = f"silver_{work.rsplit('-', 1)[1]}"
    write_bronze(spark, sf_dir, f"{work}/bronze")
    create_table(spark, name, location=f"{work}/table", recreate=True)
    drain(
        jobs.bronze_to_silver(
            spark,
            f"{work}/bronze",
            name,
            f"{work}/checkpoint",
            topic=None,
            trigger=AVAILABLE_NOW,
            gather_files=True,
            max_bytes=BATCH_BYTES,
        )
    )
    rows = read_table(spark, name).withColumns(ntz("device_ts", "event_time"))
    spark.sql(f"DROP TABLE {name}")  # its files stay
    return rows


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def table_recreate(spark, sf_dir):
    """A table that is there is kept by a plain create, and dropped and made anew when told."""
    work = scratch(spark, "recreated")
    name = f"recreated_{work.rsplit('-', 1)[1]}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    shape = "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING"
    create_table(spark, name, "o_orderkey BIGINT", [], location=f"{work}/old")
    orders.select("o_orderkey").write.insertInto(name)
    create_table(spark, name, shape, [], location=f"{work}/new")
    assert read_table(spark, name).columns == ["o_orderkey"]
    create_table(spark, name, shape, [], location=f"{work}/new", recreate=True)
    orders.filter("o_orderstatus <> 'O'").write.insertInto(name)
    rows = read_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    return rows
