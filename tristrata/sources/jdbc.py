"""Database tables over JDBC, as a source and as a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTGRES_DRIVER = "org.postgresql.Driver"


def jdbc_options(
    url: str,
    table: str,
    schema: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str = POSTGRES_DRIVER,
) -> dict[str, str]:
    options = {"url": url, "dbtable": f"{schema}.{table}" if schema else table, "driver": driver}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def read_table_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table, in parallel ranges of ``column`` when one is given.

    Rows outside ``lower``..``upper`` fall into the first and last range; none is lost.
    """
    reader = spark.read.format("jdbc").options(fetchsize=str(fetch_size), **options)
    if column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a range column needs lower, upper and partitions")
        reader = reader.options(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()


def write_table_jdbc(
    df: DataFrame,
    options: dict[str, str],
    connections: int,
    mode: str = "append",
    batch_size: int = 10_000,
) -> None:
    """Write a table. ``connections`` bounds how many tasks hold a database connection.

    A task that is run again after a lost executor inserts its rows again; write into an
    empty staging table and merge there when the target must hold each row once.
    """
    (
        df.write.format("jdbc")
        .mode(mode)
        .options(numPartitions=str(connections), batchsize=str(batch_size), **options)
        .save()
    )
