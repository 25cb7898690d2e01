"""Catalog tables: create, recreate, resolve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tristrata.schemas import SILVER, SILVER_KEYS, struct


def create_table(
    spark: SparkSession,
    name: str,
    schema: str | StructType = SILVER,
    partition_by: list[str] = SILVER_KEYS,
    fmt: str = "parquet",
    location: str | None = None,
    recreate: bool = False,
) -> None:
    """Create the table if it is absent; ``recreate`` drops an existing one first."""
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct(schema).fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
