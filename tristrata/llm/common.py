"""Helpers the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and every other character as it is; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def salted(df: DataFrame, ways: int) -> DataFrame:
    """Every row ``ways`` times, once for each value of a new column ``salt``."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))


def salt_of(ways: int, *columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(ways)).cast("int")


def apart(docs: DataFrame, text_col: str) -> DataFrame:
    """``text``, and the other columns as one column ``rest``, where no name of theirs clashes."""
    others = [F.col(c) for c in docs.columns if c != text_col]
    rest = F.struct(*others) if others else F.struct(F.lit(0).alias("none"))
    return docs.select(F.col(text_col).alias("text"), rest.alias("rest"))


def together(rows: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """The rows of ``apart`` with the columns of ``docs`` again."""
    return rows.select(
        *[F.col("text").alias(c) if c == text_col else F.col(f"rest.{c}") for c in docs.columns]
    )
