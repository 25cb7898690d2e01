"""Merges into a bucketed table, which stays where it is.

The table is bucketed by its key, so that rows of a key lie in one bucket. Changes are cut to one
row per key, dealt out by the same hash into as many parts, and meet the stored rows bucket by
bucket: whatever the size of the table, only changes are shuffled. How the changes are stored, in
another number of buckets or in none, does not matter.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.operators.merge import newest_per_key, require_keys


def write_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int, mode: str = "errorifexists"
) -> None:
    """A Parquet table of ``buckets`` buckets by key, a file each and sorted by key."""
    (
        df.repartition(buckets, *keys)
        .write.mode(mode)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def bucket_count(spark: SparkSession, table: str, keys: list[str]) -> int:
    """Into how many buckets by these keys the table is cut; another table is an error."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")

    def line(name: str, otherwise: str) -> str:
        found = described.where(F.col("col_name") == name).first()
        return found.data_type if found else otherwise

    count = int(line("Num Buckets", "0"))
    columns = line("Bucket Columns", "[]").strip("[]").replace("`", "")
    if not count or [c.strip() for c in columns.split(",")] != keys:
        raise ValueError(f"{table} is not bucketed by {', '.join(keys)}")
    return count


def co_located(changes: DataFrame, keys: list[str], order_by: list[str], buckets: int) -> DataFrame:
    """The newest change per key, dealt out as the table's buckets are.

    Tasks cut their rows to one per key before the first shuffle, so a hot key stays small; the
    second moves one row per key.
    """
    return newest_per_key(require_keys(changes, keys), keys, order_by).repartition(buckets, *keys)


def merged(target: DataFrame, newest: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Of each key the row with the greater ``order_by``, stored or new; on a tie the new one.

    A full outer join, which is never a broadcast: it takes both sides as they are dealt out.
    """
    names = [c for c in target.columns if c not in keys]
    pack = [F.struct(F.lit(True).alias("here"), *names).alias(side) for side in ("old", "new")]
    both = target.select(*keys, pack[0]).join(newest.select(*keys, pack[1]), keys, "full_outer")

    def order(side: str):
        # A key's own columns are equal on both sides.
        return F.struct(*[F.col(f"{side}.{c}") for c in order_by if c not in keys])

    newer = F.col("new.here")
    if [c for c in order_by if c not in keys]:
        newer &= F.col("old.here").isNull() | (order("new") >= order("old"))
    row = F.when(F.coalesce(newer, F.lit(False)), F.col("new")).otherwise(F.col("old"))
    picked = both.select(*keys, row.alias("row"))
    return picked.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in target.columns])


def upsert_bucketed(
    spark: SparkSession, table: str, changes: DataFrame, keys: list[str], order_by: list[str]
) -> None:
    """Upsert into a bucketed table: each bucket is read, merged and written by one task.

    The new state is written whole to a table beside it, which then takes its name. A merge that
    was cut short before that leaves the table as it was; run it again. One cut short between the
    two renamings is made good by ``recover``, which every merge calls first.
    """
    recover(spark, table)
    buckets = bucket_count(spark, table, keys)
    target = spark.table(table)
    newest = co_located(changes.select(*target.columns), keys, order_by, buckets)
    fresh = f"{table}__next_{uuid.uuid4().hex[:8]}"
    rows = merged(target, newest, keys, order_by)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(fresh)
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}__ready")
    swap(spark, table)


def swap(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {table}__ready RENAME TO {table}")


def recover(spark: SparkSession, table: str) -> None:
    """Give a finished merge's table its name."""
    if spark.catalog.tableExists(f"{table}__ready"):
        swap(spark, table)


def insert_absent_bucketed(
    spark: SparkSession, table: str, new: DataFrame, keys: list[str]
) -> None:
    """Append the rows whose key the bucketed table lacks, one per key.

    The stored side is read by its keys alone and not shuffled; the files added keep the buckets.
    A key that comes again finds itself there, so a run that was repeated adds nothing.
    """
    recover(spark, table)
    buckets = bucket_count(spark, table, keys)
    target = spark.table(table)
    one = co_located(new.select(*target.columns), keys, [], buckets)
    same = reduce(and_, [F.col(f"n.{k}") == F.col(f"t.{k}") for k in keys])
    known = target.select(*keys).alias("t").hint("merge")
    absent = one.alias("n").join(known, same, "left_anti")
    absent.write.mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
