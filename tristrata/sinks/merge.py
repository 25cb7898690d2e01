"""Write modes: append, overwrite, and merge by key into a partitioned Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tristrata.operators.merge import keep_newer, newest_per_key, require_keys
from tristrata.scratch import scratch
from tristrata.sinks.files import gather


def _directories(spark: SparkSession, path: str, levels: int) -> list[str]:
    """The partition directories below a path, as ``p=1/q=2``: file metadata, as in Spark's own
    file index."""
    files, root = file_at(spark, path)
    if not files.exists(root):
        return []
    _, pattern = file_at(spark, path + "/*=*" * levels)
    return [
        "/".join(status.getPath().toString().rsplit("/", levels)[1:])
        for status in files.globStatus(pattern)
    ]


def stored_rows(
    path: str, changes: DataFrame, staged: str, partition_by: list[str]
) -> DataFrame:
    """The table's rows in the directories that the staged changes fall into.

    Only those are read, however many they are; both sides are listed once. Columns that only some
    directories have are kept. The directories' names are read with the types that the changes
    have: Spark would otherwise guess them, and take ``p=007`` for the number 7.
    """
    spark = changes.sparkSession
    touched = set(_directories(spark, staged, len(partition_by)))
    here = [f"{path}/{d}" for d in _directories(spark, path, len(partition_by)) if d in touched]
    if not here:
        return spark.createDataFrame([], changes.schema)
    rows = spark.read.option("basePath", path)
    fields = [
        changes.schema[f.name] if f.name in partition_by else f
        for f in rows.option("mergeSchema", True).parquet(*here).schema.fields
    ]
    return rows.schema(StructType(fields)).parquet(*here)


def file_at(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as Hadoop has them."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def any_files(spark: SparkSession, path: str) -> bool:
    files, name = file_at(spark, path)
    return files.exists(name)


def finished(spark: SparkSession, path: str) -> bool:
    files, marker = file_at(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def discard(spark: SparkSession, rows: str, work: str) -> None:
    """Delete the marker first: rows that are half deleted must not look finished."""
    for path in (f"{rows}/_SUCCESS", work):
        files, name = file_at(spark, path)
        files.delete(name, True)


def merge_partitions(
    path: str,
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    partition_by: list[str],
    work: str | None = None,
) -> None:
    """Upsert into a Parquet table, rewriting only the directories the changes fall into.

    The partition columns must belong to the key, so that a row cannot change directory. A
    stored row that is newer by ``order_by`` stays. A table that is not there yet is made. The
    new content is first written whole under ``work``, by default in the shared scratch
    folder, and moved in from there: no plan reads and overwrites the table at once. A merge
    that was cut short while directories were being replaced is made good when it is run again
    with the same ``work``, which is deleted at the end.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    spark = changes.sparkSession
    work = work or scratch(spark, "merge")
    rows = f"{work}/rows"
    if not finished(spark, rows):
        once = newest_per_key(require_keys(changes, keys), keys, order_by)
        by_directory = once.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
        by_directory.mode("overwrite").parquet(f"{work}/changes")
        newest = spark.read.schema(changes.schema).parquet(f"{work}/changes")
        target = stored_rows(path, changes, f"{work}/changes", partition_by)
        keep_newer(target, newest, keys, order_by).write.mode("overwrite").parquet(rows)
    (
        gather(spark.read.parquet(rows), partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    discard(spark, rows, work)


def write_target(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    keys: list[str] | None = None,
    order_by: list[str] | None = None,
    work: str | None = None,
) -> None:
    """Write a Parquet table in mode ``append`` (default), ``overwrite`` or ``merge``.

    Name ``work``, a folder of this merge's own, to be able to run a merge again that was cut
    short; see ``merge_partitions``.
    """
    kind = mode.lower()
    if kind == "merge":
        if not keys or not order_by or not partition_by:
            raise ValueError("merge needs keys, order_by and partition_by")
        merge_partitions(path, df, keys, order_by, partition_by, work)
    elif kind in ("append", "overwrite"):
        rows = gather(df, partition_by) if partition_by else df
        rows.write.mode(kind).partitionBy(*(partition_by or [])).parquet(path)
    else:
        raise ValueError(f"Unsupported write mode: {mode}")
