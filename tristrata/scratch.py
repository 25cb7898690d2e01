"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share.

    It lies under ``spark.checkpoint.dir``, or, where that is unset, under the session's
    warehouse, which every session shares with its executors. The session is not changed.
    """
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tristrata"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a scratch folder and read back: its lineage is cut there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, hours: float) -> list[str]:
    """Delete scratch folders that were last changed more than ``hours`` ago; gives their names.

    A result may still read the tables it was made from, so they are not deleted behind it. Run
    this when results of that age are no longer read.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    limit = (time.time() - 3600 * hours) * 1000
    old = [f.getPath() for f in files.listStatus(path) if f.getModificationTime() < limit]
    for folder in old:
        files.delete(folder, True)
    return [folder.getName() for folder in old]
