"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

# JSON otherwise keeps milliseconds only.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def gather(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of one output directory together, as whole files of sensible size.

    Without it every task writes a file into every directory it has rows for. Adaptive
    execution, which must be on as it is by default, joins small directories' rows into one
    task and splits a directory that holds a large share of all rows over several.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: list[str],
    fmt: str = "parquet",
    mode: str = "overwrite",
    **options: str,
) -> None:
    """Write by key directories; null keys go to the default directory and read back as null.

    Pass the rows through ``gather`` first when each task holds rows of many directories.
    """
    settings = {"timestampFormat": MICROS, **options} if fmt in ("json", "csv") else options
    df.write.format(fmt).mode(mode).partitionBy(*keys).options(**settings).save(path)


def write_rollup(df: DataFrame, path: str, kind: str) -> None:
    """A rollup under ``<path>/<kind>/aggregation_type=<kind>/``."""
    write_partitioned(df, f"{path}/{kind}", ["aggregation_type"])


def write_cleansed(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, ["processing_date"])
