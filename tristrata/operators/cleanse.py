"""Cleansing: duplicates, contact fields, scores and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.functions.text import normalise_email, normalise_phone, quality_score

# The audit column names.
AUDIT_COLUMNS = [
    "created_at",
    "updated_at",
    "created_by",
    "updated_by",
    "version",
    "is_deleted",
    "source_system",
    "processing_date",
    "job_id",
    "batch_id",
    "partition_key",
]


def dedupe(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row of each group of equal rows, or of each key.

    Each task keeps one row per group before the shuffle, so a group of any size is cheap.
    """
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()


def add_audit_columns(df: DataFrame, **values: Column | object) -> DataFrame:
    """Stamp ``processing_date`` and ``created_at``, and any other audit column given."""
    unknown = set(values) - set(AUDIT_COLUMNS)
    if unknown:
        raise ValueError(f"not audit columns: {sorted(unknown)}")
    stamps = {"processing_date": F.current_date(), "created_at": F.current_timestamp(), **values}
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(v) for k, v in stamps.items()}
    )


def partition_key(*columns: str) -> Column:
    """The columns' text joined by ``|``, for the audit column of that name."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def keep_scored(
    df: DataFrame, min_score: float = 0.5, column: str = "data_quality_score"
) -> DataFrame:
    return df.filter(F.col(column) > min_score)


def cleanse_contacts(df: DataFrame, email: str = "email", phone: str = "phone") -> DataFrame:
    """Distinct rows with clean contacts, audit stamps and a score; unusable e-mails go.

    The score depends on the row alone, so Spark filters before it removes duplicates.
    """
    return keep_scored(
        add_audit_columns(dedupe(df))
        .withColumns({email: normalise_email(email), phone: normalise_phone(phone)})
        .withColumn("data_quality_score", quality_score(email))
    )
