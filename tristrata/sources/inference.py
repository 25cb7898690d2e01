"""Infer one payload schema per topic from stored data."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def _as_json_type(kind: DataType) -> DataType:
    """What JSON schema inference gives: fractions are doubles, mixed and empty are text."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_json_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_json_type(kind.elementType))
    if isinstance(kind, DecimalType) and kind.scale > 0:
        return DoubleType()
    if isinstance(kind, (NullType, VariantType)):
        return StringType()
    return kind


def topic_schemas(df: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """One row per topic with the merged shape of its payloads, found in a single pass.

    Each task merges its own rows first, so one row per topic and task is shuffled.
    """
    shape = F.schema_of_variant_agg(F.try_parse_json(value))
    return df.groupBy(F.col(topic).alias("topic")).agg(shape.alias("shape"))


def shape_type(shape: str | None) -> StructType | None:
    """The type that a shape of ``schema_of_variant_agg`` names; none if it is no object's."""
    if shape is None or not shape.startswith("OBJECT<"):
        return None
    ddl = _OBJECT.sub(lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), shape)
    return StructType.fromDDL(f"payload {ddl}")[0].dataType


def infer_schemas(
    df: DataFrame, topics: list[str], topic: str = "topic", value: str = "value"
) -> dict[str, StructType]:
    """Topic -> schema for the topics named, for use as fixed schemas on a stream.

    The driver holds one schema for each of them. Topics whose payloads are not objects are left
    out; ``topic_schemas`` gives the shapes of all topics as rows.
    """
    named = df.filter(F.col(topic).isin(topics))
    found = {}
    for row in topic_schemas(named, topic, value).collect():
        kind = shape_type(row.shape)
        if kind is not None:
            found[row.topic] = _as_json_type(kind)
    return found
