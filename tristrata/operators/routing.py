"""Route records by topic path."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.schemas import ROUTES


def path_pattern(topic_filter: str) -> str:
    """MQTT topic filter to regular expression: ``+`` is one level, a last ``#`` any number."""
    levels = topic_filter.split("/")
    rest = levels[-1] == "#"
    if rest:
        levels = levels[:-1]
    body = "/".join("[^/]+" if level == "+" else re.escape(level) for level in levels)
    if rest:
        body = f"{body}(/.*)?" if body else ".*"
    return f"^{body}$"


def route(
    df: DataFrame, path_col: str, rules: dict[str, str] = ROUTES, into: str = "topic"
) -> DataFrame:
    """Add the topic of the first rule that the path matches; rows no rule takes are left out."""
    target = F.coalesce(
        *[F.when(F.col(path_col).rlike(path_pattern(f)), F.lit(t)) for f, t in rules.items()]
    )
    return df.withColumn(into, target).filter(F.col(into).isNotNull())
