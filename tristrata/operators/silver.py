"""Silver: decoded, flattened and typed readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tristrata.functions.timefns import to_event_time
from tristrata.schemas import CORRUPT, PAYLOADS, SILVER, TEMPERATURE_FIELDS, struct, with_corrupt


def for_topic(df: DataFrame, topic: str) -> DataFrame:
    """Rows of one topic. On a directory layout by topic only its files are read."""
    return df.filter(F.col("topic") == topic)


def list_topics(df: DataFrame) -> DataFrame:
    return df.select("topic").distinct()


def decode_payload(
    df: DataFrame,
    schema: str | StructType,
    column: str = "value",
    into: str = "data",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Parse the JSON payload into a struct; ``keep_corrupt`` keeps unparsable text in it."""
    if keep_corrupt:
        parsed = F.from_json(
            column, with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT}
        )
    else:
        parsed = F.from_json(column, struct(schema))
    return df.withColumn(into, parsed)


def flatten(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Output column -> dotted path, in the order given."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def expand(
    df: DataFrame, schema: str | StructType, column: str = "value", keep: list[str] | None = None
) -> DataFrame:
    """Parse the JSON payload and put each of its fields in a column, next to ``keep``.

    The payload goes through a generator of one row. A later filter on its fields then stays
    above the parse; over a plain projection Spark would push the filter below it and parse
    the text once more for every column the filter names.
    """
    kept = df.columns if keep is None else keep
    return df.select(*kept, F.inline(F.array(F.from_json(column, struct(schema)))))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)


def add_partition_date(
    df: DataFrame, ts_col: str = "timestamp", into: str = "partition_date"
) -> DataFrame:
    return df.withColumn(into, F.to_date(to_event_time(ts_col)))


def conform_silver(df: DataFrame, lineage: bool = False, strict: bool = False) -> DataFrame:
    """The silver columns in table order, with both times typed.

    Bad time text gives null, or an error if ``strict``. ``lineage`` appends the record's
    partition, offset and broker timestamp.
    """
    extra = ["partition", "offset", "timestamp"] if lineage else []
    times = {name: to_event_time(name, strict) for name in ("device_ts", "event_time")}
    return df.select(*struct(SILVER).names, *extra).withColumns(times)


def to_silver(
    df: DataFrame,
    topic: str | None = "sensors.temperature",
    lineage: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Bronze rows to temperature readings, batch or stream.

    ``topic=None`` decodes every row with the temperature schema, whatever its topic.
    """
    rows = df if topic is None else for_topic(df, topic)
    decoded = decode_payload(rows, PAYLOADS["sensors.temperature"])
    return conform_silver(flatten(decoded, TEMPERATURE_FIELDS), lineage, strict)


def clean_topic(
    df: DataFrame,
    topic: str,
    schema: str | StructType,
    keep: list[str] | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """One topic decoded, without rows that lack a key, and with its partition date.

    ``keys`` defaults to those of device and time that the payload has.
    """
    kept = ["topic", "year", "month", "day"] if keep is None else keep
    names = struct(schema).names
    required = [k for k in ("device_id", "timestamp") if k in names] if keys is None else keys
    rows = expand(for_topic(df, topic), schema, keep=kept)
    if required:
        rows = drop_null_keys(rows, required)
    return add_partition_date(rows) if "timestamp" in names else rows


def decode_by_topic(
    df: DataFrame, schemas: dict[str, str | StructType] = PAYLOADS, keep: list[str] | None = None
) -> dict[str, DataFrame]:
    """One DataFrame per topic, each decoded with its own schema.

    Store the input by topic directory first: each result then reads its own files only.
    """
    kept = [c for c in df.columns if c != "value"] if keep is None else keep
    return {
        topic: expand(
            for_topic(df, topic), schema, keep=[c for c in kept if c not in struct(schema).names]
        )
        for topic, schema in schemas.items()
    }


def split_corrupt(df: DataFrame, column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, without the corrupt column, and rows that did not, with it."""
    text = F.col(column)
    good = df.filter(text.isNull())
    if "." in column:
        parent, field = column.rsplit(".", 1)
        good = good.withColumn(parent, F.col(parent).dropFields(field))
    else:
        good = good.drop(column)
    return good, df.filter(text.isNotNull())
