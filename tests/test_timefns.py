from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tristrata.functions.timefns import (
    ISO_FORMAT,
    add_days,
    add_hours,
    format_ts,
    now,
    parse_ts,
    to_event_time,
    truncate_ntz,
)


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "fmt", "want"),
    [
        ("2024-02-29 23:59:58", None, datetime(2024, 2, 29, 23, 59, 58)),
        ("2024-02-29T23:59:58", ISO_FORMAT, datetime(2024, 2, 29, 23, 59, 58)),
        ("2024-02-29T23:59", ISO_FORMAT, datetime(2024, 2, 29, 23, 59)),
        ("2024-02-29T23:59:58.5", ISO_FORMAT, datetime(2024, 2, 29, 23, 59, 58, 500000)),
        ("2024-02-29T23:59:58.123456", ISO_FORMAT, datetime(2024, 2, 29, 23, 59, 58, 123456)),
    ],
)
@pytest.mark.parametrize("strict", [True, False])
def test_parse(spark, text, fmt, want, strict):
    column = parse_ts("t", fmt, strict) if fmt else parse_ts("t", strict=strict)
    assert one(spark, column, t=text) == want


@pytest.mark.parametrize("text", ["2024-02-30 00:00:00", "2024-02-29", "soon"])
def test_bad_text(spark, text):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        one(spark, parse_ts("t"), t=text)
    assert one(spark, parse_ts("t", strict=False), t=text) is None


def test_format(spark):
    at = datetime(2024, 2, 29, 3, 4, 5)
    assert one(spark, format_ts("t"), t=at) == "2024-02-29 03:04:05"
    assert one(spark, format_ts("t", "yyyyMMdd"), t=at) == "20240229"


def test_add(spark):
    at = datetime(2024, 2, 28, 23, 0)
    t = F.col("t").cast("timestamp_ntz")
    assert one(spark, add_days(t, 2), t=at) == datetime(2024, 3, 1, 23, 0)
    assert one(spark, add_days(t, -28), t=at) == datetime(2024, 1, 31, 23, 0)
    assert one(spark, add_hours(t, 25), t=at) == datetime(2024, 3, 1, 0, 0)
    assert one(spark, add_hours(t, -24), t=at) == datetime(2024, 2, 27, 23, 0)
    assert one(spark, add_days(t, F.col("n")), t=at, n=1) == datetime(2024, 2, 29, 23, 0)


def test_a_day_is_a_wall_clock_day(spark):
    """Also across a change of clocks."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        t = F.lit("2024-03-30 02:30:00").cast("timestamp_ntz")
        got = spark.range(1).select(add_days(t, 1), add_hours(t, 24)).first()
        assert tuple(got) == (datetime(2024, 3, 31, 2, 30),) * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("unit", "want"),
    [
        ("hour", datetime(2024, 3, 31, 2)),
        ("day", datetime(2024, 3, 31)),
        ("month", datetime(2024, 3, 1)),
    ],
)
def test_hours_that_a_zone_lacks(spark, unit, want):
    """Half past two does not exist on that day in Paris, but is a wall-clock time."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        text = "2024-03-31 02:30:15"
        t = F.lit(text).cast("timestamp_ntz")
        df = spark.range(1)
        assert df.select(truncate_ntz(t, unit)).first()[0] == want
        assert df.select(parse_ts(F.lit(text), strict=False)).first()[0] == datetime(
            2024, 3, 31, 2, 30, 15
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_now(spark):
    assert dict(spark.range(1).select(now().alias("t")).dtypes) == {"t": "timestamp_ntz"}


def test_event_time(spark):
    assert one(spark, to_event_time("t"), t="2024-01-01T01:00:00+01:00") == datetime(2024, 1, 1)
    assert one(spark, to_event_time("t"), t="soon") is None


def test_wall_clock_text_in_a_zone_with_summer_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS t, TIMESTAMP'2024-03-10 12:00:00Z' AS i")
        got = df.select(format_ts("t").alias("a"), format_ts("i").alias("b"), format_ts("t", "yyyy/MM").alias("c")).first()
        assert tuple(got) == ("2024-03-10 02:30:00", "2024-03-10 08:00:00", "2024/03")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
