from datetime import datetime

import pytest

from tristrata.operators.bronze import derive_event_time, project_envelope, stamp_ingest, to_bronze
from tristrata.operators.routing import path_pattern, route
from tristrata.operators.silver import for_topic, list_topics
from tristrata.schemas import ENVELOPE

AT = datetime(2024, 3, 1, 12, 0, 0, 5)


def envelope(spark, *values):
    data = [(v, "sensors.motion", 1, i, AT) for i, v in enumerate(values)]
    return spark.createDataFrame(data, ENVELOPE)


def test_binary_value_becomes_text(spark, rows):
    raw = envelope(spark, '{"a": 1}').selectExpr(
        "CAST(value AS BINARY) AS value", "CAST('k' AS BINARY) AS key", "topic", "partition",
        "offset", "timestamp", "0 AS timestampType",
    )
    out = project_envelope(raw)
    assert out.columns == ["value", "topic", "partition", "offset", "timestamp"]
    assert out.first().value == '{"a": 1}'


def test_stamps(spark):
    row = stamp_ingest(envelope(spark, "{}")).first()
    assert row.kafka_timestamp == AT
    assert row.ingestion_ts is not None


def test_event_time_keeps_micros_and_zone(spark, rows):
    out = derive_event_time(
        envelope(
            spark,
            '{"timestamp": "2024-01-31T23:59:59.123456+00:00"}',
            '{"timestamp": "2024-01-31T23:59:59.123456-02:00"}',
            '{"timestamp": "2024-02-01T00:00:00Z"}',
        )
    )
    assert rows(out, "offset", "event_time", "year", "month", "day") == [
        (0, datetime(2024, 1, 31, 23, 59, 59, 123456), 2024, 1, 31),
        (1, datetime(2024, 2, 1, 1, 59, 59, 123456), 2024, 2, 1),
        (2, datetime(2024, 2, 1), 2024, 2, 1),
    ]


def test_bad_times_give_null_keys(spark, rows):
    out = to_bronze(envelope(spark, "no json", '{"x": 1}', '{"timestamp": "soon"}', None))
    assert rows(out, "offset", "event_time", "year", "month", "day") == [
        (i, None, None, None, None) for i in range(4)
    ]


def test_strict_raises_on_bad_time(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast|malformed"):
        to_bronze(envelope(spark, '{"timestamp": "soon"}'), strict=True).collect()


def test_strict_lets_a_missing_time_be_null(spark):
    assert to_bronze(envelope(spark, '{"x": 1}'), strict=True).first().event_time is None


@pytest.mark.parametrize(
    ("topic_filter", "path", "matches"),
    [
        ("sensors/motion/+", "sensors/motion/d1", True),
        ("sensors/motion/+", "sensors/motion/d1/x", False),
        ("sensors/motion/+", "sensors/motion/", False),
        ("sensors/motion/+", "xsensors/motion/d1", False),
        ("sensors/#", "sensors/motion/d1", True),
        ("sensors/#", "sensors", True),
        ("#", "anything/at/all", True),
        ("a.b/+", "axb/c", False),
    ],
)
def test_topic_filters(spark, topic_filter, path, matches):
    df = spark.createDataFrame([(path,)], "path STRING")
    assert df.filter(df.path.rlike(path_pattern(topic_filter))).count() == int(matches)


def test_route_keeps_the_rows_whole_and_drops_other_topics(spark, rows):
    df = spark.createDataFrame(
        [
            ("sensors/temperature/d1", 1),
            ("sensors/air_quality/d2", 2),
            ("sensors/weather/d3", 3),
            ("events/user/login", 4),
            (None, 5),
        ],
        "path STRING, payload INT",
    )
    assert rows(route(df, "path")) == [
        ("sensors/air_quality/d2", 2, "sensors.air_quality"),
        ("sensors/temperature/d1", 1, "sensors.temperature"),
    ]


def test_topics(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "topic STRING, n INT")
    assert rows(list_topics(df)) == [("a",), ("b",)]
    assert rows(for_topic(df, "a")) == [("a", 1), ("a", 3)]
