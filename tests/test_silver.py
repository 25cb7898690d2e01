import json
from datetime import date, datetime

import pytest

from tristrata.functions.text import message_key
from tristrata.operators.bronze import to_bronze
from tristrata.operators.silver import (
    add_partition_date,
    clean_topic,
    conform_silver,
    decode_by_topic,
    decode_payload,
    drop_null_keys,
    expand,
    flatten,
    split_corrupt,
    to_silver,
)
from tristrata.schemas import ENVELOPE, PAYLOADS, SILVER, TEMPERATURE_FIELDS, struct
from tristrata.sources.inference import infer_schemas

READING = {
    "device_id": "device_001",
    "timestamp": "2024-05-06T07:08:09.101112+00:00",
    "sensor_type": "temperature",
    "location": {"latitude": 1.5, "longitude": -2.25, "city": "Lyon"},
    "temperature": 21.5,
    "humidity": 40.0,
    "unit": "°C",
}
AT = datetime(2024, 5, 6)


def bronze(spark, *payloads, topic="sensors.temperature"):
    data = [
        (p if isinstance(p, str) else json.dumps(p), topic, 0, i, AT)
        for i, p in enumerate(payloads)
    ]
    return to_bronze(spark.createDataFrame(data, ENVELOPE))


def test_silver_row(spark):
    out = to_silver(bronze(spark, READING))
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in struct(SILVER)
    ]
    at = datetime(2024, 5, 6, 7, 8, 9, 101112)
    assert tuple(out.first()) == (
        "device_001", at, "temperature", 1.5, -2.25, "Lyon", 21.5, 40.0, "°C", at, 2024, 5, 6,
    )


def test_silver_takes_its_own_topic_unless_told(spark):
    rows = bronze(spark, READING).union(bronze(spark, READING, topic="sensors.motion"))
    assert to_silver(rows).count() == 1
    assert to_silver(rows, topic=None).count() == 2


def test_garbage_and_wrong_types_null_the_fields(spark):
    out = to_silver(bronze(spark, "no json", {**READING, "temperature": "warm"})).collect()
    assert [r.device_id for r in out] == [None, "device_001"]
    assert [r.temperature for r in out] == [None, None]
    assert out[1].humidity == 40.0


def test_strict_silver_raises_on_bad_time(spark):
    rows = bronze(spark, {**READING, "timestamp": "soon"})
    assert to_silver(rows).first().device_ts is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast|malformed"):
        to_silver(rows, strict=True).collect()


def test_lineage(spark):
    out = to_silver(bronze(spark, READING), lineage=True)
    assert out.columns[-3:] == ["partition", "offset", "timestamp"]


def test_flatten_renames(spark):
    decoded = decode_payload(bronze(spark, READING), PAYLOADS["sensors.temperature"])
    out = flatten(decoded, TEMPERATURE_FIELDS)
    assert out.columns == list(TEMPERATURE_FIELDS)
    assert conform_silver(out).first().device_ts == datetime(2024, 5, 6, 7, 8, 9, 101112)


def test_expand_gives_one_row_for_any_text(spark, rows):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "no json"), (3, None)], "id INT, value STRING")
    assert rows(expand(df, "k BIGINT", keep=["id"])) == [(1, 5), (2, None), (3, None)]


def test_expand_parses_once_under_a_filter(spark, plan):
    df = bronze(spark, READING)
    out = drop_null_keys(
        expand(df, PAYLOADS["sensors.temperature"], keep=["topic"]), ["device_id", "timestamp"]
    )
    assert plan(out).count("from_json") == 1


def test_clean_topic(spark, rows):
    payloads = [READING, {**READING, "device_id": None}, {**READING, "timestamp": "soon"}, "x"]
    out = clean_topic(
        bronze(spark, *payloads), "sensors.temperature", PAYLOADS["sensors.temperature"]
    )
    assert out.columns[:4] == ["topic", "year", "month", "day"]
    assert rows(out, "device_id", "partition_date") == [
        ("device_001", None),
        ("device_001", date(2024, 5, 6)),
    ]


def test_clean_topic_without_a_device_field(spark):
    event = {"user_id": "u", "event_type": "login", "timestamp": READING["timestamp"]}
    df = bronze(spark, event, topic="events.user")
    assert clean_topic(df, "events.user", PAYLOADS["events.user"]).count() == 1


def test_partition_date(spark):
    df = spark.createDataFrame([("2024-05-06T23:59:59+00:00",)], "timestamp STRING")
    assert add_partition_date(df).first().partition_date == date(2024, 5, 6)


PAYLOAD_ROWS = {
    "sensors.temperature": READING,
    "sensors.air_quality": {"pm25": 5.5, "pm10": 10.0, "co2": 300, "aqi": 1},
    "sensors.motion": {"motion_detected": True, "confidence": 0.7, "battery_level": 10},
    "sensors.smart_meter": {
        "power_consumption": 0.5, "voltage": 220.0, "current": 0.1, "unit": "kWh",
    },
    "sensors.vehicle": {
        "vehicle_id": "v", "speed": 1.0, "fuel_level": 10.0, "engine_temp": 80.0, "mileage": 1000,
    },
    "sensors.weather": {
        "temperature": -10.0, "pressure": 980.0, "wind_speed": 0.0, "wind_direction": 360,
        "precipitation": 0.5,
    },
    "events.user": {
        "user_id": "u", "session_id": "s", "event_type": "login", "ip_address": "192.0.2.7",
        "user_agent": "a", "page": "/p", "country": "FR", "device_type": "mobile",
    },
    "financial.transactions": {
        "transaction_id": "t", "account_id": "a", "amount": 1.0, "currency": "EUR",
        "transaction_type": "debit", "merchant": "m", "category": "food", "location": "Lyon",
    },
}


@pytest.mark.parametrize("topic", list(PAYLOADS))
def test_each_payload_kind(spark, topic):
    df = spark.createDataFrame(
        [(json.dumps(PAYLOAD_ROWS[topic]), topic), ("{}", "other")], "value STRING, topic STRING"
    )
    decoded = decode_by_topic(df)[topic].collect()
    assert len(decoded) == 1
    row = decoded[0].asDict(recursive=True)
    for name, value in PAYLOAD_ROWS[topic].items():
        assert row[name] == value, name


def test_split_corrupt_of_a_payload(spark):
    df = spark.createDataFrame(
        [('{"k": 1}',), ('{"k": "x"}',), ("no json",)], "value STRING"
    )
    decoded = decode_payload(df, "k BIGINT", keep_corrupt=True)
    good, bad = split_corrupt(decoded, "data._corrupt_record")
    assert [r.data.asDict() for r in good.collect()] == [{"k": 1}]
    assert sorted(r.data["_corrupt_record"] for r in bad.collect()) == ["no json", '{"k": "x"}']


def test_message_key(spark):
    df = spark.createDataFrame(
        [('{"timestamp": "t", "device_id": "d", "x": 1}',), ('{"device_id": "d"}',)],
        "value STRING",
    )
    keys = [r[0] for r in df.select(message_key(["device_id", "timestamp"])).collect()]
    assert keys == ['{"device_id":"d","timestamp":"t"}', '{"device_id":"d"}']


def test_inferred_schemas(spark):
    df = spark.createDataFrame(
        [
            ("a", '{"n": 1, "x": 1.5, "OBJECT<": {"in side": [1, 2.5]}}'),
            ("a", '{"n": 2, "late": true, "none": null}'),
            ("a", "no json"),
            ("b", '{"n": "text"}'),
            ("b", '{"n": 3}'),
            ("c", "[1, 2]"),
        ],
        "topic STRING, value STRING",
    )
    found = {t: s.simpleString() for t, s in infer_schemas(df, ["a", "b", "c"]).items()}
    assert found == {
        "a": "struct<OBJECT<:struct<in side:array<double>>,late:boolean,n:bigint,none:string,x:double>",
        "b": "struct<n:string>",
    }
    decoded = decode_by_topic(df, infer_schemas(df, ["a", "b"]))
    assert sorted(r.n for r in decoded["b"].collect()) == ["3", "text"]
