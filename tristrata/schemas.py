"""Row shapes shared by the layers, as DDL text."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

# Field names, types, topic names and seed rows of the data model.

ENVELOPE = "value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

# Bronze as it is read back from JSON: times are text, directory keys are numbers.
BRONZE = (
    "event_time STRING, ingestion_ts STRING, kafka_timestamp STRING, offset BIGINT, "
    "partition BIGINT, timestamp STRING, value STRING, year INT, month INT, day INT"
)
BRONZE_KEYS = ["topic", "year", "month", "day"]

SILVER = (
    "device_id STRING, device_ts TIMESTAMP, sensor_type STRING, latitude DOUBLE, "
    "longitude DOUBLE, city STRING, temperature DOUBLE, humidity DOUBLE, unit STRING, "
    "event_time TIMESTAMP, year INT, month INT, day INT"
)
SILVER_KEYS = ["year", "month", "day"]

_SENSOR = (
    "device_id STRING, timestamp STRING, sensor_type STRING, "
    "location STRUCT<latitude: DOUBLE, longitude: DOUBLE, city: STRING>, "
)
PAYLOADS = {
    "sensors.temperature": _SENSOR + "temperature DOUBLE, humidity DOUBLE, unit STRING",
    "sensors.air_quality": _SENSOR + "pm25 DOUBLE, pm10 DOUBLE, co2 INT, aqi INT",
    "sensors.motion": _SENSOR + "motion_detected BOOLEAN, confidence DOUBLE, battery_level INT",
    "sensors.smart_meter": _SENSOR
    + "power_consumption DOUBLE, voltage DOUBLE, current DOUBLE, unit STRING",
    "sensors.vehicle": _SENSOR
    + "vehicle_id STRING, speed DOUBLE, fuel_level DOUBLE, engine_temp DOUBLE, mileage INT",
    "sensors.weather": _SENSOR
    + "temperature DOUBLE, pressure DOUBLE, wind_speed DOUBLE, wind_direction INT, "
    "precipitation DOUBLE",
    "events.user": "user_id STRING, session_id STRING, event_type STRING, timestamp STRING, "
    "ip_address STRING, user_agent STRING, page STRING, country STRING, device_type STRING",
    "financial.transactions": "transaction_id STRING, account_id STRING, amount DOUBLE, "
    "currency STRING, transaction_type STRING, merchant STRING, category STRING, "
    "timestamp STRING, location STRING",
}

# Silver column -> where it sits in a decoded Bronze row.
TEMPERATURE_FIELDS = {
    "partition": "partition",
    "offset": "offset",
    "timestamp": "timestamp",
    "event_time": "event_time",
    "device_id": "data.device_id",
    "device_ts": "data.timestamp",
    "sensor_type": "data.sensor_type",
    "latitude": "data.location.latitude",
    "longitude": "data.location.longitude",
    "city": "data.location.city",
    "temperature": "data.temperature",
    "humidity": "data.humidity",
    "unit": "data.unit",
    "year": "year",
    "month": "month",
    "day": "day",
}

TOPIC_REGISTRY = "topic_name STRING, schema_version STRING, description STRING"
TOPIC_SEEDS = [
    ("sensors.temperature", "v1", "Temperature and humidity sensor readings"),
    ("sensors.motion", "v1", "Motion detection events"),
    ("sensors.air_quality", "v1", "Air quality measurements (PM2.5, CO2, AQI)"),
    ("sensors.smart_meter", "v1", "Power consumption readings"),
    ("events.user", "v1", "User activity events"),
    ("events.system", "v1", "System events and alerts"),
]

INGEST_TOPICS = ["sensors.temperature", "sensors.motion", "sensors.air_quality"]

# MQTT topic filter -> Kafka topic.
ROUTES = {
    "sensors/temperature/+": "sensors.temperature",
    "sensors/air_quality/+": "sensors.air_quality",
    "sensors/motion/+": "sensors.motion",
}

CORRUPT = "_corrupt_record"


def struct(schema: str | StructType) -> StructType:
    """A StructType from DDL text; a StructType passes through."""
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def with_corrupt(schema: str | StructType) -> StructType:
    """The schema plus the column in which Spark keeps text it could not parse."""
    base = struct(schema)
    if CORRUPT in base.names:
        return base
    return StructType(list(base.fields)).add(CORRUPT, "string")


def orderable(kind: DataType) -> bool:
    """Whether Spark can sort and group by values of the type."""
    if isinstance(kind, StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))
