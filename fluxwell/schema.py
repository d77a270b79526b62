"""Message shape, table shapes and validation constants."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: message sections and their leaves (name, Spark type) ------------------
SECTIONS: dict[str, list[tuple[str, str]]] = {
    "location": [("latitude", "double"), ("longitude", "double"), ("region", "string")],
    "solar_panel": [
        ("irradiance_w_m2", "double"),
        ("voltage_v", "double"),
        ("current_a", "double"),
        ("power_w", "double"),
        ("temperature_c", "double"),
    ],
    "pump": [
        ("motor_voltage_v", "double"),
        ("motor_current_a", "double"),
        ("rpm", "int"),
        ("flow_rate_lpm", "double"),
        ("discharge_pressure_bar", "double"),
        ("suction_pressure_bar", "double"),
        ("water_temperature_c", "double"),
    ],
    "system": [
        ("operating_hours", "double"),
        ("vibration_mm_s", "double"),
        ("error_code", "int"),
        ("status", "string"),
    ],
    "environment": [("ambient_temperature_c", "double"), ("humidity_percent", "double")],
}
ENVELOPE: list[str] = ["pump_id", "timestamp"]


def message_ddl(number: str | None = None, integer: str | None = None, text: str | None = None) -> str:
    """DDL of the nested message; each leaf kind can be swapped for another type."""
    kinds = {"double": number or "double", "int": integer or "int", "string": text or "string"}
    parts = [f"{name} {kinds['string']}" for name in ENVELOPE]
    for section, leaves in SECTIONS.items():
        body = ", ".join(f"{leaf}: {kinds[kind]}" for leaf, kind in leaves)
        parts.append(f"{section} struct<{body}>")
    return ", ".join(parts)


# --- Fixed values: flat table column -> (message path, type, value when section absent) --
RAW_FROM_MESSAGE: list[tuple[str, str, str, object]] = [
    ("latitude", "location.latitude", "double", 0.0),
    ("longitude", "location.longitude", "double", 0.0),
    ("region", "location.region", "string", "UNKNOWN"),
    ("irradiance_w_m2", "solar_panel.irradiance_w_m2", "double", None),
    ("solar_voltage_v", "solar_panel.voltage_v", "double", None),
    ("solar_current_a", "solar_panel.current_a", "double", None),
    ("solar_power_w", "solar_panel.power_w", "double", None),
    ("solar_temperature_c", "solar_panel.temperature_c", "double", None),
    ("motor_voltage_v", "pump.motor_voltage_v", "double", None),
    ("motor_current_a", "pump.motor_current_a", "double", None),
    ("rpm", "pump.rpm", "int", None),
    ("flow_rate_lpm", "pump.flow_rate_lpm", "double", None),
    ("discharge_pressure_bar", "pump.discharge_pressure_bar", "double", None),
    ("suction_pressure_bar", "pump.suction_pressure_bar", "double", None),
    ("water_temperature_c", "pump.water_temperature_c", "double", None),
    ("operating_hours", "system.operating_hours", "double", None),
    ("vibration_mm_s", "system.vibration_mm_s", "double", None),
    ("error_code", "system.error_code", "int", None),
    ("status", "system.status", "string", None),
    ("ambient_temperature_c", "environment.ambient_temperature_c", "double", 0.0),
    ("humidity_percent", "environment.humidity_percent", "double", 0.0),
]

_SPARK_TYPES = {
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def _struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, _SPARK_TYPES[kind]) for name, kind in fields])


TELEMETRY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ENVELOPE]
    + [T.StructField(section, _struct(leaves)) for section, leaves in SECTIONS.items()]
)

# --- Fixed values: column names of the three tables ----------------------------------------
RAW_SCHEMA = _struct(
    [("time", "timestamp"), ("pump_id", "string")]
    + [(column, kind) for column, _, kind, _ in RAW_FROM_MESSAGE]
)
RAW_COLUMNS = RAW_SCHEMA.names

DLQ_SCHEMA = _struct(
    [
        ("error_timestamp", "timestamp"),
        ("pump_id", "string"),
        ("error_type", "string"),
        ("error_reason", "string"),
        ("original_payload", "string"),
    ]
)
DLQ_COLUMNS = DLQ_SCHEMA.names

AGGREGATE_SCHEMA = _struct(
    [
        ("window_start", "timestamp"),
        ("window_end", "timestamp"),
        ("window_size", "string"),
        ("pump_id", "string"),
    ]
    + [
        (f"{stat}_{name}", "double")
        for name in ("flow_rate", "solar_power", "vibration")
        for stat in ("avg", "max", "min")
    ]
    + [("record_count", "bigint")]
)
AGGREGATE_COLUMNS = AGGREGATE_SCHEMA.names
AGGREGATE_KEY = ["window_start", "pump_id", "window_size"]

# The landed table holds both outcomes of one pass over the input, split by partition.
LANDED_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [f for f in DLQ_SCHEMA.fields if f.name != "pump_id"]
    + [
        T.StructField("timestamp_text", T.StringType()),
        T.StructField("has_location", T.BooleanType()),
        T.StructField("has_environment", T.BooleanType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)
VALID, DEAD = "valid", "dlq"

METRIC_SAMPLE_DDL = "ts timestamp, metric string, labels map<string,string>, value double"

# --- Fixed values: error classes -----------------------------------------------------------
SCHEMA = "SCHEMA"
TIMESTAMP = "TIMESTAMP"
RANGE = "RANGE"
DESERIALIZATION_ERROR = "DESERIALIZATION_ERROR"
PROCESSING_ERROR = "PROCESSING_ERROR"  # raised by extra rules that can't be decided
ERROR_TYPES = [SCHEMA, TIMESTAMP, RANGE, DESERIALIZATION_ERROR, PROCESSING_ERROR]
UNKNOWN_PUMP = "UNKNOWN"
PARSE_PREFIX = "JSON parse error: "
UNDECIDED = "Unexpected processing error: undecidable "

# --- Fixed values: inclusive bounds, checked in this order --------------------------------
RANGE_BOUNDS: list[tuple[str, float, float]] = [
    ("solar_panel.irradiance_w_m2", 0.0, 1500.0),
    ("solar_panel.voltage_v", 0.0, 100.0),
    ("solar_panel.current_a", 0.0, 30.0),
    ("solar_panel.power_w", 0.0, 3000.0),
    ("solar_panel.temperature_c", -40.0, 90.0),
    ("pump.motor_voltage_v", 0.0, 100.0),
    ("pump.motor_current_a", 0.0, 30.0),
    ("pump.rpm", 0.0, 5000.0),
    ("pump.flow_rate_lpm", 0.0, 500.0),
    ("pump.discharge_pressure_bar", 0.0, 20.0),
    ("pump.suction_pressure_bar", 0.0, 20.0),
    ("pump.water_temperature_c", 0.0, 80.0),
    ("system.vibration_mm_s", 0.0, 50.0),
    ("system.operating_hours", 0.0, 100000.0),
    ("environment.ambient_temperature_c", -40.0, 60.0),
    ("environment.humidity_percent", 0.0, 100.0),
]
FUTURE_TOLERANCE_SECONDS = 60

# --- Fixed values: the optional strict profile --------------------------------------------
STRICT_PUMP_ID = r"^PUMP_\d{3,}$"
STRICT_STATUSES = ["OPERATIONAL", "STANDBY", "DEGRADED", "ALERT", "FAULTED"]
STRICT_BOUNDS: list[tuple[str, float, float]] = [
    ("location.latitude", -90.0, 90.0),
    ("location.longitude", -180.0, 180.0),
]

# --- Fixed values: windows, watermark, sampling -------------------------------------------
WINDOWS = {"1m": "1 minute", "5m": "5 minutes"}
WATERMARK_DELAY = "10 seconds"
WINDOW_METRICS = {
    "flow_rate": "flow_rate_lpm",
    "solar_power": "solar_power_w",
    "vibration": "vibration_mm_s",
}
SAMPLING_SECONDS = 5.0
