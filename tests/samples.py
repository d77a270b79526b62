"""A valid message and a way to change it."""

from __future__ import annotations

import copy
import json
from datetime import datetime, timedelta

AS_OF = datetime(2024, 3, 1, 12, 0, 0)
ABSENT = object()


def at(**delta) -> str:
    return (AS_OF + timedelta(**delta)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def message(changes: dict | None = None) -> dict:
    base = {
        "pump_id": "PUMP_417",
        "timestamp": at(seconds=-20),
        "location": {"latitude": 47.5, "longitude": 8.25, "region": "Foothill"},
        "solar_panel": {
            "irradiance_w_m2": 615.25,
            "voltage_v": 38.75,
            "current_a": 6.5,
            "power_w": 251.875,
            "temperature_c": 33.5,
        },
        "pump": {
            "motor_voltage_v": 36.25,
            "motor_current_a": 5.75,
            "rpm": 1840,
            "flow_rate_lpm": 87.5,
            "discharge_pressure_bar": 4.25,
            "suction_pressure_bar": 0.75,
            "water_temperature_c": 17.5,
        },
        "system": {"operating_hours": 6020.25, "vibration_mm_s": 1.375, "error_code": 0, "status": "OPERATIONAL"},
        "environment": {"ambient_temperature_c": 21.5, "humidity_percent": 43.0},
    }
    out = copy.deepcopy(base)
    for path, value in (changes or {}).items():
        *parents, leaf = path.split(".")
        target = out
        for name in parents:
            target = target[name]
        if value is ABSENT:
            del target[leaf]
        else:
            target[leaf] = value
    return out


def payload(changes: dict | None = None) -> str:
    return json.dumps(message(changes))
