"""Last-step shaping of report results: bands, display names, wide series, single values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: band of a value; a band starts at its limit, the first has none -------
THRESHOLDS: dict[str, list[tuple[float | None, str]]] = {
    "success_rate": [(None, "red"), (0.9, "yellow"), (0.95, "green")],
    "dlq_count": [(None, "green"), (10, "yellow"), (50, "red")],
    "valid_count": [(None, "green")],
    "seconds_since_last": [(None, "green"), (30, "yellow"), (120, "red")],
    "reason_count": [(None, "green"), (5, "yellow"), (20, "red")],
    "pumps_online": [(None, "red"), (1, "yellow"), (2, "green")],
    "litres_today": [(None, "blue")],
    "avg_solar_power": [(None, "dark-red"), (50, "orange"), (150, "green")],
    "avg_flow_rate": [(None, "red"), (20, "yellow"), (50, "green")],
    "map_error_code": [(None, "green"), (1, "yellow"), (2, "red")],
    "queue_depth": [(None, "green"), (1000, "yellow"), (5000, "red")],
    "queue_gauge": [(None, "green"), (500, "yellow"), (2000, "red")],
    "dlq_depth": [(None, "green"), (1, "red")],
    "target_up": [(None, "red"), (1, "green")],
    "jobs_running": [(None, "red"), (1, "green")],
    "jobs_failed": [(None, "green"), (1, "red")],
    "active_threads": [(None, "red"), (1, "green")],
}

# --- Fixed values: display text and colour of a value -------------------------------------
VALUE_MAPS: dict[str, dict[str, tuple[str, str]]] = {
    "error_type": {
        "SCHEMA": ("SCHEMA", "orange"),
        "RANGE": ("RANGE", "yellow"),
        "TIMESTAMP": ("TIMESTAMP", "purple"),
        "DESERIALIZATION_ERROR": ("DESER", "red"),
        "PROCESSING_ERROR": ("PROC", "dark-red"),
    },
    "target_up": {"0": ("DOWN", "red"), "1": ("UP", "green")},
}


def band(value: Column, steps: str | list[tuple[float | None, str]]) -> Column:
    """Colour of the highest step whose limit the value reaches; NULL stays NULL."""
    table = THRESHOLDS[steps] if isinstance(steps, str) else steps
    chain = None
    for limit, colour in sorted((s for s in table if s[0] is not None), key=lambda s: -s[0]):
        reached = value >= F.lit(limit)
        chain = F.when(reached, colour) if chain is None else chain.when(reached, colour)
    base = next((colour for limit, colour in table if limit is None), None)
    rest = F.lit(base)
    return F.when(value.isNotNull(), rest if chain is None else chain.otherwise(rest))


def value_map(value: Column, mapping: str | dict[str, tuple[str, str]], part: str = "text") -> Column:
    """Display text (or ``part="color"``) of a value; an unmapped value shows as itself."""
    table = VALUE_MAPS[mapping] if isinstance(mapping, str) else mapping
    at = 0 if part == "text" else 1
    key = value.cast("string")
    pairs = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, v[at])])
    found = F.try_element_at(pairs, key)
    return F.coalesce(found, key) if part == "text" else found


def to_series(frame: DataFrame, time: str, key: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Long rows to one column per key.

    Give ``keys`` when they are known. Otherwise Spark first lists them, and refuses more
    than spark.sql.pivotMaxValues of them: a wide result is for a chart, not for a fleet.
    """
    grouped = frame.groupBy(time)
    pivot = grouped.pivot(key, keys) if keys else grouped.pivot(key)
    return pivot.agg(F.max(value))


def reduce(frame: DataFrame, value: str, calc: str = "lastNotNull", time: str = "time") -> DataFrame:
    """A series to one value: its last non-null value by time (of equal times the largest value), or its sum."""
    if calc == "lastNotNull":
        present = frame.where(F.col(value).isNotNull())
        return present.agg(F.max_by(F.col(value), F.struct(time, value)).alias(value))
    if calc == "sum":
        return frame.agg(F.sum(value).alias(value))
    raise ValueError(f"unknown reduction {calc!r}")
