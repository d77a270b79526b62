"""Data-quality reports over valid rows and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp
from fluxwell.plans.ops import window_bounds
from fluxwell.sources.tables import since, time_range

_T = "error_timestamp"


def success_rate(raw: DataFrame, dlq: DataFrame, as_of=None, lookback: str = "1 hour") -> DataFrame:
    """Valid share of all messages, 1.0 when there are none; each table is read once."""
    flags = (
        since(raw, "time", as_of, lookback)
        .select(F.lit(1).alias("valid"))
        .unionByName(since(dlq, _T, as_of, lookback).select(F.lit(0).alias("valid")))
    )
    share = F.avg(F.col("valid").cast("double"))
    return flags.agg(share.alias("x")).select(
        as_timestamp(as_of).alias("time"), F.coalesce("x", F.lit(1.0)).alias("success_rate")
    )


def valid_count(raw: DataFrame, as_of=None, lookback: str = "1 hour") -> DataFrame:
    recent = since(raw, "time", as_of, lookback)
    return recent.agg(F.count(F.lit(1)).alias("n")).select(
        as_timestamp(as_of).alias("time"), F.col("n").alias("valid")
    )


def dlq_count(dlq: DataFrame, as_of=None, lookback: str = "1 hour") -> DataFrame:
    recent = since(dlq, _T, as_of, lookback)
    return recent.agg(F.count(F.lit(1)).alias("n")).select(
        as_timestamp(as_of).alias("time"), F.col("n").alias("dlq")
    )


def dlq_per_minute(dlq: DataFrame, as_of=None, lookback: str | None = "1 hour", start=None, end=None) -> DataFrame:
    """Dead letters per minute; minutes without any are absent. Without a ``lookback`` and bounds: of the whole table."""
    low, high = (start, end) if lookback is None else window_bounds(as_of, lookback, start, end)
    return (
        time_range(dlq, _T, low, high)
        .groupBy(F.date_trunc("minute", _T).alias("time"))
        .agg(F.count(F.lit(1)).alias("dlq_messages"))
        .orderBy("time")
    )


def error_types(dlq: DataFrame, as_of=None, lookback: str = "1 hour") -> DataFrame:
    """Dead letters per error type with their percentage, most frequent first."""
    counts = (
        since(dlq, _T, as_of, lookback).groupBy("error_type").agg(F.count(F.lit(1)).alias("value"))
    )
    total = counts.agg(F.sum("value").alias("total")).scalar()
    return counts.select(
        F.col("error_type").alias("metric"), "value", (F.col("value") * 100.0 / total).alias("percent")
    ).orderBy(F.desc("value"), "metric")


def freshness(raw: DataFrame, as_of=None) -> DataFrame:
    """Age of the newest reading per pump, oldest first.

    ``region`` and ``last_status`` are the largest texts, not the latest; ``true_status``
    is the latest. Readings are reduced per pump, region and status by a hash aggregate
    before the text maxima, which need sorting, see them.
    """
    now = as_timestamp(as_of)
    small = raw.groupBy("pump_id", "region", "status").agg(F.max("time").alias("t"))
    age = (F.unix_micros(now) - F.unix_micros("last_seen")) / 1_000_000
    return (
        small.groupBy("pump_id")
        .agg(
            F.max("t").alias("last_seen"),
            F.max("region").alias("region"),
            F.max("status").alias("last_status"),
            F.max(F.struct("t", "status"))["status"].alias("true_status"),
        )
        .select(
            "pump_id",
            "last_seen",
            F.round(age).cast("int").alias("seconds_since_last"),
            "region",
            "last_status",
            "true_status",
        )
        .orderBy(F.desc("seconds_since_last"), "pump_id")
    )


def recent_dlq(dlq: DataFrame, n: int = 10, payload_chars: int | None = 500) -> DataFrame:
    """Newest dead letters, payload cut for display, or whole without ``payload_chars``."""
    payload = F.left("original_payload", F.lit(payload_chars)) if payload_chars else F.col("original_payload")
    return (
        dlq.orderBy(F.desc(_T), "pump_id", "error_type", "error_reason", "original_payload")
        .limit(n)
        .select(
            _T,
            "pump_id",
            "error_type",
            "error_reason",
            payload.alias("original_payload"),
        )
    )


def error_reasons(dlq: DataFrame, as_of=None, lookback: str = "1 hour") -> DataFrame:
    """Dead letters per reason and type, most frequent first."""
    return (
        since(dlq, _T, as_of, lookback)
        .groupBy("error_reason", "error_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "error_reason", "error_type")
    )
