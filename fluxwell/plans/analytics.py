"""Ad-hoc questions over the telemetry table. ``raw`` is ``Tables.raw``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp, interval
from fluxwell.functions.rounding import round_numeric
from fluxwell.schema import SAMPLING_SECONDS
from fluxwell.sources.tables import since


def litres(flow: str = "flow_rate_lpm"):
    """Water per reading: flow per minute over one sampling interval."""
    return F.col(flow) * (SAMPLING_SECONDS / 60.0)


def top_water_delivery(raw: DataFrame, as_of=None, lookback: str = "24 hours", n: int = 10) -> DataFrame:
    """Pumps that delivered most water; ties go to the smaller pump id."""
    total = (
        since(raw, "time", as_of, lookback, inclusive=True)
        .groupBy("pump_id")
        .agg(F.sum(litres()).alias("litres"))
    )
    return (
        total.select(
            "pump_id",
            round_numeric(F.col("litres"), 2).alias("total_liters"),
            round_numeric(F.col("litres") / 1000.0, 2).alias("cubic_meters"),
        )
        .orderBy(F.desc("total_liters"), "pump_id")
        .limit(n)
    )


def offline_pumps(raw: DataFrame, as_of=None, silent_for: str = "5 minutes") -> DataFrame:
    """Pumps without telemetry for longer than ``silent_for``, longest silence first.

    The reference time is the later of the clock and the newest reading. It comes from the
    per-pump result, so the table is scanned once.
    """
    last_seen = raw.groupBy("pump_id").agg(F.max("time").alias("last_seen"))
    now = as_timestamp(as_of)
    newest = last_seen.agg(F.coalesce(F.greatest(F.max("last_seen"), now), now).alias("ref"))
    inactivity = newest.scalar() - F.col("last_seen")
    return (
        last_seen.withColumn("inactivity", inactivity)
        .where(F.col("inactivity") > interval(silent_for))
        .select(
            "pump_id",
            "last_seen",
            "inactivity",
            (F.expr("extract(DAY FROM inactivity)") * 86400
             + F.expr("extract(HOUR FROM inactivity)") * 3600
             + F.expr("extract(MINUTE FROM inactivity)") * 60
             + F.expr("extract(SECOND FROM inactivity)")).cast("double").alias("inactivity_seconds"),
        )
        .orderBy(F.desc("inactivity"), "pump_id")
    )


def hourly_solar_trend(raw: DataFrame, as_of=None, lookback: str = "48 hours") -> DataFrame:
    """Average and peak solar power per pump and hour."""
    return (
        since(raw, "time", as_of, lookback, inclusive=True)
        .groupBy(F.date_trunc("hour", "time").alias("hour_bucket"), "pump_id")
        .agg(F.avg("solar_power_w").alias("a"), F.max("solar_power_w").alias("m"))
        .select(
            "hour_bucket",
            "pump_id",
            round_numeric(F.col("a"), 2).alias("avg_power_w"),
            round_numeric(F.col("m"), 2).alias("peak_power_w"),
        )
        .orderBy("hour_bucket", "pump_id")
    )


def error_code_analysis(raw: DataFrame, samples: int = 5, count: Column | None = None) -> DataFrame:
    """Abnormal readings per error code and status, with the first few pump ids.

    Readings are first reduced to one row per code, status and pump. The smallest ids then
    come from a limited ranking, which keeps ``samples`` rows per group and task before its
    shuffle; a list of all pumps of a group is never built. The ranking also orders by the
    aggregates, which changes nothing (a pump occurs once per group) but keeps both uses of
    the reduced rows alike, so the table is scanned and shuffled once. ``count`` replaces the
    count of rows where a row stands for several readings.
    """
    abnormal = raw.where((F.col("error_code") != 0) | (F.col("status") != "OPERATIONAL"))
    group = ["error_code", "status"]
    per_pump = abnormal.groupBy(*group, "pump_id").agg(
        (F.count(F.lit(1)) if count is None else count).alias("n"), F.max("time").alias("last_seen")
    )
    totals = per_pump.groupBy(*group).agg(
        F.sum("n").alias("occurrences"), F.max("last_seen").alias("last_seen")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("pump_id", "n", "last_seen"))
    first = (
        per_pump.select(*group, "pump_id", rank.alias("r"))
        .where(F.col("r") <= samples)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list("pump_id")).alias("sample_pumps"))
    )
    t, f = totals.alias("t"), first.alias("f")
    same = F.col("t.error_code").eqNullSafe(F.col("f.error_code")) & F.col("t.status").eqNullSafe(
        F.col("f.status")
    )
    return (
        t.join(f, same)
        .select("t.error_code", "t.status", "occurrences", "sample_pumps", "last_seen")
        .orderBy(F.desc("occurrences"), "error_code", "status")
    )
