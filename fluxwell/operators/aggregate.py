"""Tumbling-window statistics per pump; the same code serves batch and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.operators import partials
from fluxwell.operators.partials import Metrics
from fluxwell.schema import WINDOW_METRICS, WINDOWS


def window_metrics(
    valid: DataFrame,
    size: str = "1m",
    metrics: Metrics = WINDOW_METRICS,
    windows: dict[str, str] = WINDOWS,
) -> DataFrame:
    """Statistics of each metric per pump and window, with a row count.

    A metric is a column, which gets its average, maximum and minimum, or a column with a
    list of ``partials.STATS``. Partial aggregation runs before the shuffle, so a pump
    holding a large share of the rows sends one row per window and task. On a stream the
    state of a window is these few numbers, not its rows.
    """
    grouped = valid.groupBy("pump_id", F.window("time", windows[size]).alias("w")).agg(
        *partials.make(metrics), F.count(F.lit(1)).alias("record_count")
    )
    timed = grouped.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")})
    return finished(timed, size, metrics)


def finished(grouped: DataFrame, size: str, metrics: Metrics = WINDOW_METRICS) -> DataFrame:
    """Windows with their statistics from windows with their partials."""
    return grouped.select(
        "window_start",
        "window_end",
        F.lit(size).alias("window_size"),
        "pump_id",
        *partials.finish(metrics),
        "record_count",
    )


UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(interval: str) -> int:
    """Length of a window such as ``5 minutes``."""
    number, unit = interval.split()
    return int(number) * UNITS[unit.lower().rstrip("s")]


def window_metrics_all(
    valid: DataFrame,
    metrics: Metrics = WINDOW_METRICS,
    windows: dict[str, str] = WINDOWS,
) -> DataFrame:
    """All window sizes from one scan (batch): coarser windows are built from the finest.

    Sizes must be listed finest first and each must be a multiple of the first. Partials
    are carried unrounded, so the result equals aggregating the rows for every size. All
    sizes read the same shuffled partials.
    """
    sizes = list(windows)
    for size in sizes[1:]:
        if seconds(windows[size]) % seconds(windows[sizes[0]]):
            raise ValueError(f"{windows[size]} is no multiple of {windows[sizes[0]]}")
    finest = valid.groupBy("pump_id", F.window("time", windows[sizes[0]])["start"].alias("t")).agg(
        *partials.make(metrics), F.count(F.lit(1)).alias("record_count")
    )
    return reduce(
        DataFrame.unionByName,
        [_coarsen(finest, size, windows[size], metrics, regroup=size != sizes[0]) for size in sizes],
    )


def _coarsen(finest: DataFrame, size: str, length: str, metrics: Metrics, regroup: bool) -> DataFrame:
    frame = finest
    if regroup:
        micros = seconds(length) * 1_000_000
        start = F.expr(f"timestamp_micros(unix_micros(t) - pmod(unix_micros(t), {micros}))")
        frame = finest.groupBy("pump_id", start.alias("t")).agg(
            *partials.merge(metrics), F.sum("record_count").alias("record_count")
        )
    end = F.col("t") + F.expr(f"INTERVAL '{length}'")
    return finished(frame.withColumns({"window_start": F.col("t"), "window_end": end}), size, metrics)
