"""Selectors and rates over metric samples ``(ts, metric, labels, value)``.

A series is one metric with one set of labels. Ranges are half open, ``(t - range, t]``,
and evaluation times are the multiples of ``step``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp, interval
from fluxwell.sources.tables import time_range

_SECOND = 1_000_000
STALENESS = "5 minutes"


def select(samples: DataFrame, metric: str, equals: dict[str, str] | None = None, matches: dict[str, str] | None = None) -> DataFrame:
    """Samples of a metric whose labels equal, or fully match a pattern."""
    out = samples.where(F.col("metric") == metric)
    for label, wanted in (equals or {}).items():
        out = out.where(_label(label) == wanted)
    for label, pattern in (matches or {}).items():
        out = out.where(_label(label).rlike(f"^(?:{pattern})$"))
    return out


def _label(name: str) -> Column:
    """A missing label reads as empty text."""
    return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))


def _series() -> Column:
    return F.array_sort(F.map_entries("labels")).alias("series")


def _labels() -> Column:
    return F.map_from_entries("series").alias("labels")


def instant(samples: DataFrame, metric: str, as_of=None, staleness: str = STALENESS, **labels) -> DataFrame:
    """Latest value of each series at ``as_of``; series silent for ``staleness`` are gone."""
    at = as_timestamp(as_of)
    recent = time_range(
        select(samples, metric, **labels), "ts", start=at - interval(staleness), end=at, open_start=True
    )
    return (
        recent.select(_series(), "ts", "value")
        .groupBy("series")
        .agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
        .select(_labels(), "ts", "value")
    )


def range(samples: DataFrame, metric: str, start=None, end=None, **labels) -> DataFrame:  # noqa: A001
    """All samples of a metric within ``[start, end]``."""
    return time_range(select(samples, metric, **labels), "ts", start, end).select("ts", "labels", "value")


def _evaluate(picked: DataFrame, range_s: int, step_s: int, start, end, block_s: int) -> DataFrame:
    """Per metric, series and evaluation time: what a counter did within the range.

    A running total per series, which starts over at no reset, gives the growth of any range as a difference of two
    samples: the last one before the evaluation time, and the first one of the range. A sample knows the evaluation
    times for which it is the last. For the first one, each such time becomes a mark at the start of its range, and
    marks and samples are read in order once. So rows grow with samples and evaluation times, and not with how many
    ranges hold a sample.

    A series is cut into blocks of evaluation time, so that one of any size spreads over many tasks. A sample joins
    its own block and, when a range reaches over the edge, the next one. All stages share one partitioning.
    """
    span, step = range_s * _SECOND, step_s * _SECOND
    block = max(block_s * _SECOND, span)
    if start is not None or end is not None:
        low = None if start is None else as_timestamp(start) - interval(f"{range_s} seconds")
        picked = time_range(picked, "ts", low, end, open_start=True)
    us = F.unix_micros("ts")
    blocks = F.sequence(F.floor(F.col("us") / block), F.floor((F.col("us") + span - 1) / block))
    samples = picked.select("metric", _series(), us.alias("us"), "value").select("*", F.explode(blocks).alias("block"))
    samples = samples.repartition("series", "block")
    key = ["metric", "series", "block"]
    order = Window.partitionBy(*key).orderBy("us")
    passed = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, value = F.lag("value").over(order), F.col("value")
    gain = F.when(before.isNull(), 0.0).when(value < before, value).otherwise(value - before)
    samples = samples.withColumns({"gain": gain, "number": F.row_number().over(order), "next_us": F.lead("us").over(order)})
    samples = samples.withColumn("total", F.sum("gain").over(passed))
    sample = F.struct("us", "value", "number", "total")
    samples = samples.withColumns({"this": sample, "earliest": F.first(sample).over(passed)})
    samples = samples.withColumn("next", F.lead("this").over(order))
    # evaluation times for which this sample is the last of the range
    last = F.least(F.col("us") + span, (F.col("block") + 1) * block, F.coalesce("next_us", F.lit(1 << 62))) - 1
    times = [F.ceil(F.greatest("us", F.col("block") * block) / step) * step, F.floor(last / step) * step]
    if start is not None:
        times[0] = F.greatest(times[0], F.ceil(F.unix_micros(as_timestamp(start)) / step) * step)
    if end is not None:
        times[1] = F.least(times[1], F.floor(F.unix_micros(as_timestamp(end)) / step) * step)
    samples = samples.withColumns({"first_t": times[0], "last_t": times[1]})
    every = F.when(F.col("first_t") <= F.col("last_t"), F.sequence("first_t", "last_t", F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    none = F.lit(None)
    own = F.struct(F.col("us").alias("at"), none.cast("bigint").alias("t"), none.cast("struct<us:bigint,value:double,number:int,total:double>").alias("this"), "next", "earliest")
    marks = F.transform(every, lambda t: F.struct((t - span).alias("at"), t.alias("t"), F.col("this"), none.cast("struct<us:bigint,value:double,number:int,total:double>").alias("next"), F.col("earliest")))
    marked = samples.select(*key, F.inline(F.concat(F.array(own), marks)))
    # a sample at the very start of a range lies outside it, so samples come before marks
    in_order = Window.partitionBy(*key).orderBy("at", F.col("t").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = marked.withColumn("opening", F.last(F.when(F.col("t").isNull(), F.col("next")), ignorenulls=True).over(in_order))
    met = opened.withColumn("seen", F.count(F.when(F.col("t").isNull(), 1)).over(in_order)).where("t IS NOT NULL")
    first = F.when(F.col("seen") == 0, F.col("earliest")).otherwise(F.col("opening"))
    met = met.withColumn("first", first)
    return met.select(
        *key,
        "t",
        (F.col("this.number") - F.col("first.number") + 1).alias("n"),
        F.col("first.us").alias("first_us"),
        F.col("this.us").alias("last_us"),
        F.col("first.value").alias("first"),
        (F.col("this.total") - F.col("first.total")).alias("gain"),
    )


def _increase(range_s: int, extrapolate: bool) -> Column:
    """Counter increase over the range, NULL with fewer than two samples.

    With ``extrapolate`` the observed increase is stretched to the range edges the way
    PromQL documents it: up to the edge when a sample is within 1.1 average gaps of
    it, otherwise by half a gap, and never below a counter value of zero.
    """
    gain, first = F.col("gain"), F.col("first")
    if not extrapolate:
        return F.when(F.col("n") >= 2, gain)
    sampled = (F.col("last_us") - F.col("first_us")) / _SECOND
    gap = sampled / (F.col("n") - 1)
    to_start = (F.col("first_us") - F.col("t")) / _SECOND + range_s
    to_end = (F.col("t") - F.col("last_us")) / _SECOND
    to_start = F.when(to_start >= gap * 1.1, gap / 2).otherwise(to_start)
    to_end = F.when(to_end >= gap * 1.1, gap / 2).otherwise(to_end)
    to_zero = F.when((gain > 0) & (first >= 0), sampled * first / F.when(gain > 0, gain))
    to_start = F.least(to_start, to_zero)
    return F.when(
        (F.col("n") >= 2) & (sampled > 0), gain * (sampled + to_start + to_end) / F.when(sampled > 0, sampled)
    )


def increase(
    samples: DataFrame,
    metric: str,
    range_s: int = 60,
    step_s: int = 60,
    start=None,
    end=None,
    extrapolate: bool = True,
    block_s: int = 3600,
    **labels,
) -> DataFrame:
    """Reset-aware growth of each counter series over the range ending at each step."""
    picked = select(samples, metric, **labels)
    return (
        _evaluate(picked, range_s, step_s, start, end, block_s)
        .withColumn("value", _increase(range_s, extrapolate))
        .where(F.col("value").isNotNull())
        .select(F.timestamp_micros("t").alias("ts"), _labels(), "value")
    )


def rate(samples: DataFrame, metric: str, range_s: int = 60, step_s: int = 60, per_s: int = 1, **kw) -> DataFrame:
    """Increase per second, or per ``per_s`` seconds."""
    grown = increase(samples, metric, range_s, step_s, **kw)
    return grown.withColumn("value", F.col("value") / range_s * per_s)


def sum_rate(samples: DataFrame, metric: str, range_s: int = 60, step_s: int = 60, **kw) -> DataFrame:
    """Rate added up over all series of a metric."""
    return rate(samples, metric, range_s, step_s, **kw).groupBy("ts").agg(F.sum("value").alias("value"))


def rate_ratio(
    samples: DataFrame,
    numerator: str,
    denominator: str,
    range_s: int = 300,
    step_s: int = 60,
    start=None,
    end=None,
    block_s: int = 3600,
) -> DataFrame:
    """Rate of one counter over the rate of another for equal labels and time.

    Both metrics are read in one pass and meet in the partitioning they already share,
    so there is no join. Division by zero gives an infinity or NaN, as floats do.
    """
    both = samples.where(F.col("metric").isin(numerator, denominator))
    rates = _evaluate(both, range_s, step_s, start, end, block_s).withColumn(
        "rate", _increase(range_s, True) / range_s
    )
    side = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("rate")))
    pairs = rates.groupBy("series", "block", "t").agg(side(numerator).alias("a"), side(denominator).alias("b"))
    a, b = F.col("a"), F.col("b")
    zero = F.when(a == 0, float("nan")).otherwise(F.signum(a) * float("inf"))
    return pairs.where(a.isNotNull() & b.isNotNull()).select(
        F.timestamp_micros("t").alias("ts"),
        _labels(),
        F.when(b == 0, zero).otherwise(a / F.when(b != 0, b)).alias("value"),
    )


def summarize(series: DataFrame) -> DataFrame:
    """Mean and maximum of each series, as shown in a chart legend."""
    return (
        series.select(_series(), "value")
        .groupBy("series")
        .agg(F.avg("value").alias("mean"), F.max("value").alias("max"))
        .select(_labels(), "mean", "max")
    )
