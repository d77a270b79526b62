"""Operations reports over the telemetry table. ``raw`` is ``Tables.raw``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp, interval
from fluxwell.functions.rounding import round_numeric
from fluxwell.plans.analytics import litres
from fluxwell.sources.tables import since, time_range

# --- Fixed values: columns of the latest-status report --------------------------------------
LATEST_COLUMNS = [
    "pump_id",
    "latitude",
    "longitude",
    "region",
    "status",
    "error_code",
    "flow_rate_lpm",
    "solar_power_w",
    "time",
]


#: Ranges of ids that a stacked total is cut into.
STACK_BLOCKS = 64


def window_bounds(as_of=None, lookback: str = "1 hour", start=None, end=None):
    """The selected dashboard range: explicit bounds, or the last ``lookback``."""
    now = as_timestamp(as_of)
    return (
        now - interval(lookback) if start is None else as_timestamp(start),
        now if end is None else as_timestamp(end),
    )


def pumps_online(raw: DataFrame, as_of=None, lookback: str = "5 minutes", approximate: bool = False) -> DataFrame:
    """Pumps heard from lately; ``approximate`` trades the shuffle for a small error."""
    count = F.approx_count_distinct("pump_id") if approximate else F.countDistinct("pump_id")
    recent = since(raw, "time", as_of, lookback)
    return recent.agg(count.alias("pumps_online")).select(as_timestamp(as_of).alias("time"), "pumps_online")


def water_today(raw: DataFrame, as_of=None) -> DataFrame:
    """Litres since the start of the UTC day; NULL when there is no reading."""
    start = F.date_trunc("day", as_timestamp(as_of))
    today = time_range(raw, "time", start=start, open_start=True)
    return today.agg(F.sum(litres()).alias("x")).select(
        as_timestamp(as_of).alias("time"), round_numeric(F.col("x"), 1).alias("litres_today")
    )


def avg_solar_power(raw: DataFrame, as_of=None, lookback: str = "5 minutes") -> DataFrame:
    recent = since(raw, "time", as_of, lookback)
    return recent.agg(F.avg("solar_power_w").alias("x")).select(
        as_timestamp(as_of).alias("time"), round_numeric(F.col("x"), 1).alias("avg_solar_power")
    )


def latest_status(raw: DataFrame, as_of=None, lookback: str = "5 minutes") -> DataFrame:
    """Newest reading of each pump; equal times are settled by the other columns."""
    order = ["time"] + [c for c in LATEST_COLUMNS if c not in ("time", "pump_id")]
    newest = (
        since(raw, "time", as_of, lookback)
        .groupBy("pump_id")
        .agg(F.max(F.struct(*order)).alias("last"))
    )
    return newest.select("pump_id", "last.*").select(*LATEST_COLUMNS).orderBy("pump_id")


def flow_timeseries(raw: DataFrame, stat: str = "avg", as_of=None, lookback: str = "1 hour", start=None, end=None) -> DataFrame:
    """Flow per pump and minute: ``avg`` or ``sum``."""
    low, high = window_bounds(as_of, lookback, start, end)
    fn = {"avg": F.avg, "sum": F.sum}[stat]
    return (
        time_range(raw, "time", low, high)
        .groupBy(F.date_trunc("minute", "time").alias("time"), "pump_id")
        .agg(fn("flow_rate_lpm").alias("flow_rate"))
        .orderBy("time", "pump_id")
    )


def id_bounds(ids: DataFrame, column: str, blocks: int = STACK_BLOCKS) -> list[str]:
    """Ids that cut the sorted ids of a frame into about ``blocks`` even ranges.

    They come from the ``16 * blocks`` ids of smallest hash, which is all that reaches the driver, whatever the ids look
    like; the same ids always give the same bounds.
    """
    drawn = ids.where(F.col(column).isNotNull()).select(column).distinct().orderBy(F.xxhash64(column), column).limit(16 * blocks)
    sample = sorted((row[0] for row in drawn.collect()), key=str.encode)
    return [sample[len(sample) * k // blocks] for k in range(1, blocks)] if len(sample) >= 16 * blocks else []


def flow_stacked(raw: DataFrame, as_of=None, lookback: str = "1 hour", start=None, end=None, blocks: int = STACK_BLOCKS) -> DataFrame:
    """Flow per pump and minute with the running total over pumps in id order.

    A minute can hold the whole fleet, so the running total has two levels: pumps of one range of ids are added up
    within their block, and each block is shifted by the total of the blocks before it. Ranges are cut at sampled ids,
    so blocks are even also when ids share a long prefix; a small fleet is one block. Null ids come first.
    """
    low, high = window_bounds(as_of, lookback, start, end)
    flows = (
        time_range(raw, "time", low, high)
        .groupBy(F.date_trunc("minute", "time").alias("time"), "pump_id")
        .agg(F.sum("flow_rate_lpm").alias("flow_rate"))
    )
    bounds = F.array(*map(F.lit, id_bounds(time_range(raw, "time", low, high), "pump_id", blocks))).cast("array<string>")
    block = F.size(F.filter(bounds, lambda b: b <= F.col("pump_id")))
    flows = flows.withColumn("block", F.coalesce(block, F.lit(0)))
    inner = Window.partitionBy("time", "block").orderBy("pump_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy("time").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        flows.groupBy("time", "block")
        .agg(F.sum("flow_rate").alias("b"))
        .select("time", "block", F.coalesce(F.sum("b").over(earlier), F.lit(0.0)).alias("offset"))
    )
    within = flows.withColumn("inner", F.sum("flow_rate").over(inner))
    return (
        within.join(offsets, ["time", "block"])
        .select("time", "pump_id", "flow_rate", (F.col("offset") + F.col("inner")).alias("stacked"))
        .orderBy("time", "pump_id")
    )


def error_distribution(raw: DataFrame, as_of=None, lookback: str = "15 minutes") -> DataFrame:
    """Readings per error code, sorted by the label text."""
    code = F.col("error_code")
    label = F.when(code == 0, F.lit("No Error (0)")).otherwise(F.concat(F.lit("Error "), code.cast("string")))
    return (
        since(raw, "time", as_of, lookback)
        .groupBy("error_code")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(label.alias("error_code"), "count")
        .orderBy("error_code")
    )


def solar_timeseries(raw: DataFrame, as_of=None, lookback: str = "1 hour", start=None, end=None) -> DataFrame:
    """Fleet-wide average irradiance and solar power per minute."""
    low, high = window_bounds(as_of, lookback, start, end)
    return (
        time_range(raw, "time", low, high)
        .groupBy(F.date_trunc("minute", "time").alias("time"))
        .agg(
            F.avg("irradiance_w_m2").alias("avg_irradiance_w_m2"),
            F.avg("solar_power_w").alias("avg_solar_power_w"),
        )
        .orderBy("time")
    )


def underperforming(raw: DataFrame, as_of=None, lookback: str = "15 minutes", n: int = 10) -> DataFrame:
    """Pumps with the least average flow; ties go to the smaller pump id.

    Text maxima cannot live in a hash aggregate, so region is first made a grouping key
    and the maximum taken over the few rows left per pump.
    """
    per_region = (
        since(raw, "time", as_of, lookback)
        .groupBy("pump_id", "region")
        .agg(
            F.sum("flow_rate_lpm").alias("f"),
            F.count("flow_rate_lpm").alias("fn"),
            F.sum("solar_power_w").alias("s"),
            F.count("solar_power_w").alias("sn"),
            F.max("error_code").alias("e"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    mean = lambda total, count: round_numeric(F.try_divide(F.sum(total), F.sum(count)), 2)
    return (
        per_region.groupBy("pump_id")
        .agg(
            mean("f", "fn").alias("avg_flow_rate"),
            mean("s", "sn").alias("avg_solar_power"),
            F.max("e").alias("last_error_code"),
            F.sum("n").alias("readings"),
            F.max("region").alias("region"),
        )
        .orderBy("avg_flow_rate", "pump_id")
        .limit(n)
    )
