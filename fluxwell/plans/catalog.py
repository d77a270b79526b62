"""Every query by name, bound to the telemetry derived from the ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwell import fixtures
from fluxwell.functions.instants import as_timestamp, interval
from fluxwell.operators import aggregate, health, metrics, present, route
from fluxwell.operators.validate import Rule, validate
from fluxwell.plans import analytics, batch, ops, quality, rollup
from fluxwell.schema import RANGE
from fluxwell.session import require, shared_folder
from fluxwell.sources import tables
from fluxwell.streaming import pipeline, reconcile

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = fixtures.AS_OF
DAY_END = "2024-01-01 23:59:59"
NOW = pipeline.AVAILABLE_NOW


def _judged(spark: SparkSession, sf_dir: str, lookback: str | None = None, profile: str = "standard") -> DataFrame:
    since = None if lookback is None else as_timestamp(AS_OF) - interval(lookback)
    events = fixtures.events(require(spark), sf_dir)
    return validate(fixtures.messages(events, since), AS_OF, profile)


def _judged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.judge(fixtures.payloads(fixtures.events(require(spark), sf_dir)), AS_OF)


def _raw(spark: SparkSession, sf_dir: str, lookback: str | None = None) -> DataFrame:
    return route.flatten(route.split(_judged(spark, sf_dir, lookback))[0])


def _dlq(spark: SparkSession, sf_dir: str, lookback: str | None = None) -> DataFrame:
    """Dead letters fail at the time of their event, so results do not depend on the clock."""
    return route.dlq(_judged(spark, sf_dir, lookback), F.col("event_time"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.outcomes(_judged_json(spark, sf_dir), F.col("event_time"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.metric_samples(fixtures.events(require(spark), sf_dir))


def _label(frame: DataFrame, name: str) -> DataFrame:
    """Map columns do not compare across engines; show the one label by name."""
    rest = [c for c in frame.columns if c != "labels"]
    return frame.select(F.try_element_at("labels", F.lit(name)).alias(name), *rest)


def _rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Float sums depend on the order of addition in their last bits."""
    for column in columns:
        frame = frame.withColumn(column, F.round(column, digits))
    return frame


# --- ingest, validation, routing ------------------------------------------------------------


def _verdicts(judged: DataFrame) -> DataFrame:
    kind = F.when(F.col("parse_error").isNotNull(), F.lit("DESERIALIZATION_ERROR")).otherwise(
        F.coalesce("error.error_type", F.lit("OK"))
    )
    return judged.groupBy(kind.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def validate_counts(spark, sf_dir):
    return _verdicts(_judged(spark, sf_dir))


def validate_strict_counts(spark, sf_dir):
    return _verdicts(_judged(spark, sf_dir, profile="strict"))


def dead_reasons(spark, sf_dir):
    """Every reason there is, for both profiles, so that each rule is seen to fire."""
    out = None
    for profile in ("standard", "strict"):
        dead = route.dlq(_judged(spark, sf_dir, profile=profile), F.col("event_time"))
        one = dead.groupBy(F.lit(profile).alias("profile"), "error_type", "error_reason").agg(F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


#: Rules of a user: the first can't be decided where the motor stands still, the second where there is no environment.
EXTRA_RULES = (
    Rule(RANGE, "try_divide(msg.pump.flow_rate_lpm, msg.pump.rpm) > 10", "concat('flow per turn of ', msg.pump_id)", "flow per turn"),
    Rule(RANGE, "msg.environment.humidity_percent > 98", "'too humid'"),
)


def validate_extra_rules(spark, sf_dir):
    events = fixtures.events(require(spark), sf_dir)
    judged = validate(fixtures.messages(events), AS_OF, extra=EXTRA_RULES)
    kind = F.when(F.col("parse_error").isNotNull(), "DESERIALIZATION_ERROR").otherwise(F.coalesce("error.error_type", F.lit("OK")))
    reason = F.when(F.col("error.error_type") == "PROCESSING_ERROR", F.col("error.error_reason"))
    return judged.groupBy(kind.alias("verdict"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def parse_counts(spark, sf_dir):
    return _verdicts(_judged_json(spark, sf_dir))


def raw_telemetry(spark, sf_dir):
    return _raw(spark, sf_dir)


def raw_telemetry_json(spark, sf_dir):
    return route.flatten(route.split(_judged_json(spark, sf_dir))[0])


def dlq_records(spark, sf_dir):
    return _dlq(spark, sf_dir)


def dlq_records_json(spark, sf_dir):
    return route.dlq(_judged_json(spark, sf_dir), F.col("event_time"))


def landed_outcomes(spark, sf_dir):
    return (
        _landed(spark, sf_dir)
        .groupBy("outcome", F.date_format("date", "yyyy-MM-dd").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("error_reason").alias("n_dead"),
            F.count_if("has_location").alias("n_location"),
            F.count_if("has_environment").alias("n_environment"),
        )
    )


def valid_json(spark, sf_dir):
    return route.valid_json(_landed(spark, sf_dir).where(F.col("outcome") == "valid"))


def dlq_json(spark, sf_dir):
    return route.dlq_json(_dlq(spark, sf_dir))


def pipeline_counters(spark, sf_dir):
    return metrics.pipeline_counters(_judged(spark, sf_dir))


# --- windows ----------------------------------------------------------------------------------


def agg_1m(spark, sf_dir):
    return aggregate.window_metrics(_raw(spark, sf_dir), "1m")


def agg_5m(spark, sf_dir):
    return aggregate.window_metrics(_raw(spark, sf_dir), "5m")


def aggregated_metrics(spark, sf_dir):
    return aggregate.window_metrics_all(_raw(spark, sf_dir))


CUSTOM_METRICS = {
    "flow_rate": ("flow_rate_lpm", ("sum", "avg", "count", "variance", "stddev")),
    "vibration": ("vibration_mm_s", ("min", "max", "distinct")),
    "solar_power": "solar_power_w",
}


def agg_custom(spark, sf_dir):
    """Own lists of statistics, for both sizes, from one scan."""
    return aggregate.window_metrics_all(_raw(spark, sf_dir), CUSTOM_METRICS)


def agg_quantiles(spark, sf_dir):
    """How many windows have a merged median within two percent of ranks of the exact one, and all windows."""
    raw = _raw(spark, sf_dir)
    merged = aggregate.window_metrics_all(raw, {"flow": ("flow_rate_lpm", ("median",))}, {"1m": "1 minute", "1h": "1 hour"})
    hours = raw.select("pump_id", F.date_trunc("hour", "time").alias("window_start"), "flow_rate_lpm")
    met = hours.join(merged.where("window_size = '1h'"), ["pump_id", "window_start"])
    below = F.avg((F.col("flow_rate_lpm") < F.col("median_flow")).cast("double"))
    upto = F.avg((F.col("flow_rate_lpm") <= F.col("median_flow")).cast("double"))
    ranks = met.groupBy("pump_id", "window_start").agg(below.alias("low"), upto.alias("high"))
    return ranks.agg(F.count(F.lit(1)).alias("windows"), F.count_if((F.col("low") <= 0.52) & (F.col("high") >= 0.48)).alias("close"))


def _land(spark: SparkSession, root: str, source: DataFrame) -> None:
    payloads = fixtures.payloads(source)
    pipeline.start_land(payloads, f"{root}/landed", f"{root}/checkpoint", AS_OF, failed_at=F.col("event_time"), trigger=NOW).awaitTermination()


def _window_stream(spark: SparkSession, root: str, size: str, max_files: int | None = None, trigger: dict | None = None):
    valid = pipeline.landed_valid(spark, f"{root}/landed", max_files)
    return pipeline.start_aggregates(valid, f"{root}/aggregated_metrics", f"{root}/checkpoint", size, trigger=trigger or NOW)


def _stream_windows(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    """The streaming job itself over the whole table: land, then one window query; with the windows it keeps open."""
    root = shared_folder(require(spark))
    _land(spark, root, fixtures.events(spark, sf_dir, streaming=True))
    _window_stream(spark, root, size).awaitTermination()
    return reconcile.all_windows(spark, f"{root}/aggregated_metrics", f"{root}/checkpoint", size)


def stream_agg_1m(spark, sf_dir):
    return _stream_windows(spark, sf_dir, "1m")


def stream_agg_5m(spark, sf_dir):
    return _stream_windows(spark, sf_dir, "5m")


#: Events that a file of a slice should hold: a slice comes in as many files as its size wants, and as many tasks parse it.
FILE_ROWS = 25_000


def _files_a_slice(events: DataFrame) -> int:
    return max(1, ceil(events.count() / (fixtures.SLICES * FILE_ROWS)))


def _arriving(spark: SparkSession, sf_dir: str, root: str, late: bool = True):
    """Write the events slice by slice, as they arrive; yields a reader and the files of a slice after each slice."""
    events = fixtures.events(spark, sf_dir)
    files = _files_a_slice(events)
    for k in range(fixtures.SLICES):
        events.where(fixtures.arrival(events, late) == k).repartition(files).write.mode("append").parquet(f"{root}/events")
        yield spark.readStream.schema(fixtures.EVENTS_DDL), files


def _late_stream(spark: SparkSession, sf_dir: str, size: str) -> str:
    """Land and aggregate after every slice, each time from the checkpoint: rows of a later slice find closed windows."""
    root = shared_folder(require(spark))
    for reader, _ in _arriving(spark, sf_dir, root):
        _land(spark, root, reader.parquet(f"{root}/events"))
        _window_stream(spark, root, size).awaitTermination()
    return root


def late_rows(spark, sf_dir):
    """Readings that the five-minute windows lost to the watermark."""
    root = _late_stream(spark, sf_dir, "5m")
    rows = reconcile.late_rows(spark, f"{root}/landed", f"{root}/checkpoint", "5m")
    return rows.select("time", "pump_id", "flow_rate_lpm", "window_start", "watermark")


def late_windows(spark, sf_dir):
    """Five-minute windows that lost readings, with how many."""
    root = _late_stream(spark, sf_dir, "5m")
    short = reconcile.short_windows(spark, f"{root}/landed", f"{root}/aggregated_metrics", f"{root}/checkpoint", "5m")
    return short.select("window_start", "pump_id", "record_count", "stream_count", "late_count")


def stream_restart_5m(spark, sf_dir):
    """Micro-batches of a few files each, stopped on the way and started again, late rows repaired: all windows in the end."""
    root = shared_folder(require(spark))
    for reader, files in _arriving(spark, sf_dir, root):
        pass
    _land(spark, root, reader.option("maxFilesPerTrigger", files).parquet(f"{root}/events"))
    # a larger table has more files and not more micro-batches: a share is what one task a slice writes, valid or dead
    share = max(1, tables.files_of(spark, f"{root}/landed").count() // (2 * fixtures.SLICES))
    query = _window_stream(spark, root, "5m", 2 * share, {"processingTime": "0 seconds"})
    while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < 1):
        query.awaitTermination(1)
    query.stop()
    _window_stream(spark, root, "5m", share).awaitTermination()
    paths = f"{root}/landed", f"{root}/aggregated_metrics", f"{root}/checkpoint"
    reconcile.repair(spark, *paths, "5m")
    return reconcile.all_windows(spark, *paths[1:], "5m").drop("is_open")


# --- ad-hoc questions -------------------------------------------------------------------------


def q1_top_water(spark, sf_dir):
    return analytics.top_water_delivery(_raw(spark, sf_dir, "24 hours"), AS_OF)


def q2_offline(spark, sf_dir):
    return _in_micros(analytics.offline_pumps(_raw(spark, sf_dir), AS_OF))


def _in_micros(offline: DataFrame) -> DataFrame:
    """Intervals do not compare across engines; microseconds do."""
    return offline.withColumn("inactivity", F.expr("unix_micros(timestamp_micros(0) + inactivity)"))


def q3_hourly_solar(spark, sf_dir):
    return analytics.hourly_solar_trend(_raw(spark, sf_dir, "48 hours"), AS_OF)


def q4_error_codes(spark, sf_dir):
    report = analytics.error_code_analysis(_raw(spark, sf_dir))
    return report.withColumn("sample_pumps", F.array_join("sample_pumps", ","))


def q5_latest_dlq(spark, sf_dir):
    return quality.recent_dlq(_dlq(spark, sf_dir), n=1, payload_chars=None)


# --- the same answers from the day rollup -------------------------------------------------------


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the table in two halves, and bring the rollup up to date after each."""
    root = shared_folder(require(spark))
    events = fixtures.events(spark, sf_dir)
    for half in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 != 0):
        batch.land(fixtures.payloads(events.where(half)), f"{root}/landed", AS_OF, failed_at=F.col("event_time"))
        rollup.build(spark, f"{root}/landed", f"{root}/rollup")
    return rollup.read(spark, f"{root}/rollup")


def q2_offline_rollup(spark, sf_dir):
    return _in_micros(rollup.offline_pumps(_rolled(spark, sf_dir), AS_OF))


def q4_error_codes_rollup(spark, sf_dir):
    report = rollup.error_code_analysis(_rolled(spark, sf_dir))
    return report.withColumn("sample_pumps", F.array_join("sample_pumps", ","))


def d6_freshness_rollup(spark, sf_dir):
    return rollup.freshness(_rolled(spark, sf_dir), AS_OF)


def o1_pumps_by_hour(spark, sf_dir):
    """Distinct pumps of every hour: exact, and whether merged minute sketches come within three percent."""
    raw = _raw(spark, sf_dir)
    exact = raw.groupBy(F.date_trunc("hour", "time").alias("time")).agg(F.countDistinct("pump_id").alias("pumps_online"))
    merged = rollup.pumps_between(rollup.pump_sketches(raw), every="hour")
    close = F.abs(F.col("pumps") - F.col("pumps_online")) <= 0.03 * F.col("pumps_online")
    return exact.join(merged, "time").select("time", "pumps_online", close.alias("close"))


# --- operations -------------------------------------------------------------------------------


def o1_pumps_online(spark, sf_dir):
    return ops.pumps_online(_raw(spark, sf_dir, "5 minutes"), AS_OF)


def o2_water_today(spark, sf_dir):
    return ops.water_today(_raw(spark, sf_dir), DAY_END)


def o3_avg_solar(spark, sf_dir):
    return ops.avg_solar_power(_raw(spark, sf_dir, "5 minutes"), AS_OF)


def o4_latest_status(spark, sf_dir):
    return ops.latest_status(_raw(spark, sf_dir, "5 minutes"), AS_OF)


def o5_flow_avg(spark, sf_dir):
    return _rounded(ops.flow_timeseries(_raw(spark, sf_dir, "1 hour"), "avg", AS_OF), "flow_rate")


def o6_flow_sum(spark, sf_dir):
    return _rounded(ops.flow_timeseries(_raw(spark, sf_dir, "1 hour"), "sum", AS_OF), "flow_rate")


def o6_flow_stacked(spark, sf_dir):
    stacked = ops.flow_stacked(_raw(spark, sf_dir, "1 hour"), AS_OF)
    return _rounded(stacked, "flow_rate", "stacked")


def o7_error_dist(spark, sf_dir):
    return ops.error_distribution(_raw(spark, sf_dir, "15 minutes"), AS_OF)


def o8_solar_ts(spark, sf_dir):
    series = ops.solar_timeseries(_raw(spark, sf_dir, "1 hour"), AS_OF)
    return _rounded(series, "avg_irradiance_w_m2", "avg_solar_power_w")


def o9_underperforming(spark, sf_dir):
    return ops.underperforming(_raw(spark, sf_dir, "15 minutes"), AS_OF)


# --- data quality -----------------------------------------------------------------------------


def d1_success_rate(spark, sf_dir):
    """Both tables from one judged pass: the flag is all this report needs of a row."""
    judged = _judged(spark, sf_dir, "1 hour")
    valid, *_ = route.split(judged)
    report = quality.success_rate(
        valid.select("time"), route.dlq(judged, F.col("event_time")).select("error_timestamp"), AS_OF
    )
    return _rounded(report, "success_rate", digits=9)


def d2_valid(spark, sf_dir):
    return quality.valid_count(_raw(spark, sf_dir, "1 hour"), AS_OF)


def d3_dlq(spark, sf_dir):
    return quality.dlq_count(_dlq(spark, sf_dir, "1 hour"), AS_OF)


def d4_dlq_rate(spark, sf_dir):
    return quality.dlq_per_minute(_dlq(spark, sf_dir, "1 hour"), AS_OF)


def d5_error_types(spark, sf_dir):
    return _rounded(quality.error_types(_dlq(spark, sf_dir, "1 hour"), AS_OF), "percent")


def d6_freshness(spark, sf_dir):
    return quality.freshness(_raw(spark, sf_dir), AS_OF)


def d7_recent_dlq(spark, sf_dir):
    return quality.recent_dlq(_dlq(spark, sf_dir))


def d8_error_reasons(spark, sf_dir):
    return quality.error_reasons(_dlq(spark, sf_dir, "1 hour"), AS_OF)


# --- metric series ----------------------------------------------------------------------------

COUNTER, UNITS = "messages_published_total", "message_units_total"


def h_instant(spark, sf_dir):
    return _label(health.instant(_samples(spark, sf_dir), COUNTER, AS_OF), "kind")


def h_select_label(spark, sf_dir):
    picked = health.select(_samples(spark, sf_dir), "queue_messages", equals={"queue": "error"})
    return _label(picked.select("ts", "labels", "value"), "queue")


def h_select_regex(spark, sf_dir):
    picked = health.select(_samples(spark, sf_dir), "queue_messages", matches={"queue": "s.*|view"})
    return _label(picked.select("ts", "labels", "value"), "queue")


def h_range(spark, sf_dir):
    series = health.range(_samples(spark, sf_dir), "queue_messages", "2024-01-01 06:00:00", "2024-01-01 18:00:00")
    return _label(series, "queue")


def h_increase(spark, sf_dir):
    return _rounded(_label(health.increase(_samples(spark, sf_dir), COUNTER), "kind"), "value")


def h_increase_observed(spark, sf_dir):
    grown = health.increase(_samples(spark, sf_dir), COUNTER, extrapolate=False)
    return _rounded(_label(grown, "kind"), "value")


def h_rate(spark, sf_dir):
    return _rounded(_label(health.rate(_samples(spark, sf_dir), COUNTER, 60, 30), "kind"), "value")


def h_rate_per_minute(spark, sf_dir):
    rates = health.rate(_samples(spark, sf_dir), COUNTER, per_s=60, equals={"kind": "error"})
    return _rounded(_label(rates, "kind"), "value")


def h_sum_rate(spark, sf_dir):
    return _rounded(health.sum_rate(_samples(spark, sf_dir), COUNTER), "value")


def h_rate_ratio(spark, sf_dir):
    ratio = _label(health.rate_ratio(_samples(spark, sf_dir), UNITS, COUNTER), "kind")
    return _rounded(ratio, "value")


def h_summarize(spark, sf_dir):
    legend = health.summarize(health.range(_samples(spark, sf_dir), "queue_messages"))
    return _rounded(_label(legend, "queue"), "mean")


# --- presentation -----------------------------------------------------------------------------


def b_band(spark, sf_dir):
    ages = quality.freshness(_raw(spark, sf_dir), AS_OF)
    return ages.select(
        "pump_id",
        "seconds_since_last",
        present.band(F.col("seconds_since_last"), "seconds_since_last").alias("band"),
    )


def b_value_map(spark, sf_dir):
    kinds = _dlq(spark, sf_dir).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))
    kind = F.col("error_type")
    return kinds.select(
        kind,
        "n",
        present.value_map(kind, "error_type").alias("label"),
        present.value_map(kind, "error_type", "color").alias("color"),
    )


REGIONS = ["Foothill", "Lagoon", "Polder", "UNKNOWN"]


def b_pivot(spark, sf_dir):
    per_region = (
        _raw(spark, sf_dir)
        .groupBy(F.date_trunc("minute", "time").alias("time"), "region")
        .agg(F.sum("flow_rate_lpm").alias("flow_rate"))
    )
    wide = present.to_series(per_region, "time", "region", "flow_rate", REGIONS)
    wide = wide.select("time", *[F.col(r).alias(r.lower()) for r in REGIONS])
    return _rounded(wide, *[r.lower() for r in REGIONS])


def b_reduce_last(spark, sf_dir):
    return present.reduce(quality.dlq_per_minute(_dlq(spark, sf_dir), lookback=None), "dlq_messages")


def b_reduce_sum(spark, sf_dir):
    per_minute = quality.dlq_per_minute(_dlq(spark, sf_dir), lookback=None)
    return present.reduce(per_minute, "dlq_messages", "sum")


def queries() -> dict[str, Query]:
    named = [
        validate_counts, validate_strict_counts, validate_extra_rules, dead_reasons, parse_counts,
        raw_telemetry, raw_telemetry_json, dlq_records, dlq_records_json,
        landed_outcomes, valid_json, dlq_json, pipeline_counters,
        agg_1m, agg_5m, aggregated_metrics, agg_custom, agg_quantiles,
        stream_agg_1m, stream_agg_5m, late_rows, late_windows, stream_restart_5m,
        q1_top_water, q2_offline, q3_hourly_solar, q4_error_codes, q5_latest_dlq,
        q2_offline_rollup, q4_error_codes_rollup, d6_freshness_rollup, o1_pumps_by_hour,
        o1_pumps_online, o2_water_today, o3_avg_solar, o4_latest_status, o5_flow_avg,
        o6_flow_sum, o6_flow_stacked, o7_error_dist, o8_solar_ts, o9_underperforming,
        d1_success_rate, d2_valid, d3_dlq, d4_dlq_rate, d5_error_types, d6_freshness,
        d7_recent_dlq, d8_error_reasons,
        h_instant, h_select_label, h_select_regex, h_range, h_increase, h_increase_observed,
        h_rate, h_rate_per_minute, h_sum_rate, h_rate_ratio, h_summarize,
        b_band, b_value_map, b_pivot, b_reduce_last, b_reduce_sum,
    ]
    return {fn.__name__: fn for fn in named}
