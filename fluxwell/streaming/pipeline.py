"""The streaming job: land every payload once, then feed queues and window aggregates.

``land`` parses and validates each payload once and appends valid rows and dead letters to
one table through Spark's exactly-once file sink. Everything else reads that table as a
stream, with only the columns it needs, and owns its checkpoint. Nothing is cached between
sinks, so a lost executor costs a task retry and no more.

The watermark follows validation: a message with a bad or future time cannot push it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fluxwell.operators import metrics, partials, route
from fluxwell.operators.aggregate import window_metrics
from fluxwell.operators.partials import Metrics
from fluxwell.plans.batch import judge
from fluxwell.schema import DEAD, VALID, WATERMARK_DELAY, WINDOW_METRICS, WINDOWS
from fluxwell.sources.tables import dlq_of, raw_of, read_landed
from fluxwell.streaming import sinks

AVAILABLE_NOW = {"availableNow": True}


def with_event_time(frame: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Event time with a bounded-disorder watermark; a missing time counts as now."""
    timed = frame.withColumn("time", F.coalesce("time", F.current_timestamp()))
    return timed.withWatermark("time", delay)


def start_land(
    payloads: DataFrame,
    path: str,
    checkpoint: str,
    as_of=None,
    profile: str = "standard",
    failed_at=None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Parse, validate and append every payload to the landed table, counting on the way."""
    judged = metrics.observe(judge(payloads, as_of, profile, pinned=False))
    return (
        route.outcomes(judged, failed_at)
        .writeStream.queryName("land")
        .format("parquet")
        .partitionBy("outcome", "date")
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint}/land")
        .trigger(**(trigger or sinks.SINK_POLICY["raw_telemetry"].trigger))
        .start()
    )


def start_json(
    spark: SparkSession,
    landed: str,
    outcome: str,
    checkpoint: str,
    format: str = "text",
    path: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Emit landed rows of one outcome as JSON messages to a queue or text folder."""
    rows = read_landed(spark, landed, streaming=True).where(F.col("outcome") == outcome)
    messages = route.valid_json(rows) if outcome == VALID else route.dlq_json(rows)
    table = "raw_telemetry" if outcome == VALID else "dlq_records"
    name = f"{outcome}-json"
    writer = (
        messages.writeStream.queryName(name)
        .format(format)
        .options(**options)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**(trigger or sinks.SINK_POLICY[table].trigger))
    )
    return writer.option("path", path).start() if path else writer.start()


def start_jdbc(
    spark: SparkSession,
    landed: str,
    outcome: str,
    checkpoint: str,
    url: str,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Append landed rows of one outcome to a relational table."""
    rows = read_landed(spark, landed, streaming=True)
    table = "raw_telemetry" if outcome == VALID else "dlq_records"
    picked = (raw_of(rows) if outcome == VALID else dlq_of(rows)).drop("date")
    return (
        picked.writeStream.queryName(f"{outcome}-jdbc")
        .foreachBatch(sinks.jdbc_batch(url, table, **options))
        .option("checkpointLocation", f"{checkpoint}/{outcome}-jdbc")
        .trigger(**(trigger or sinks.SINK_POLICY[table].trigger))
        .start()
    )


def start_aggregates(
    valid: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "1m",
    delay: str = WATERMARK_DELAY,
    trigger: dict | None = None,
    windows: dict[str, str] = WINDOWS,
    statistics: Metrics = WINDOW_METRICS,
) -> StreamingQuery:
    """Write each window once, when the watermark passes its end.

    Rows for a closed window are dropped here (they stay in the table); ``reconcile`` finds
    them and repairs their windows, and reads the windows that are still open.
    """
    needed = valid.select("time", "pump_id", *partials.columns(statistics))
    closed = window_metrics(with_event_time(needed, delay), size, statistics, windows)
    return (
        closed.writeStream.queryName(f"agg-{size}")
        .outputMode("append")
        .foreachBatch(lambda batch, batch_id: sinks.write_aggregates(batch, path, size))
        .option("checkpointLocation", f"{checkpoint}/agg-{size}")
        .trigger(**(trigger or sinks.SINK_POLICY["aggregated_metrics"].trigger))
        .start()
    )


def landed_valid(spark: SparkSession, landed: str, max_files: int | None = None) -> DataFrame:
    """Valid landed rows as a stream; ``max_files`` bounds what one micro-batch admits."""
    return read_landed(spark, landed, streaming=True, max_files=max_files).where(F.col("outcome") == VALID)


def start_pipeline(
    payloads: DataFrame,
    root: str,
    checkpoint: str,
    as_of=None,
    profile: str = "standard",
    failed_at=None,
    windows: dict[str, str] = WINDOWS,
    trigger: dict | None = None,
) -> dict[str, StreamingQuery]:
    """Start all queries under ``root``; query names and checkpoints are fixed.

    With an ``availableNow`` trigger each stage is run to its end before the next starts.
    """
    spark = payloads.sparkSession
    landed, aggregates = f"{root}/landed", f"{root}/aggregated_metrics"
    bounded = bool(trigger and trigger.get("availableNow"))
    running: dict[str, StreamingQuery] = {}

    def add(name: str, query: StreamingQuery) -> None:
        running[name] = query
        if bounded:
            query.awaitTermination()

    _make_folder(spark, landed)
    add("land", start_land(payloads, landed, checkpoint, as_of, profile, failed_at, trigger))
    for outcome in (VALID, DEAD):
        out = f"{root}/{outcome}_json"
        add(f"{outcome}-json", start_json(spark, landed, outcome, checkpoint, path=out, trigger=trigger))
    for size in windows:
        stream = landed_valid(spark, landed)
        add(f"agg-{size}", start_aggregates(stream, aggregates, checkpoint, size, trigger=trigger, windows=windows))
    return running


def _make_folder(spark: SparkSession, path: str) -> None:
    """A streaming reader wants its folder to exist before the first file lands."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
