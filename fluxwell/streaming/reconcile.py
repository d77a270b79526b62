"""What a window stream has not written: windows still open, and rows and windows lost to the watermark.

Open windows lie in the query's state store, which Spark can read as a table. Late rows are found from the
query's own logs: which file came in which micro-batch, and which watermark that batch held its rows against.
Repair recomputes only the windows that lost rows. All of it reads a checkpoint of a query that is not
running a batch just then.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwell.operators import partials
from fluxwell.operators.aggregate import finished, window_metrics
from fluxwell.operators.partials import Metrics
from fluxwell.schema import AGGREGATE_COLUMNS, AGGREGATE_KEY, VALID, WINDOW_METRICS, WINDOWS
from fluxwell.sources.tables import read_landed, time_range
from fluxwell.streaming import sinks

#: Partials that the state of a window holds as one number each, with their types.
STORED = {"sum": "double", "count": "bigint", "max": "double", "min": "double"}


def open_windows(spark: SparkSession, checkpoint: str, size: str = "1m", metrics: Metrics = WINDOW_METRICS) -> DataFrame:
    """Windows that the watermark has not closed, as far as the query ``agg-size`` has counted.

    ``checkpoint`` is the root given to ``pipeline.start_aggregates``. Only statistics whose partials are plain numbers
    can be read back (``avg``, ``max``, ``min``, ``sum``, ``count`` of numeric columns).
    """
    names = [(p, name) for name, (_, stats) in partials.normalized(metrics).items() for p in partials.needed(stats)]
    unread = sorted({p for p, _ in names} - set(STORED))
    if unread:
        raise ValueError(f"the state of {unread} can't be read back")
    # the state names its fields by function only, so they are told apart by their place
    fields = ", ".join([*(f"_{p}_{name}: {STORED[p]}" for p, name in names), "record_count: bigint"])
    state = spark.read.format("statestore").load(f"{checkpoint}/agg-{size}")
    rows = state.select(
        "key.pump_id",
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value").cast(f"struct<{fields}>").alias("v"),
    ).select("pump_id", "window_start", "window_end", "v.*")
    return finished(rows, size, metrics)


def all_windows(spark: SparkSession, path: str, checkpoint: str, size: str = "1m") -> DataFrame:
    """Written windows and open ones, told apart by ``is_open``."""
    return (
        stored_windows(spark, path, size)
        .withColumn("is_open", F.lit(False))
        .unionByName(open_windows(spark, checkpoint, size).withColumn("is_open", F.lit(True)))
    )


def stored_windows(spark: SparkSession, path: str, size: str) -> DataFrame:
    """Windows of one size that a stream has written; none when it has not written yet."""
    shape = window_metrics(spark.createDataFrame([], "time timestamp, pump_id string, " + ", ".join(f"{c} double" for c in partials.columns(WINDOW_METRICS))), size)
    try:
        found = spark.read.parquet(sinks.aggregate_path(path, size))
    except AnalysisException as error:
        if not any(x in str(error) for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return shape
    return found.withColumn("window_size", F.lit(size)).select(*AGGREGATE_COLUMNS)


def batch_limits(spark: SparkSession, checkpoint: str, size: str) -> DataFrame:
    """Input files of the query ``agg-size`` with the watermark that their batch dropped late rows by.

    A batch drops by the watermark of the batch before it. Spark keeps the logs of the last
    ``spark.sql.streaming.minBatchesToRetain`` batches (100 by default): reconcile more often than that, or raise it.
    Returns ``file`` and ``limit`` (microseconds, null before the first watermark).
    """
    root = f"{checkpoint}/agg-{size}"
    line = lambda k: F.split("value", "\n")[k]
    log = spark.read.text(f"{root}/offsets", wholetext=True).select(
        F.col("_metadata.file_name").cast("long").alias("batch"),
        F.get_json_object(line(1), "$.batchWatermarkMs").cast("long").alias("watermark"),
        F.get_json_object(line(2), "$.logOffset").cast("long").alias("upto"),
    )
    # one row per kept batch, a few hundred at most
    order = Window.orderBy("batch")
    before = F.lag("watermark").over(order)
    batches = log.select(
        F.lag("upto", 1, -1).over(order).alias("above"),
        "upto",
        F.when(before > 0, before * 1000).alias("limit"),
    ).where("upto > above")
    sources = spark.read.text(f"{root}/sources/0").where(F.col("value").startswith("{"))
    files = sources.select(
        F.get_json_object("value", "$.path").alias("file"), F.get_json_object("value", "$.batchId").cast("long").alias("entry")
    ).distinct()
    spans = batches.select(F.explode(F.sequence(F.col("above") + 1, F.col("upto"))).alias("entry"), "limit")
    return files.join(spans, "entry").select("file", "limit")


def late_rows(spark: SparkSession, landed: str, checkpoint: str, size: str = "1m", windows: dict[str, str] = WINDOWS) -> DataFrame:
    """Valid landed rows that the window query ``agg-size`` dropped, as their window was closed when they came.

    Adds ``window_start``, ``window_end`` and ``watermark`` (the one they missed) to the landed columns. Only files
    whose batch had a watermark, and of those only the rows before it, go on.
    """
    limits = batch_limits(spark, checkpoint, size).where("limit IS NOT NULL")
    rows = read_landed(spark, landed).where(F.col("outcome") == VALID)
    rows = rows.withColumn("_file", _plain(F.col("_metadata.file_path")))
    limits = limits.select(_plain(F.col("file")).alias("_file"), "limit")
    w = F.window("time", windows[size])
    met = rows.join(limits, "_file").withColumn("w", w)
    return met.where(F.unix_micros(F.col("w.end")) <= F.col("limit")).select(
        *[c for c in rows.columns if c not in ("_file", "_metadata")],
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.timestamp_micros("limit").alias("watermark"),
    )


def _plain(path):
    """One spelling of a file's path: Spark writes file:/x and file:///x."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def short_windows(
    spark: SparkSession,
    landed: str,
    path: str,
    checkpoint: str,
    size: str = "1m",
    windows: dict[str, str] = WINDOWS,
    start=None,
    end=None,
) -> DataFrame:
    """Windows of which the stream has fewer rows than the landed table, in full.

    The batch build of every window is held against what the stream has written or keeps open. Returns the batch
    columns with ``stream_count`` (0 where the stream has no such window) and ``late_count``. ``start`` and ``end`` bound
    the event time, so that a run reads the days since the last one only; give whole windows.
    """
    keys = ["window_start", "pump_id"]
    valid = read_landed(spark, landed).where(F.col("outcome") == VALID)
    batch = window_metrics(time_range(valid, "time", start, end), size, windows=windows)
    known = all_windows(spark, path, checkpoint, size).select(*keys, F.col("record_count").alias("stream_count"))
    late = F.col("record_count") - F.col("stream_count")
    met = batch.join(time_range(known, "window_start", start, end), keys, "left").fillna(0, ["stream_count"])
    return met.withColumn("late_count", late).where("late_count > 0").select(*AGGREGATE_COLUMNS, "stream_count", "late_count")


def repair(
    spark: SparkSession, landed: str, path: str, checkpoint: str, size: str = "1m", windows: dict[str, str] = WINDOWS, start=None, end=None
) -> None:
    """Write the windows that lost rows anew, over the short ones; all others stay. Run it while the query is stopped."""
    short = short_windows(spark, landed, path, checkpoint, size, windows, start, end)
    rows = short.select(*AGGREGATE_COLUMNS).drop("window_size")
    keys = [k for k in AGGREGATE_KEY if k != "window_size"]
    order = [F.col("pump_id"), F.desc("window_start")]
    sinks.replace_by_key(rows, sinks.aggregate_path(path, size), keys, "window_start", ("date",), order)
