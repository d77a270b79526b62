"""Writers: day-partitioned tables, queue messages, relational tables, keyed upserts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwell.schema import AGGREGATE_COLUMNS, AGGREGATE_KEY, DLQ_COLUMNS, RAW_COLUMNS
from fluxwell.session import shared_folder


@dataclass(frozen=True)
class Policy:
    """How much a sink collects before it writes. Task retries are Spark's own."""

    rows: int
    seconds: int

    @property
    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.seconds} seconds"}


# --- Fixed values: flush policy per table --------------------------------------------------
SINK_POLICY = {
    "raw_telemetry": Policy(rows=100, seconds=10),
    "aggregated_metrics": Policy(rows=50, seconds=15),
    "dlq_records": Policy(rows=20, seconds=5),
}



def lookup_order(table: str) -> list[Column]:
    """Sort that lets row-group statistics answer a lookup by pump or error type."""
    return {
        "raw_telemetry": [F.col("pump_id"), F.desc("time")],
        "aggregated_metrics": [F.col("pump_id"), F.col("window_size"), F.desc("window_start")],
        "dlq_records": [F.col("error_type"), F.col("pump_id"), F.desc("error_timestamp")],
        "landed": [F.col("error_type"), F.col("pump_id"), F.desc("time")],
    }[table]


def cluster_for_lookup(frame: DataFrame, table: str, *partitions: str, rebalance: bool = True) -> DataFrame:
    """Bring rows of a partition together and sort them for lookups.

    ``rebalance`` lets adaptive execution split a day that is far larger than the others
    and join small ones, so file sizes stay even under skew. It costs a shuffle: turn it
    off when each input split already holds few days.
    """
    if partitions and rebalance:
        frame = frame.hint("rebalance", *partitions)
    return frame.sortWithinPartitions(*partitions, *lookup_order(table))


def _write(frame: DataFrame, table: str, path: str, time: str, columns: list[str], mode: str, rebalance: bool) -> None:
    dated = frame.select(*columns).withColumn("date", F.to_date(time))
    cluster_for_lookup(dated, table, "date", rebalance=rebalance).write.mode(mode).partitionBy("date").parquet(path)


def write_raw(valid: DataFrame, path: str, mode: str = "append", rebalance: bool = True) -> None:
    """Batch write of flattened valid rows, one folder per day."""
    _write(valid, "raw_telemetry", path, "time", RAW_COLUMNS, mode, rebalance)


def write_dlq(dead: DataFrame, path: str, mode: str = "append", rebalance: bool = True) -> None:
    """Batch write of dead letters, one folder per day."""
    _write(dead, "dlq_records", path, "error_timestamp", DLQ_COLUMNS, mode, rebalance)


def write_landed(landed: DataFrame, path: str, mode: str = "append", rebalance: bool = True) -> None:
    """Batch write of ``route.outcomes``: both tables from one pass over the input."""
    parts = ("outcome", "date")
    cluster_for_lookup(landed, "landed", *parts, rebalance=rebalance).write.mode(mode).partitionBy(*parts).parquet(path)


def write_bucketed(frame: DataFrame, name: str, buckets: int = 64, mode: str = "overwrite", **options: str) -> None:
    """Save rows as a catalog table whose files are bucketed and sorted by pump.

    Reports per pump over such a table need no shuffle, and two of them with as many buckets join without one. The
    table's place is the warehouse, unless ``path`` is given. Rows are brought to their buckets first, so that a task
    writes one file and not one per bucket.
    """
    time = next(c for c in ("time", "window_start", "error_timestamp") if c in frame.columns)
    placed = frame.repartition(buckets, "pump_id")
    placed.write.mode(mode).options(**options).bucketBy(buckets, "pump_id").sortBy("pump_id", time).saveAsTable(name)


def write_json(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Batch write of queue messages (``value``) as text lines."""
    messages.select("value").write.mode(mode).text(path)


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Options of a relational sink, batch size taken from the flush policy."""
    rows = SINK_POLICY[table].rows if table in SINK_POLICY else 1000
    return {"url": url, "dbtable": table, "batchsize": str(rows), **extra}


def write_jdbc(frame: DataFrame, url: str, table: str, **extra: str) -> None:
    """Append to a relational table. A retried task may repeat rows, as any plain insert."""
    frame.write.format("jdbc").options(**jdbc_options(url, table, **extra)).mode("append").save()


def jdbc_batch(url: str, table: str, **extra: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends every micro-batch to a relational table."""
    return lambda batch, batch_id: write_jdbc(batch, url, table, **extra)


def upsert_by_key(
    batch: DataFrame,
    path: str,
    keys: list[str],
    time: str,
    unique: bool = False,
    partitions: tuple[str, ...] = ("date",),
    order: list[Column] | None = None,
) -> None:
    """Append the rows of a batch whose key is not in the table yet.

    Writing a batch twice, or restarting without its checkpoint, adds nothing. Only keys
    in the days and time span of the batch are read back; the span is a single row. Pass
    ``unique`` when the batch cannot hold a key twice, which saves a shuffle.

    The batch is kept while it is read more than once, because a stateful batch must not
    run twice; blocks lost with an executor are computed again from their source.
    """
    fresh = batch if unique else batch.dropDuplicates(keys)
    fresh = fresh.withColumn("date", F.to_date(time)).persist()
    try:
        low, high, first_day, last_day = fresh.agg(
            F.min(time), F.max(time), F.min("date"), F.max("date")
        ).first()
        if low is None:
            return
        try:
            known = (
                batch.sparkSession.read.schema(fresh.schema)
                .parquet(path)
                .where(F.col("date").between(F.lit(first_day), F.lit(last_day)))
                .where(F.col(time).between(F.lit(low), F.lit(high)))
                .select(*keys)
            )
            new = fresh.join(known, keys, "left_anti")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            new = fresh
        inside = order or [F.col(k) for k in keys if k not in partitions]
        new.sortWithinPartitions(*partitions, *inside).write.mode("append").partitionBy(*partitions).parquet(path)
    finally:
        fresh.unpersist()


def aggregate_path(path: str, size: str) -> str:
    """Folder of one window size. Each size has one writer, so commits cannot collide."""
    return f"{path}/window_size={size}"


def replace_by_key(rows: DataFrame, path: str, keys: list[str], time: str, partitions: tuple[str, ...], order: list[Column]) -> None:
    """Write rows of distinct keys; stored rows of the same keys give way, all others stay.

    For batch builds, whose windows may have grown since they were written. Only the partitions that ``rows``
    touch are rewritten, from a snapshot in the shared folder, as a table can't be read while it is overwritten.
    """
    spark = rows.sparkSession
    fresh = rows.withColumn("date", F.to_date(time))
    snapshot = shared_folder(spark)
    try:
        stored = spark.read.schema(fresh.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        everything = fresh
    else:
        fresh.write.parquet(f"{snapshot}/fresh")
        fresh = spark.read.schema(fresh.schema).parquet(f"{snapshot}/fresh")
        touched = fresh.select(*partitions).distinct()
        everything = fresh.unionByName(stored.join(touched, list(partitions), "left_semi").join(fresh.select(*keys), keys, "left_anti"))
    everything.write.parquet(f"{snapshot}/all")
    table = spark.read.schema(fresh.schema).parquet(f"{snapshot}/all").sortWithinPartitions(*partitions, *order)
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_all_aggregates(windows: DataFrame, path: str) -> None:
    """Write every window size of ``aggregated_metrics`` in one job; windows written before are replaced."""
    rows, order = windows.select(*AGGREGATE_COLUMNS), lookup_order("aggregated_metrics")
    replace_by_key(rows, path, AGGREGATE_KEY, "window_start", ("window_size", "date"), order)


def write_aggregates(batch: DataFrame, path: str, size: str) -> None:
    """Write one window size of ``aggregated_metrics``, once per key."""
    rows = batch.where(F.col("window_size") == size).drop("window_size")
    keys = [k for k in AGGREGATE_KEY if k != "window_size"]
    order = [F.col("pump_id"), F.desc("window_start")]
    upsert_by_key(rows, aggregate_path(path, size), keys, "window_start", unique=True, order=order)
