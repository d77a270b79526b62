"""Loading landed tables and restricting them to a time range."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from fluxwell.functions.instants import as_timestamp
from fluxwell.schema import (
    AGGREGATE_COLUMNS,
    AGGREGATE_SCHEMA,
    DEAD,
    DLQ_COLUMNS,
    LANDED_SCHEMA,
    RAW_COLUMNS,
    VALID,
)


@dataclass(frozen=True)
class Tables:
    """The three tables every report reads; each also carries its ``date`` partition."""

    raw: DataFrame
    dlq: DataFrame
    aggregates: DataFrame | None = None


def read_landed(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """The landed table with its declared schema, as a batch or a stream of ``max_files`` files a micro-batch."""
    reader = (spark.readStream if streaming else spark.read).schema(LANDED_SCHEMA)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def raw_of(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("outcome") == VALID).select(*RAW_COLUMNS, "date")


def dlq_of(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("outcome") == DEAD).select(*DLQ_COLUMNS, "date")


def load(
    spark: SparkSession,
    landed: str,
    aggregates: str | None = None,
    views: bool = False,
) -> Tables:
    """Batch scan of the landed and aggregate folders; optionally as temp views too."""
    table = read_landed(spark, landed)
    agg = None
    if aggregates:
        agg = (
            spark.read.schema(StructType([*AGGREGATE_SCHEMA.fields, StructField("date", DateType())]))
            .parquet(aggregates)
            .select(*AGGREGATE_COLUMNS, "date")
        )
    out = Tables(raw_of(table), dlq_of(table), agg)
    if views:
        out.raw.createOrReplaceTempView("raw_telemetry")
        out.dlq.createOrReplaceTempView("dlq_records")
        if agg is not None:
            agg.createOrReplaceTempView("aggregated_metrics")
    return out


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file of a partitioned table: its partitions, ``path``, ``modificationTime``, ``length``.

    Only listings are read. Of a folder that a stream writes, committed files count.
    """
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).drop("content")


def load_jdbc(spark: SparkSession, url: str, table: str, split: tuple | None = None, **options: str) -> DataFrame:
    """A table kept in a relational store, read in parallel when ``split`` is given.

    ``split`` is ``(column, lower, upper, partitions)``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split:
        column, lower, upper, count = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(count))
        )
    return reader.load()


def time_range(frame: DataFrame, column: str, start=None, end=None, open_start: bool = False) -> DataFrame:
    """Rows with ``start <= column <= end`` (``start <`` when ``open_start``).

    When the frame carries a ``date`` partition the same bounds are put on it, so whole
    days outside the range are never listed or opened.
    """
    conditions: list[Column] = []
    dated = "date" in frame.columns
    t = F.col(column)
    if start is not None:
        low = as_timestamp(start)
        conditions.append(t > low if open_start else t >= low)
        if dated:
            conditions.append(F.col("date") >= low.cast("date"))
    if end is not None:
        high = as_timestamp(end)
        conditions.append(t <= high)
        if dated:
            conditions.append(F.col("date") <= high.cast("date"))
    for condition in conditions:
        frame = frame.where(condition)
    return frame


def since(frame: DataFrame, column: str, as_of, lookback: str, inclusive: bool = False) -> DataFrame:
    """Rows newer than ``as_of - lookback``; the bound itself only when ``inclusive``."""
    start = as_timestamp(as_of) - F.expr(f"INTERVAL '{lookback}'")
    return time_range(frame, column, start=start, open_start=not inclusive)
