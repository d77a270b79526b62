"""Finished days of a landed table, rewritten into few sorted files beside the stream's log.

A stream appends a small unsorted file per task and micro-batch, and its log names each of them, so files can't be
exchanged in place. A compaction writes the rows of finished days anew into a folder of its own, sorted by pump
and with Bloom filters on the pump id, and then adds one row to a manifest; only with that row do readers see the
new files. Runs never overlap: a run takes the landed files that are newer than the run before it, and those of days
that have finished since. A run that dies leaves files that no manifest names.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fluxwell.functions.instants import as_timestamp
from fluxwell.schema import LANDED_SCHEMA
from fluxwell.sources.tables import Tables, dlq_of, files_of, raw_of, read_landed
from fluxwell.streaming import sinks

MANIFEST = "run string, before date, covered timestamp"
PARTS = ("outcome", "date")


def runs(spark: SparkSession, path: str) -> list:
    """Runs of a compacted table in order; one row each, so a list on the driver stays small."""
    try:
        return sorted(spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect(), key=lambda r: (r["before"], r["covered"]))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return []


def _newer(known: list, upto: Column | None = None) -> list[Column]:
    """Which landed rows no run holds, as two conditions that the file index can prune by: by day, and by file."""
    date, written = F.col("date"), F.col("_metadata.file_modification_time")
    if not known:
        return [F.lit(True) if upto is None else date < upto]
    before, covered = F.lit(known[-1]["before"]), F.lit(known[-1]["covered"])
    later_days = date >= before if upto is None else (date >= before) & (date < upto)
    return [later_days, (date < before) & (written > covered)]


def _where_any(spark: SparkSession, landed: str, conditions: list[Column]) -> DataFrame:
    """Landed rows of any of the conditions, which exclude each other; each is a scan that prunes by its own."""
    parts = [read_landed(spark, landed).where(c).select(*LANDED_SCHEMA.names) for c in conditions]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def compact(spark: SparkSession, landed: str, path: str, before, block_bytes: int = 128 << 20) -> str | None:
    """Rewrite the days before ``before`` (a date or instant) as far as no run has; returns the new run, or None.

    Micro-batches of a stream follow each other, so all files it commits later are newer than those the listing shows.
    Days that were compacted stay so: an earlier ``before`` than the last one counts as that one. Late rows of a
    compacted day are read from the landed files until the next run takes them over.
    """
    known = runs(spark, path)
    limit = as_timestamp(before).cast("date")
    limit = F.greatest(limit, F.lit(known[-1]["before"])) if known else limit
    # the listing and the day in one job; what is committed after it is newer than "covered"
    found = files_of(spark, landed).agg(F.max("modificationTime").alias("covered"), F.first(limit).alias("before")).first()
    if found["covered"] is None:
        return None
    limit, covered = F.lit(found["before"]), F.lit(found["covered"])
    seen = [c & (F.col("_metadata.file_modification_time") <= covered) for c in _newer(known, limit)]
    rows = _where_any(spark, landed, seen)
    if rows.isEmpty():
        return None
    run = uuid.uuid4().hex
    sorted_rows = sinks.cluster_for_lookup(rows, "landed", *PARTS)
    (
        sorted_rows.write.partitionBy(*PARTS)
        .option("parquet.bloom.filter.enabled#pump_id", "true")
        .option("parquet.bloom.filter.expected.ndv#pump_id", "100000")
        .option("parquet.block.size", str(block_bytes))
        .parquet(f"{path}/data/run={run}")
    )
    spark.createDataFrame([(run, found["before"], found["covered"])], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return run


def read(spark: SparkSession, landed: str, path: str) -> DataFrame:
    """The landed table: compacted rows from their runs, all others from the landed files. Same rows as the latter alone."""
    known = runs(spark, path)
    fresh = _where_any(spark, landed, _newer(known))
    if not known:
        return fresh
    shape = StructType([*LANDED_SCHEMA.fields, StructField("run", StringType())])
    held = spark.read.schema(shape).parquet(f"{path}/data").where(F.col("run").isin(*(r["run"] for r in known)))
    return held.select(*LANDED_SCHEMA.names).unionByName(fresh)


def load(spark: SparkSession, landed: str, path: str) -> Tables:
    """``tables.load`` over a compacted table; every report reads it as before."""
    rows = read(spark, landed, path)
    return Tables(raw_of(rows), dlq_of(rows))
