"""The same work as the streaming job, over a finished input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluxwell.operators import route
from fluxwell.operators.aggregate import window_metrics_all
from fluxwell.operators.validate import validate
from fluxwell.schema import WINDOWS
from fluxwell.sources import ingest
from fluxwell.sources.tables import load
from fluxwell.streaming import sinks


def judge(payloads: DataFrame, as_of=None, profile: str = "standard", pinned: bool = True) -> DataFrame:
    """Payloads to ``msg``, ``parse_error``, ``time`` and ``error``."""
    return validate(ingest.parse(payloads, pinned=False), as_of, profile, pinned=pinned)


def land(payloads: DataFrame, path: str, as_of=None, profile: str = "standard", failed_at=None, mode: str = "append", rebalance: bool = True) -> None:
    """Parse and validate once, write valid rows and dead letters in the same pass.

    A folder that a stream writes is refused: readers follow the stream's log there and would miss these rows.
    """
    spark = payloads.sparkSession
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"a stream writes {path}; land batches in another folder")
    sinks.write_landed(route.outcomes(judge(payloads, as_of, profile, pinned=False), failed_at), path, mode, rebalance)


def build_aggregates(spark: SparkSession, landed: str, path: str, windows: dict[str, str] = WINDOWS) -> None:
    """All window sizes of ``aggregated_metrics`` from one scan of a landed table."""
    sinks.write_all_aggregates(window_metrics_all(load(spark, landed).raw, windows=windows), path)
