"""Batch builds that run again, window lists, and ties of reductions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fluxwell.operators.aggregate import window_metrics_all
from fluxwell.operators.present import reduce
from fluxwell.plans import batch
from fluxwell.schema import WINDOW_METRICS
from fluxwell.streaming import sinks


def readings(spark, rows):
    frame = spark.createDataFrame(rows, "pump_id string, at string, x double").withColumn("time", F.to_timestamp("at"))
    return frame.select("pump_id", "time", *(F.col("x").alias(c) for c in dict.fromkeys(WINDOW_METRICS.values())))


def test_a_second_build_replaces_windows_that_grew(spark, tmp_path):
    path = f"{tmp_path}/aggregates"
    first = [("A", "2024-05-01 00:00:05", 10.0), ("B", "2024-05-02 00:00:05", 1.0)]
    more = [("A", "2024-05-01 00:00:45", 30.0), ("C", "2024-05-01 00:03:00", 5.0)]
    sinks.write_all_aggregates(window_metrics_all(readings(spark, first)), path)
    sinks.write_all_aggregates(window_metrics_all(readings(spark, [first[0], *more])), path)
    stored = spark.read.parquet(path).select("window_size", "pump_id", "record_count").collect()
    assert sorted(map(tuple, stored)) == [("1m", "A", 2), ("1m", "B", 1), ("1m", "C", 1), ("5m", "A", 2), ("5m", "B", 1), ("5m", "C", 1)]


def test_windows_must_be_multiples(spark):
    rows = readings(spark, [("A", "2024-05-01 00:00:05", 1.0)])
    with pytest.raises(ValueError):
        window_metrics_all(rows, windows={"2m": "2 minutes", "5m": "5 minutes"})


def test_last_value_of_equal_times(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 3.0), (2, 4.0), (3, None)], "time int, v double")
    assert reduce(rows, "v").first()[0] == 4.0


def test_batches_stay_out_of_a_stream_folder(spark, tmp_path):
    (tmp_path / "landed" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError):
        batch.land(spark.createDataFrame([("{}",)], "value string"), f"{tmp_path}/landed")
