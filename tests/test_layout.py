"""Compacted days beside a stream's log, and bucketed tables: same rows, less to read, no shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_reports import rows_made

from fluxwell import fixtures
from fluxwell.plans import ops, quality
from fluxwell.schema import LANDED_SCHEMA
from fluxwell.sources import tables
from fluxwell.streaming import compact, pipeline, sinks

SF = "/root/testdata/sf0.001"


def arrive(spark, root, days, part):
    """Land a part of the events, moved back by some days, through the stream."""
    events = fixtures.events(spark, SF).where(f"event_id % 4 = {part}")
    events.withColumn("ts", F.expr(f"ts - INTERVAL '{30 * days}' DAY")).repartition(3).write.mode("append").parquet(f"{root}/events")
    source = spark.readStream.schema(fixtures.EVENTS_DDL).parquet(f"{root}/events")
    pipeline.start_land(
        fixtures.payloads(source), f"{root}/landed", f"{root}/ck", fixtures.AS_OF, failed_at=F.col("event_time"), trigger=pipeline.AVAILABLE_NOW
    ).awaitTermination()


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Two finished days in six micro-batches."""
    root = str(tmp_path_factory.mktemp("layout"))
    for days in (2, 1):
        for part in range(3):
            arrive(spark, root, days, part)
    return root


def test_compaction_keeps_every_row_while_the_stream_goes_on(spark, root, tmp_path):
    import shutil

    shutil.copytree(root, f"{tmp_path}/copy")
    # the log of a stream names its files in full, so the copy is read as a batch would read it
    shutil.rmtree(f"{tmp_path}/copy/landed/_spark_metadata")
    landed, path = f"{tmp_path}/copy/landed", f"{tmp_path}/compacted"
    whole = lambda: tables.read_landed(spark, landed).select(*LANDED_SCHEMA.names)
    assert same(compact.read(spark, landed, path), whole())
    assert compact.compact(spark, landed, path, "2023-12-31 05:00:00")
    assert compact.compact(spark, landed, path, "2023-12-31 05:00:00") is None
    held = spark.read.parquet(f"{path}/data")
    assert [str(r[0]) for r in held.select("date").distinct().collect()] == ["2023-12-30"]
    assert same(compact.read(spark, landed, path), whole())
    # late rows of a compacted day, and a run that died before its manifest
    one = whole().where("date = '2023-12-30'").limit(7)
    one.write.mode("append").partitionBy("outcome", "date").parquet(landed)
    one.write.partitionBy("outcome", "date").parquet(f"{path}/data/run=dead")
    assert same(compact.read(spark, landed, path), whole())
    assert compact.compact(spark, landed, path, "2023-01-01")  # days never open again, late rows move over
    assert len(compact.runs(spark, path)) == 2 and same(compact.read(spark, landed, path), whole())
    assert compact.compact(spark, landed, path, "2024-01-05") and same(compact.read(spark, landed, path), whole())
    assert compact.load(spark, landed, path).raw.count() == tables.load(spark, landed).raw.count()


def test_compaction_beside_a_streams_log(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("beside"))
    landed, path = f"{root}/landed", f"{root}/compacted"
    whole = lambda: tables.read_landed(spark, landed).select(*LANDED_SCHEMA.names)
    for days, part in ((2, 0), (2, 1), (1, 0)):
        arrive(spark, root, days, part)
    compact.compact(spark, landed, path, "2023-12-31")
    arrive(spark, root, 2, 2)  # late for the compacted day
    arrive(spark, root, 0, 0)
    assert same(compact.read(spark, landed, path), whole()) and whole().count() == 1250
    held, fresh = spark.read.parquet(f"{path}/data").count(), compact.read(spark, landed, path).count()
    assert 0 < held < fresh
    compact.compact(spark, landed, path, "2024-01-01")
    assert same(compact.read(spark, landed, path), whole())


def test_one_pump_is_read_from_few_row_groups(spark, root, tmp_path):
    path = f"{tmp_path}/compacted"
    pumps = [r[0] for r in tables.load(spark, f"{root}/landed").raw.groupBy("pump_id").count().orderBy("pump_id").collect()]
    # many small row groups, as a large day has
    compact.compact(spark, f"{root}/landed", path, "2024-01-05", block_bytes=4096)
    middle = pumps[len(pumps) // 2]
    read = {}
    for name, table in (("landed", tables.read_landed(spark, f"{root}/landed")), ("compacted", spark.read.parquet(f"{path}/data"))):
        found = table.where((F.col("outcome") == "valid") & (F.col("pump_id") == middle)).select("time", "flow_rate_lpm")
        read[name] = sum(n for kind, n in rows_made(found) if kind == "FileSourceScanExec"), found.count()
    assert read["landed"][1] == read["compacted"][1] > 0
    assert read["compacted"][0] < read["landed"][0] / 2, read


def test_bucketed_reports_need_no_shuffle(spark, root):
    raw = tables.load(spark, f"{root}/landed").raw
    sinks.write_bucketed(raw, "bucketed_telemetry", 4)
    try:
        table = spark.table("bucketed_telemetry")
        plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
        per_pump = table.groupBy("pump_id").agg(F.count("*").alias("n"))
        assert "Exchange" not in plan(per_pump) and "Exchange" in plan(raw.groupBy("pump_id").agg(F.count("*").alias("n")))
        for report in (ops.latest_status(table, "2024-01-01", "2 days"), quality.freshness(table, "2024-01-01")):
            assert "hashpartitioning" not in plan(report)
        assert same(ops.latest_status(table, "2024-01-01", "2 days"), ops.latest_status(raw, "2024-01-01", "2 days"))
        both = per_pump.join(table.groupBy("pump_id").agg(F.max("time").alias("t")).hint("merge"), "pump_id")
        assert "Exchange" not in plan(both) and both.count() == per_pump.count()
    finally:
        spark.sql("DROP TABLE bucketed_telemetry")
