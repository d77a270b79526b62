from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import AS_OF, at, payload

from fluxwell import fixtures, schema
from fluxwell.operators import aggregate, metrics, route
from fluxwell.plans import batch
from fluxwell.sources import tables
from fluxwell.streaming import pipeline, sinks

DDL = "time timestamp, pump_id string, flow_rate_lpm double, solar_power_w double, vibration_mm_s double"
T0 = datetime(2024, 3, 1, 0, 0, 0)


def rows(*offsets, pump="P"):
    return [(T0 + timedelta(seconds=s), pump, 1.0 + i, 10.0, 0.5) for i, s in enumerate(offsets)]


def put(spark, folder, data):
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def running(spark, tmp_path):
    """A window query over a folder of valid rows, driven one micro-batch at a time."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    stream = spark.readStream.schema(DDL).parquet(str(source))
    query = pipeline.start_aggregates(
        stream, str(out), str(tmp_path / "ck"), "1m", trigger={"processingTime": "0 seconds"}
    )

    def step(*offsets, **kw):
        put(spark, source, rows(*offsets, **kw))
        query.processAllAvailable()
        try:
            found = spark.read.parquet(str(out)).orderBy("window_start").collect()
        except Exception:
            found = []
        return [((r["window_start"] - T0).total_seconds(), r["record_count"]) for r in found]

    yield step, query
    query.stop()


def test_window_closes_at_the_watermark(running):
    step, _ = running
    assert step(5, 55) == []
    assert step(69.999) == []
    assert step(70.0) == [(0.0, 2)]


def test_late_row_is_dropped(running):
    step, query = running
    step(5, 55)
    step(69.999, 70.0)
    assert step(30, 150) == [(0.0, 2), (60.0, 2)]
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    events = fixtures.events(spark, "/root/testdata/sf0.001", streaming=True)
    listener = metrics.CounterListener()
    spark.streams.addListener(listener)
    running = pipeline.start_pipeline(
        fixtures.payloads(events),
        root,
        f"{root}/checkpoint",
        as_of=fixtures.AS_OF,
        failed_at=F.col("event_time"),
        trigger=pipeline.AVAILABLE_NOW,
    )
    return root, running, listener


def test_pipeline_outputs(spark, finished):
    root, running, _ = finished
    assert list(running) == ["land", "valid-json", "dlq-json", "agg-1m", "agg-5m"]
    out = tables.load(spark, f"{root}/landed", f"{root}/aggregated_metrics", views=True)
    assert (out.raw.count(), out.dlq.count()) == (950, 50)
    assert spark.read.text(f"{root}/valid_json").count() == 950
    assert spark.read.text(f"{root}/dlq_json").count() == 50
    assert spark.table("aggregated_metrics").columns == [*schema.AGGREGATE_COLUMNS, "date"]


def test_stream_equals_batch(spark, finished, tmp_path):
    root, _, _ = finished
    streamed = tables.load(spark, f"{root}/landed", f"{root}/aggregated_metrics")
    payloads = fixtures.payloads(fixtures.events(spark, "/root/testdata/sf0.001"))
    batch.land(payloads, f"{tmp_path}/landed", fixtures.AS_OF, failed_at=F.col("event_time"))
    batch.build_aggregates(spark, f"{tmp_path}/landed", f"{tmp_path}/agg")
    whole = tables.load(spark, f"{tmp_path}/landed", f"{tmp_path}/agg")
    for a, b in ((streamed.raw, whole.raw), (streamed.dlq, whole.dlq)):
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    newest = whole.raw.agg(F.max("time")).first()[0]
    closed = whole.aggregates.where(F.col("window_end") <= newest - timedelta(seconds=10))
    assert streamed.aggregates.exceptAll(closed).count() == 0
    assert streamed.aggregates.count() == closed.count() > 900


def test_listener_counts(finished):
    import time

    _, _, listener = finished
    for _ in range(50):
        if listener.totals:
            break
        time.sleep(0.1)
    assert listener.totals["records_valid"] == 950
    assert listener.totals["records_processed"] == 998


def test_restart_continues_from_checkpoint(spark, finished):
    root, _, _ = finished
    events = fixtures.events(spark, "/root/testdata/sf0.001", streaming=True)
    pipeline.start_pipeline(
        fixtures.payloads(events),
        root,
        f"{root}/checkpoint",
        as_of=fixtures.AS_OF,
        failed_at=F.col("event_time"),
        trigger=pipeline.AVAILABLE_NOW,
    )
    out = tables.load(spark, f"{root}/landed")
    assert (out.raw.count(), out.dlq.count()) == (950, 50)


def test_shuffled_input_within_the_delay_equals_batch(spark, tmp_path):
    rng = random.Random(7)
    data = [
        (T0 + timedelta(seconds=s), f"P{rng.randrange(3)}", rng.random() * 9, rng.random() * 99, rng.random())
        for s in range(0, 600)
    ]
    moved = sorted(data, key=lambda r: r[0] + timedelta(seconds=rng.random() * 9))
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(source))
    for i in range(0, 600, 150):
        put(spark, source, moved[i : i + 150])
    put(spark, source, rows(3600, pump="end"))
    query = pipeline.start_aggregates(stream, str(out), str(tmp_path / "ck"), "1m", trigger=pipeline.AVAILABLE_NOW)
    query.awaitTermination()
    got = spark.read.parquet(str(out)).select(schema.AGGREGATE_COLUMNS)
    want = aggregate.window_metrics(spark.createDataFrame(data, DDL), "1m")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_upsert_adds_a_key_once(spark, tmp_path):
    valid = spark.createDataFrame(rows(1, 2, 61, 200), DDL)
    windows = aggregate.window_metrics(valid, "1m")
    path = str(tmp_path / "agg")
    sinks.write_aggregates(windows.where("window_start < '2024-03-01 00:01:00'"), path, "1m")
    sinks.write_aggregates(windows, path, "1m")
    sinks.write_aggregates(windows, path, "1m")
    sinks.write_aggregates(windows.limit(0), path, "1m")
    stored = spark.read.parquet(path).select(schema.AGGREGATE_COLUMNS)
    assert stored.count() == 3 and stored.exceptAll(windows).count() == 0


def test_batch_writers(spark, tmp_path):
    docs = [payload(), payload({"timestamp": at(days=-1)}), payload({"pump": None}), "{"]
    judged = batch.judge(spark.createDataFrame([(d,) for d in docs], "value string"), AS_OF)
    raw = route.flatten(route.split(judged)[0])
    sinks.write_raw(raw, f"{tmp_path}/raw")
    sinks.write_dlq(route.dlq(judged), f"{tmp_path}/dlq")
    sinks.write_json(route.dlq_json(route.dlq(judged)), f"{tmp_path}/json")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    assert stored.select(raw.columns).exceptAll(raw).count() == 0 and stored.count() == 2
    assert {str(r["date"]) for r in stored.select("date").collect()} == {"2024-02-29", "2024-03-01"}
    assert spark.read.parquet(f"{tmp_path}/dlq").count() == 2
    assert spark.read.text(f"{tmp_path}/json").count() == 2


def test_time_range_prunes_days(spark, finished):
    root, _, _ = finished
    raw = tables.load(spark, f"{root}/landed").raw
    recent = tables.since(raw, "time", "2024-01-02 00:00:00", "5 minutes").select("pump_id")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "date" in filters.split("PushedFilters")[0] and "outcome" in filters.split("PushedFilters")[0]
    assert "GreaterThan(time" in filters
    assert "flow_rate_lpm" not in plan


def test_policies_and_jdbc_options():
    assert sinks.SINK_POLICY["raw_telemetry"].trigger == {"processingTime": "10 seconds"}
    options = sinks.jdbc_options("jdbc:x", "dlq_records", user="u")
    assert options == {"url": "jdbc:x", "dbtable": "dlq_records", "batchsize": "20", "user": "u"}


def test_missing_event_time_counts_as_now(spark):
    frame = spark.createDataFrame([(None,)], "time timestamp")
    assert pipeline.with_event_time(frame).first()["time"] is not None
