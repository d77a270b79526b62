"""Windows that a stream keeps open, rows it lost to the watermark, restarts, and repair."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fluxwell import schema
from fluxwell.operators import aggregate
from fluxwell.plans import catalog
from fluxwell.streaming import pipeline, reconcile

T0 = datetime(2024, 3, 1)
MINUTE = timedelta(minutes=1)


def land(spark, folder, rows):
    """Valid rows in the landed layout, one file; ``rows`` are (second, pump, flow)."""
    frame = spark.createDataFrame([(T0 + timedelta(seconds=s), p, f) for s, p, f in rows], "time timestamp, pump_id string, flow_rate_lpm double")
    missing = [f for f in schema.LANDED_SCHEMA.fields if f.name not in (*frame.columns, "outcome", "date")]
    frame = frame.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing), F.lit("valid").alias("outcome"), F.to_date("time").alias("date"))
    frame.select(*schema.LANDED_SCHEMA.names).coalesce(1).write.mode("append").partitionBy("outcome", "date").parquet(folder)


def run(spark, root, **kw):
    pipeline.start_aggregates(pipeline.landed_valid(spark, f"{root}/landed", **kw), f"{root}/agg", f"{root}/ck", "1m", trigger=pipeline.AVAILABLE_NOW).awaitTermination()


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Five files out of order, each met from the checkpoint; what each row's batch should have held it against."""
    root, r = str(tmp_path_factory.mktemp("late")), random.Random(3)
    newest, late, every = None, [], []
    for base in (0, 300, 150, 900, 600):
        rows = [(base + r.randrange(200) + 0.25, f"P{r.randrange(4)}", float(r.randrange(90))) for _ in range(60)]
        for s, p, f in rows:
            end = s // 60 * 60 + 60
            every.append((s, p, f))
            if newest is not None and end <= newest - 10:
                late.append((s, p, f))
        newest = max([*(s for s, _, _ in rows), *([newest] if newest is not None else [])])
        land(spark, f"{root}/landed", rows)
        run(spark, root)
    return root, every, late, newest


def seconds(t):
    return (t - T0).total_seconds()


def test_late_rows_are_those_that_missed_their_window(spark, shuffled):
    root, _, late, _ = shuffled
    found = reconcile.late_rows(spark, f"{root}/landed", f"{root}/ck").collect()
    assert Counter((seconds(x["time"]), x["pump_id"], x["flow_rate_lpm"]) for x in found) == Counter(late) and late
    assert all(x["window_end"] <= x["watermark"] for x in found)


def test_short_windows_account_for_every_late_row(spark, shuffled):
    root, every, late, _ = shuffled
    found = reconcile.short_windows(spark, f"{root}/landed", f"{root}/agg", f"{root}/ck").collect()
    assert Counter({(seconds(x["window_start"]), x["pump_id"]): x["late_count"] for x in found}) == Counter((s // 60 * 60, p) for s, p, _ in late)
    totals = Counter((s // 60 * 60, p) for s, p, _ in every)
    assert all(x["record_count"] == totals[seconds(x["window_start"]), x["pump_id"]] == x["stream_count"] + x["late_count"] for x in found)
    part = reconcile.short_windows(spark, f"{root}/landed", f"{root}/agg", f"{root}/ck", start=T0 + 3 * MINUTE, end=T0 + 5 * MINUTE - timedelta(microseconds=1))
    assert {x["window_start"] for x in part.collect()} == {x["window_start"] for x in found if 180 <= seconds(x["window_start"]) < 300}


def test_open_windows_end_after_the_watermark(spark, shuffled):
    root, _, _, newest = shuffled
    found = reconcile.all_windows(spark, f"{root}/agg", f"{root}/ck").collect()
    assert found and all(x["is_open"] == (seconds(x["window_end"]) > newest - 10) for x in found)
    assert any(x["is_open"] for x in found) and not all(x["is_open"] for x in found)


def test_repair_makes_the_stream_equal_a_batch(spark, shuffled, tmp_path):
    import shutil

    root = f"{tmp_path}/copy"
    shutil.copytree(shuffled[0], root)
    paths = f"{root}/landed", f"{root}/agg", f"{root}/ck"
    before = reconcile.all_windows(spark, *paths[1:]).drop("is_open").collect()
    reconcile.repair(spark, *paths)
    after = reconcile.all_windows(spark, *paths[1:]).drop("is_open")
    valid = spark.read.schema(schema.LANDED_SCHEMA).parquet(paths[0])
    whole = aggregate.window_metrics(valid)
    assert after.exceptAll(whole).count() == 0 and after.count() == whole.count()
    assert sorted(map(str, before)) != sorted(map(str, whole.collect()))
    assert reconcile.short_windows(spark, *paths).count() == 0


def test_restart_carries_state_over_many_small_batches(spark, tmp_path):
    r, root = random.Random(5), str(tmp_path)
    counts = defaultdict(int)
    for k in range(6):
        # in order, so that nothing is late, with windows that span files
        rows = [(k * 50 + r.randrange(50), f"P{r.randrange(3)}", 1.0) for _ in range(40)]
        for s, p, _ in rows:
            counts[s // 60 * 60, p] += 1
        land(spark, f"{root}/landed", sorted(rows))
        if k in (1, 5):
            run(spark, root, max_files=1)
    batches = {x["batchId"] for x in spark.read.format("state-metadata").load(f"{root}/ck/agg-1m").selectExpr("maxBatchId AS batchId").collect()}
    assert max(batches) >= 5
    found = reconcile.all_windows(spark, f"{root}/agg", f"{root}/ck").collect()
    assert {(seconds(x["window_start"]), x["pump_id"]): x["record_count"] for x in found} == counts
    assert reconcile.late_rows(spark, f"{root}/landed", f"{root}/ck").count() == 0


def test_state_of_sketches_is_refused(spark):
    with pytest.raises(ValueError, match="quantiles"):
        reconcile.open_windows(spark, "nowhere", metrics={"flow": ("flow_rate_lpm", ("median",))})


def test_a_large_table_arrives_in_more_files_and_not_in_more_micro_batches(spark, tmp_path, monkeypatch):
    """Rows of one slice come in several files, so that several tasks parse them; every window comes out all the same."""
    root = tmp_path / "root"
    monkeypatch.setattr(catalog, "FILE_ROWS", 25, raising=False)
    monkeypatch.setattr(catalog, "shared_folder", lambda spark: str(root))
    hour = timedelta(hours=1)
    rows = [(i, datetime(2024, 1, 1) + i * 2 * hour - i % 3 * 5 * hour, i % 7, "view", float(i % 90), '{"k": %d}' % (i % 50)) for i in range(30, 350)]
    rows += [rows[7], (None, datetime(2024, 1, 9), None, "view", 1.0, '{"k": 1}')]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = Counter(map(tuple, catalog.stream_restart_5m(spark, str(tmp_path)).collect()))
    assert found == Counter(map(tuple, catalog.agg_5m(spark, str(tmp_path)).collect())) and len(found) > 100
    assert len(list((root / "events").glob("part-*"))) == 16
    assert spark.read.parquet(f"{root}/events").exceptAll(events).isEmpty() and spark.read.parquet(f"{root}/events").count() == len(rows)
    batches = [x for x in (root / "checkpoint" / "agg-5m" / "offsets").iterdir() if x.name.isdigit()]
    assert len(batches) <= 4 * 3
