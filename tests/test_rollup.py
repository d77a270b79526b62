"""Reports from the day rollup equal those from the readings, and read nothing else."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fluxwell import fixtures
from fluxwell.plans import analytics, batch, ops, quality, rollup
from fluxwell.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("rollup"))
    events = fixtures.events(spark, SF)
    # three days: the same events a day earlier and two days earlier
    for k in range(3):
        moved = events.withColumn("ts", F.expr(f"ts - INTERVAL '{30 * k}' DAY"))
        batch.land(fixtures.payloads(moved), f"{root}/landed", fixtures.AS_OF, failed_at=F.col("event_time"))
    return root


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_reports_equal_scans(spark, landed):
    path = f"{landed}/rollup"
    assert rollup.build(spark, f"{landed}/landed", path) == [date(2023, 12, 30), date(2023, 12, 31), date(2024, 1, 1)]
    assert rollup.build(spark, f"{landed}/landed", path) == []
    raw, rolled = tables.load(spark, f"{landed}/landed").raw, rollup.read(spark, path)
    for scan, roll in (
        (analytics.offline_pumps(raw, fixtures.AS_OF), rollup.offline_pumps(rolled, fixtures.AS_OF)),
        (analytics.error_code_analysis(raw), rollup.error_code_analysis(rolled)),
        (quality.freshness(raw, fixtures.AS_OF), rollup.freshness(rolled, fixtures.AS_OF)),
    ):
        assert same(scan, roll) and roll.count() > 0
        files = roll._jdf.queryExecution().executedPlan().toString()
        assert "landed" not in files and "rollup" in files


def test_only_touched_days_are_built(spark, landed, tmp_path):
    import shutil

    shutil.copytree(f"{landed}/landed", f"{tmp_path}/landed")
    paths = f"{tmp_path}/landed", f"{tmp_path}/rollup"
    rollup.build(spark, *paths)
    before = {r["file"] for r in rollup.read(spark, paths[1]).select(F.input_file_name().alias("file")).distinct().collect()}
    late = fixtures.events(spark, SF).where("event_id < 100").withColumn("ts", F.expr("ts - INTERVAL '30' DAY"))
    batch.land(fixtures.payloads(late), paths[0], fixtures.AS_OF, failed_at=F.col("event_time"))
    assert rollup.build(spark, *paths) == [date(2023, 12, 31)]
    after = {r["file"] for r in rollup.read(spark, paths[1]).select(F.input_file_name().alias("file")).distinct().collect()}
    assert {f for f in before ^ after if "2023-12-31" not in f} == set()
    raw, rolled = tables.load(spark, paths[0]).raw, rollup.read(spark, paths[1])
    assert rolled.agg(F.sum("n")).first()[0] == raw.count()
    rolled = rolled.drop("covered")
    assert same(rollup.rollup(raw).select(*rolled.columns), rolled)


def test_files_that_land_during_a_build_are_built_next(spark, landed, tmp_path, monkeypatch):
    import shutil

    shutil.copytree(f"{landed}/landed", f"{tmp_path}/landed")
    paths, listed = (f"{tmp_path}/landed", f"{tmp_path}/rollup"), rollup.stale_days
    late = fixtures.events(spark, SF).where("event_id < 50")

    def then_land(*args):
        found = listed(*args)
        batch.land(fixtures.payloads(late), paths[0], fixtures.AS_OF, failed_at=F.col("event_time"))
        return found

    monkeypatch.setattr(rollup, "stale_days", then_land)
    rollup.build(spark, *paths)
    monkeypatch.setattr(rollup, "stale_days", listed)
    assert rollup.build(spark, *paths) == [date(2024, 1, 1)] and rollup.build(spark, *paths) == []
    assert rollup.read(spark, paths[1]).agg(F.sum("n")).first()[0] == tables.load(spark, paths[0]).raw.count()


def test_sketches_count_pumps_over_any_range(spark, landed):
    raw = tables.load(spark, f"{landed}/landed").raw
    sketches = rollup.pump_sketches(raw)
    for start, end in (("2023-12-30 05:00:00", "2024-01-01 17:30:00"), ("2024-01-01 10:00:00", "2024-01-01 10:30:00"), (None, None)):
        exact = tables.time_range(raw, "time", start)
        exact = exact.where(F.col("time") < F.lit(end).cast("timestamp")) if end else exact
        count = exact.agg(F.countDistinct("pump_id")).first()[0]
        assert abs(rollup.pumps_between(sketches, start, end).first()[0] - count) <= 0.02 * count


def test_stacked_total_of_ids_with_one_long_prefix(spark):
    rows = [(f"2024-01-01 23:{m:02d}:00", f"SITE-NORTH-PUMP-{i:05d}" if i else None, float(i % 7)) for m in range(3) for i in range(600)]
    raw = spark.createDataFrame(rows, "time string, pump_id string, flow_rate_lpm double").withColumn("time", F.col("time").cast("timestamp"))
    found = ops.flow_stacked(raw, fixtures.AS_OF, blocks=8)
    total, expected = 0.0, {}
    for i in range(600):
        total += float(i % 7)
        expected[f"SITE-NORTH-PUMP-{i:05d}" if i else None] = total
    assert all(r["stacked"] == expected[r["pump_id"]] for r in found.collect()) and found.count() == 1800
    bounds = ops.id_bounds(raw, "pump_id", 8)
    sizes = [sum(1 for i in range(1, 600) if sum(b <= f"SITE-NORTH-PUMP-{i:05d}" for b in bounds) == k) for k in range(8)]
    assert min(sizes) > 20 and max(sizes) < 200
