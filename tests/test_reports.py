"""Reports against small brute-force computations, and every query against its SQL twin."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import check
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fluxwell.functions.rounding import round3, round_numeric
from fluxwell.operators import aggregate, health, present
from fluxwell.plans import analytics, ops, quality

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 3, 1, 12, 0, 0)
RAW = (
    "time timestamp, pump_id string, latitude double, longitude double, region string, status string, "
    "error_code int, flow_rate_lpm double, solar_power_w double, vibration_mm_s double, irradiance_w_m2 double"
)


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    frame = contract.queries()[name](spark, SF)
    assert check.compare(frame, db, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 927


def make(spark, rows):
    full = [
        (
            r.get("time", AS_OF),
            r.get("pump_id", "P1"),
            r.get("latitude", 1.0),
            r.get("longitude", 2.0),
            r.get("region", "A"),
            r.get("status", "OPERATIONAL"),
            r.get("error_code", 0),
            r.get("flow_rate_lpm", 12.0),
            r.get("solar_power_w", 100.0),
            r.get("vibration_mm_s", 1.0),
            r.get("irradiance_w_m2", 500.0),
        )
        for r in rows
    ]
    return spark.createDataFrame(full, RAW)


def ago(**delta):
    return AS_OF - timedelta(**delta)


def hot(seed=3, n=4000):
    """Readings where one pump holds a third of all rows."""
    rng = random.Random(seed)
    return [
        {
            "time": ago(seconds=rng.randrange(0, 7200)),
            "pump_id": "P0" if rng.random() < 0.34 else f"P{rng.randrange(1, 40):02d}",
            "flow_rate_lpm": round(rng.random() * 100, 2),
            "solar_power_w": round(rng.random() * 900, 2),
            "vibration_mm_s": round(rng.random() * 5, 2),
            "status": rng.choice(["OPERATIONAL", "ALERT", None]),
            "error_code": rng.choice([0, 0, 9010, None]),
            "region": rng.choice(["A", "B", None]),
        }
        for _ in range(n)
    ]


def test_windows_by_brute_force(spark):
    rows = hot()
    want = defaultdict(list)
    for r in rows:
        want[(r["pump_id"], r["time"].replace(second=0, microsecond=0))].append(r["flow_rate_lpm"])
    got = aggregate.window_metrics(make(spark, rows), "1m").collect()
    assert len(got) == len(want)
    for g in got:
        flows = want[(g["pump_id"], g["window_start"])]
        assert g["record_count"] == len(flows)
        assert g["max_flow_rate"] == pytest.approx(max(flows)) and g["min_flow_rate"] == pytest.approx(min(flows))
        assert g["avg_flow_rate"] == pytest.approx(math.fsum(flows) / len(flows), abs=6e-4)
        assert g["window_end"] - g["window_start"] == timedelta(minutes=1)


def test_all_windows_in_one_scan_equal_each_alone(spark):
    raw = make(spark, hot())
    both = aggregate.window_metrics_all(raw)
    alone = aggregate.window_metrics(raw, "1m").unionByName(aggregate.window_metrics(raw, "5m"))
    assert both.exceptAll(alone).count() == 0 and both.count() == alone.count()


def test_extension_points(spark):
    raw = make(spark, hot())
    out = aggregate.window_metrics(raw, "1h", {"irradiance": "irradiance_w_m2"}, {"1h": "1 hour"})
    assert "max_irradiance" in out.columns and out.count() > 0


def test_rounding(spark):
    frame = spark.createDataFrame([(0.0005,), (-0.0005,), (1.0005,), (2.5,), (1.005,), (-1.005,)], "x double")
    got = [tuple(r) for r in frame.select(round3(F.col("x")), round_numeric(F.col("x"), 2)).collect()]
    assert got == [(0.001, 0.0), (0.0, 0.0), (1.001, 1.0), (2.5, 2.5), (1.005, 1.01), (-1.005, -1.01)]


def test_error_codes_by_brute_force(spark):
    rows = hot()
    want = defaultdict(list)
    for r in rows:
        abnormal = (r["error_code"] not in (0, None)) or (r["status"] not in ("OPERATIONAL", None))
        if abnormal:
            want[(r["error_code"], r["status"])].append(r)
    got = analytics.error_code_analysis(make(spark, rows)).collect()
    assert len(got) == len(want)
    for g in got:
        group = want[(g["error_code"], g["status"])]
        assert g["occurrences"] == len(group)
        assert g["sample_pumps"] == sorted({r["pump_id"] for r in group})[:5]
        assert g["last_seen"] == max(r["time"] for r in group)


def test_stacked_by_brute_force(spark):
    rows = hot()
    flows = defaultdict(lambda: defaultdict(float))
    for r in rows:
        if r["time"] >= ago(hours=1):
            flows[r["time"].replace(second=0, microsecond=0)][r["pump_id"]] += r["flow_rate_lpm"]
    for blocks in (1, 2, 8):
        got = ops.flow_stacked(make(spark, rows), AS_OF, blocks=blocks).collect()
        assert len(got) == sum(len(v) for v in flows.values())
        for g in got:
            pumps = flows[g["time"]]
            assert g["stacked"] == pytest.approx(sum(v for p, v in pumps.items() if p <= g["pump_id"]))


def test_stacked_keeps_null_ids(spark):
    rows = [{"pump_id": p, "flow_rate_lpm": x} for p, x in ((None, 1.0), ("A", 2.0), ("B", 4.0))]
    got = ops.flow_stacked(make(spark, rows), AS_OF).collect()
    assert [(r["pump_id"], r["flow_rate"], r["stacked"]) for r in got] == [(None, 1.0, 1.0), ("A", 2.0, 3.0), ("B", 4.0, 7.0)]


def test_top_water_and_ties(spark):
    rows = [{"pump_id": f"P{i}", "flow_rate_lpm": 12.0} for i in (3, 1, 2)]
    rows += [{"pump_id": "P9", "time": ago(hours=24)}, {"pump_id": "old", "time": ago(hours=24, seconds=1)}]
    got = analytics.top_water_delivery(make(spark, rows), AS_OF, n=3).collect()
    assert [(r["pump_id"], r["total_liters"], r["cubic_meters"]) for r in got] == [
        ("P1", 1.0, 0.0),
        ("P2", 1.0, 0.0),
        ("P3", 1.0, 0.0),
    ]


def test_offline_is_strict_and_uses_the_newest_reading(spark):
    rows = [{"pump_id": "edge", "time": ago(minutes=5)}, {"pump_id": "off", "time": ago(minutes=5, seconds=1)}]
    got = analytics.offline_pumps(make(spark, rows), AS_OF).collect()
    assert [(r["pump_id"], r["inactivity"], r["inactivity_seconds"]) for r in got] == [
        ("off", timedelta(seconds=301), 301.0)
    ]
    rows.append({"pump_id": "ahead", "time": AS_OF + timedelta(seconds=30)})
    ahead = analytics.offline_pumps(make(spark, rows), AS_OF).collect()
    assert [r["inactivity_seconds"] for r in ahead] == [331.0, 330.0]
    assert analytics.offline_pumps(make(spark, rows).limit(0), AS_OF).count() == 0


def test_offline_scans_the_table_once(spark):
    from fluxwell.plans import catalog

    frame = catalog.q2_offline(spark, SF)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ReusedExchange" in plan or plan.count("FileScan") == 1


def test_latest_status(spark):
    rows = [
        {"time": ago(minutes=1), "status": "OLD"},
        {"time": ago(seconds=5), "status": "NEW", "error_code": 1},
        {"time": ago(minutes=5), "pump_id": "gone"},
    ]
    got = ops.latest_status(make(spark, rows), AS_OF).collect()
    assert [(r["pump_id"], r["status"], r["error_code"]) for r in got] == [("P1", "NEW", 1)]


def test_small_operations_reports(spark):
    rows = [{"time": ago(minutes=m), "pump_id": f"P{m}", "error_code": c} for m, c in ((1, 0), (2, 9010), (4, 100))]
    raw = make(spark, rows)
    assert ops.pumps_online(raw, AS_OF).first()["pumps_online"] == 3
    assert ops.pumps_online(raw, AS_OF, approximate=True).first()["pumps_online"] == 3
    assert ops.water_today(raw, AS_OF).first()["litres_today"] == 3.0
    assert ops.water_today(raw, "2024-03-02 00:00:00").first()["litres_today"] is None
    assert ops.avg_solar_power(raw, AS_OF).first()["avg_solar_power"] == 100.0
    assert [r["error_code"] for r in ops.error_distribution(raw, AS_OF).collect()] == [
        "Error 100",
        "Error 9010",
        "No Error (0)",
    ]
    assert [r["pump_id"] for r in ops.underperforming(raw, AS_OF, n=2).collect()] == ["P1", "P2"]
    assert ops.solar_timeseries(raw, AS_OF).count() == 3
    ranged = ops.flow_timeseries(raw, "avg", AS_OF, start=ago(minutes=2), end=ago(minutes=1))
    assert ranged.count() == 2


def test_quality_reports(spark):
    ddl = "error_timestamp timestamp, pump_id string, error_type string, error_reason string, original_payload string"
    dead = [
        (ago(minutes=1), None, "SCHEMA", "a", "x" * 600),
        (ago(minutes=1), "P1", "SCHEMA", "a", "y"),
        (ago(minutes=9), "P1", "RANGE", "b", "z"),
        (ago(hours=1), "P1", "RANGE", "b", "z"),
    ]
    dlq = spark.createDataFrame(dead, ddl)
    raw = make(spark, [{"time": ago(minutes=m, seconds=0)} for m in (1, 2, 3)])
    assert quality.success_rate(raw, dlq, AS_OF).first()["success_rate"] == 0.5
    assert quality.success_rate(raw.limit(0), dlq.limit(0), AS_OF).first()["success_rate"] == 1.0
    assert quality.valid_count(raw, AS_OF).first()["valid"] == 3
    assert quality.dlq_count(dlq, AS_OF).first()["dlq"] == 3
    kinds = quality.error_types(dlq, AS_OF).collect()
    assert [(r["metric"], r["value"]) for r in kinds] == [("SCHEMA", 2), ("RANGE", 1)]
    assert kinds[0]["percent"] == pytest.approx(200 / 3)
    assert [r["dlq_messages"] for r in quality.dlq_per_minute(dlq, AS_OF).collect()] == [1, 1, 2]
    assert [(r["error_reason"], r["count"]) for r in quality.error_reasons(dlq, AS_OF).collect()] == [("a", 2), ("b", 1)]
    newest = quality.recent_dlq(dlq, n=2).collect()
    assert newest[0]["pump_id"] is None and len(newest[0]["original_payload"]) == 500


def test_freshness(spark):
    rows = [
        {"time": ago(seconds=2, microseconds=500000), "status": "ALERT"},
        {"time": ago(seconds=90), "status": "OPERATIONAL", "region": "Z"},
    ]
    row = quality.freshness(make(spark, rows), AS_OF).first()
    assert (row["seconds_since_last"], row["region"]) == (3, "Z")
    assert (row["last_status"], row["true_status"]) == ("OPERATIONAL", "ALERT")


# --- metric series ---------------------------------------------------------------------------


def samples(spark, points, metric="c"):
    rows = [(datetime(2024, 3, 1) + timedelta(seconds=s), metric, labels, float(v)) for s, labels, v in points]
    return spark.createDataFrame(rows, "ts timestamp, metric string, labels map<string,string>, value double")


def brute_increase(points, t, span):
    """The documented extrapolated increase, written the plain way."""
    inside = sorted((s, v) for s, v in points if t - span < s <= t)
    if len(inside) < 2:
        return None
    gain = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
    first, last = inside[0][0], inside[-1][0]
    sampled = last - first
    gap = sampled / (len(inside) - 1)
    head, tail = first - (t - span), t - last
    head = gap / 2 if head >= gap * 1.1 else head
    tail = gap / 2 if tail >= gap * 1.1 else tail
    if gain > 0 and inside[0][1] >= 0:
        head = min(head, sampled * inside[0][1] / gain)
    return gain * (sampled + head + tail) / sampled


@pytest.mark.parametrize("span,step,block", [(60, 60, 3600), (60, 15, 60), (300, 60, 300), (90, 40, 3600)])
def test_increase_by_brute_force(spark, span, step, block):
    rng = random.Random(span + step)
    series = {}
    for name in ("a", "b"):
        value, points = 0.0, []
        for s in range(0, 4000, 15):
            value = 0.0 if rng.random() < 0.03 else value + rng.randrange(0, 9)
            if rng.random() < 0.9:
                points.append((s + rng.randrange(0, 5), value))
        series[name] = points
    frame = samples(spark, [(s, {"k": n}, v) for n, points in series.items() for s, v in points])
    got = {
        (r["labels"]["k"], int((r["ts"] - datetime(2024, 3, 1)).total_seconds())): r["value"]
        for r in health.increase(frame, "c", span, step, block_s=block).collect()
    }
    want = {
        (name, t): x
        for name, points in series.items()
        for t in range(0 - (1709251200 % step), 4400, step)
        if (x := brute_increase(points, t, span)) is not None
    }
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value)


def test_increase_shuffles_once(spark):
    frame = samples(spark, [(s, {"k": "a"}, s) for s in range(0, 600, 15)])
    out = health.rate(frame, "c", 60, 15)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange") == 1 and "Python" not in plan


def rows_made(frame):
    """Rows that every operator of a finished query put out, by operator."""
    frame.collect()
    found, todo = [], [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            found.append((name, metric.get().value()))
    return found


def test_rows_do_not_grow_with_the_range(spark):
    """A day's range at a step of 15 s holds each sample 5,760 times; no operator makes such rows."""
    frame = samples(spark, [(s, {"k": k}, s) for s in range(0, 14400, 15) for k in "ab"])
    for span, step in ((60, 60), (3600, 15), (86400, 15)):
        made = rows_made(health.increase(frame, "c", span, step, end=datetime(2024, 3, 1, 4)))
        # at most two blocks for a sample, and one mark for an evaluation time
        assert max(n for _, n in made) <= 2 * 1920 + 2 * 14400 // step + 2, (span, step, made)


def test_start_and_end(spark):
    frame = samples(spark, [(s, {}, s) for s in range(0, 600, 15)])
    whole = {r["ts"]: r["value"] for r in health.increase(frame, "c").collect()}
    low, high = datetime(2024, 3, 1, 0, 3), datetime(2024, 3, 1, 0, 6)
    part = {r["ts"]: r["value"] for r in health.increase(frame, "c", start=low, end=high).collect()}
    assert part == {t: v for t, v in whole.items() if low <= t <= high} and len(part) == 4


def test_selectors_and_instant(spark):
    frame = samples(
        spark,
        [(0, {"queue": "raw", "x": "1"}, 1), (15, {"queue": "raw", "x": "1"}, 2), (15, {"queue": "rawest"}, 5), (20, {}, 9)],
        "q",
    )
    assert health.select(frame, "q", equals={"queue": "raw"}).count() == 2
    assert health.select(frame, "q", equals={"queue": ""}).count() == 1
    assert health.select(frame, "q", matches={"queue": "raw"}).count() == 2
    assert health.select(frame, "q", matches={"queue": "raw.*"}).count() == 3
    now = datetime(2024, 3, 1, 0, 0, 18)
    got = {r["labels"].get("queue"): r["value"] for r in health.instant(frame, "q", now).collect()}
    assert got == {"raw": 2.0, "rawest": 5.0}
    assert health.instant(frame, "q", now + timedelta(minutes=6)).count() == 0
    assert health.range(frame, "q", end=datetime(2024, 3, 1, 0, 0, 1)).count() == 1
    legend = {tuple(sorted(r["labels"])): (r["mean"], r["max"]) for r in health.summarize(frame).collect()}
    assert legend[("queue", "x")] == (1.5, 2.0)


def test_ratio_of_rates(spark):
    up = [(s, {"k": "a"}, 3 * s) for s in range(0, 600, 15)]
    down = [(s, {"k": "a"}, s) for s in range(0, 600, 15)] + [(s, {"k": "only"}, s) for s in range(0, 600, 15)]
    flat = [(s, {"k": "z"}, 5) for s in range(0, 600, 15)]
    frame = samples(spark, up + flat, "n").unionByName(samples(spark, down + flat, "d"))
    got = defaultdict(list)
    for r in health.rate_ratio(frame, "n", "d").collect():
        got[r["labels"]["k"]].append(r["value"])
    assert set(got) == {"a", "z"}
    assert got["a"] == pytest.approx([3.0] * len(got["a"])) and all(math.isnan(x) for x in got["z"])


# --- presentation ----------------------------------------------------------------------------


def test_bands(spark):
    frame = spark.createDataFrame([(0.5,), (0.9,), (0.949,), (0.95,), (None,)], "x double")
    got = [r[0] for r in frame.select(present.band(F.col("x"), "success_rate")).collect()]
    assert got == ["red", "yellow", "yellow", "green", None]
    for steps in present.THRESHOLDS.values():
        assert steps[0][0] is None


def test_value_maps(spark):
    frame = spark.createDataFrame([("PROCESSING_ERROR",), ("other",), (None,)], "x string")
    got = [tuple(r) for r in frame.select(
        present.value_map(F.col("x"), "error_type"), present.value_map(F.col("x"), "error_type", "color")
    ).collect()]
    assert got == [("PROC", "dark-red"), ("other", None), (None, None)]
    up = spark.range(2).select(present.value_map(F.col("id"), "target_up")).collect()
    assert [r[0] for r in up] == ["DOWN", "UP"]


def test_wide_series_and_reductions(spark):
    frame = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", None)], "time int, k string, v double")
    assert [tuple(r) for r in present.to_series(frame, "time", "k", "v").orderBy("time").collect()] == [
        (1, 1.0, 2.0),
        (2, None, None),
    ]
    assert present.to_series(frame, "time", "k", "v", ["b"]).columns == ["time", "b"]
    assert present.reduce(frame, "v").first()[0] in (1.0, 2.0)
    assert present.reduce(frame, "v", "sum").first()[0] == 3.0
    with pytest.raises(ValueError):
        present.reduce(frame, "v", "median")
