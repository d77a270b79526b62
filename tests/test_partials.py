"""Lists of statistics agree in one scan, per size, and on a stream, and with plain Python."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from fluxwell.operators import aggregate, partials
from fluxwell.streaming import pipeline

T0 = datetime(2024, 3, 1)
DDL = "time timestamp, pump_id string, flow double, code int"
METRICS = {"flow": ("flow", tuple(partials.STATS)), "code": ("code", ("count", "distinct", "max"))}
SIZES = {"1m": "1 minute", "5m": "5 minutes", "1h": "1 hour"}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    flow = lambda: r.choice((None, 1e6 + r.random(), 1e6, 1e6 + 0.25))
    return [(T0 + timedelta(seconds=r.randrange(7200)), f"P{r.randrange(3)}", flow(), r.choice((None, 1, 2, 3))) for _ in range(1200)]


def near(a, b):
    return a is b is None or abs(a - b) <= 0.0011


def test_statistics_equal_plain_python(spark, rows):
    groups = defaultdict(list)
    for t, p, flow, code in rows:
        for size, length in (("1m", 60), ("5m", 300), ("1h", 3600)):
            at = T0 + timedelta(seconds=(t - T0).total_seconds() // length * length)
            groups[size, at, p].append((flow, code))
    found = aggregate.window_metrics_all(spark.createDataFrame(rows, DDL), METRICS, SIZES).collect()
    assert len(found) == len(groups)
    for x in found:
        own = groups[x["window_size"], x["window_start"], x["pump_id"]]
        flows = sorted(f for f, _ in own if f is not None)
        assert x["record_count"] == len(own) and x["count_flow"] == len(flows)
        assert x["distinct_flow"] == len(set(flows)) and x["distinct_code"] == len({c for _, c in own} - {None})
        assert near(x["sum_flow"], sum(flows) if flows else None) and near(x["avg_flow"], statistics.fmean(flows) if flows else None)
        spread = statistics.variance(flows) if len(flows) > 1 else None
        assert near(x["variance_flow"], spread) and near(x["stddev_flow"], None if spread is None else spread**0.5)
        for name, rank in (("median", 0.5), ("p90", 0.9), ("p99", 0.99)):
            value = x[f"{name}_flow"]
            if not flows:
                assert value is None
            else:
                low, high = (sum(test(f) for f in flows) / len(flows) for test in (lambda f: f < value, lambda f: f <= value))
                assert low <= rank + 0.03 and high >= rank - 0.03


def test_all_ways_agree(spark, rows, tmp_path):
    metrics = {"flow": ("flow", ("avg", "variance", "sum", "count", "distinct", "median")), "code": "code"}
    frame = spark.createDataFrame(rows, DDL)
    once = aggregate.window_metrics_all(frame, metrics, SIZES).where("window_size = '5m'")
    alone = aggregate.window_metrics(frame, "5m", metrics, SIZES)
    assert once.columns == alone.columns
    assert once.exceptAll(alone).count() == alone.exceptAll(once).count() == 0
    # a stream of time order, with one last reading that closes all windows
    frame.union(spark.createDataFrame([(T0 + timedelta(days=1), "last", 1.0, 1)], DDL)).coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(DDL).parquet(f"{tmp_path}/in")
    query = pipeline.start_aggregates(source, f"{tmp_path}/out", f"{tmp_path}/ck", "5m", trigger=pipeline.AVAILABLE_NOW, windows=SIZES, statistics=metrics)
    query.awaitTermination()
    streamed = spark.read.parquet(f"{tmp_path}/out/window_size=5m").selectExpr(*(c if c != "window_size" else "'5m' AS window_size" for c in alone.columns))
    assert streamed.exceptAll(alone).count() == alone.exceptAll(streamed).count() == 0


def test_unknown_statistics_are_refused(spark, rows):
    with pytest.raises(ValueError, match="mode"):
        aggregate.window_metrics(spark.createDataFrame(rows, DDL), metrics={"flow": ("flow", ("mode",))})


def test_weeks_are_windows_everywhere(spark, rows):
    found = aggregate.window_metrics_all(spark.createDataFrame(rows, DDL), {"flow": "flow"}, {"1d": "1 day", "1w": "1 week"})
    assert found.where("window_size = '1w'").agg({"record_count": "sum"}).first()[0] == len(rows)
