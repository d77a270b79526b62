from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from samples import ABSENT, AS_OF, message, payload

from fluxwell import schema
from fluxwell.operators import metrics, route
from fluxwell.plans.batch import judge
from fluxwell.sources import ingest

DES = "DESERIALIZATION_ERROR"
OK = "OK"

# payload -> (error type, reason or None when the text does not matter)
GOLDEN = {
    payload(): (OK, None),
    payload({"solar_panel.voltage_v": -3.25}): ("RANGE", "solar_panel.voltage_v=-3.25 out of range [0.0, 100.0]"),
    payload({"pump.rpm": 7400}): ("RANGE", "pump.rpm=7400.0 out of range [0.0, 5000.0]"),
    **{payload({part: ABSENT}): ("SCHEMA", f"{part} is required") for part in ("solar_panel", "pump", "system")},
    **{payload({part: None}): ("SCHEMA", f"{part} is required") for part in ("solar_panel", "pump", "system")},
    **{payload({part: ABSENT}): (OK, None) for part in ("environment", "location")},
    # a section that isn't an object, one without leaves, one with an unknown leaf, an unknown section
    **{payload({part: odd}): (DES, None) for part in schema.SECTIONS for odd in ("", "text", 8, 0.5, False, [], [{}])},
    **{payload({part: {}}): (OK, None) for part in ("solar_panel", "location", "environment")},
    payload({"location": {"altitude": 402}}): (OK, None),
    payload({"valve": {"open": True}}): (OK, None),
    payload({"system.status": "STANDBY", "system.error_code": 315, "pump.rpm": 0}): (OK, None),
    # numbers written as text, whole numbers with a fraction, empty text
    payload({"pump.rpm": "12"}): (OK, None),
    payload({"pump.rpm": 12.7}): (OK, None),
    payload({"pump.rpm": "12.7"}): (DES, f"JSON parse error: wrong type for pump.rpm"),
    payload({"pump.rpm": 99999999999}): (DES, "JSON parse error: wrong type for pump.rpm"),
    payload({"pump.flow_rate_lpm": " 7.5 "}): (OK, None),
    payload({"pump.flow_rate_lpm": ""}): (OK, None),
    payload({"pump.flow_rate_lpm": None}): (OK, None),
    payload({"pump.flow_rate_lpm": "fast"}): (DES, "JSON parse error: wrong type for pump.flow_rate_lpm"),
    payload({"pump.flow_rate_lpm": True}): (DES, "JSON parse error: wrong type for pump.flow_rate_lpm"),
    payload({"pump.flow_rate_lpm": {"a": 1}}): (DES, "JSON parse error: wrong type for pump.flow_rate_lpm"),
    payload({"pump.flow_rate_lpm": "NaN"}): ("RANGE", "pump.flow_rate_lpm is NaN or Infinite"),
    payload({"pump_id": {"a": 1}}): (DES, "JSON parse error: wrong type for pump_id"),
    payload({"pump_id": [1]}): (DES, "JSON parse error: wrong type for pump_id"),
    payload({"pump_id": 7}): (OK, None),
    payload({"pump_id": "{odd}"}): (OK, None),
    payload({"timestamp": 12345}): ("TIMESTAMP", "Invalid ISO8601 timestamp: 12345"),
    payload() + " trailing": (OK, None),
    payload().replace('"rpm": 1840', '"rpm": 1, "rpm": 1840'): (OK, None),
    payload().replace("87.5", "NaN"): (DES, None),
    payload().replace("87.5", "1e400"): ("RANGE", "pump.flow_rate_lpm is NaN or Infinite"),
    payload().replace('"', "'"): (DES, None),
    payload()[:-1]: (DES, "JSON parse error: malformed document"),
    "[" + payload() + "]": (DES, None),
    "null": (DES, "JSON parse error: null"),
    " null ": (DES, "JSON parse error: null"),
    "": (DES, "JSON parse error: empty payload"),
    "  ": (DES, "JSON parse error: empty payload"),
    '{"pump_id":': (DES, "JSON parse error: malformed document"),
    "[1]": (DES, None),
    "5": (DES, None),
    "{}": ("SCHEMA", "pump_id is required"),
}


@pytest.fixture(scope="module")
def judged(spark):
    frame = spark.createDataFrame([(p,) for p in GOLDEN], "value string")
    return judge(frame, AS_OF).cache()


@pytest.fixture(scope="module")
def verdicts(judged):
    dead = {r["original"]: r for r in _dead(judged).collect()}
    return dead


def _dead(judged):
    both = judged.withColumn("original", F.col("value"))
    _, unreadable, invalid = route.split(both)
    pick = lambda f, sql: f.select("original", F.expr(sql[0]).alias("kind"), F.expr(sql[1]).alias("reason"))
    return pick(unreadable, (f"'{DES}'", "concat('JSON parse error: ', parse_error)")).unionByName(
        pick(invalid, ("error.error_type", "error.error_reason"))
    )


@pytest.mark.parametrize("doc", GOLDEN, ids=range(len(GOLDEN)))
def test_outcome(verdicts, doc):
    kind, reason = GOLDEN[doc]
    row = verdicts.get(doc)
    if kind == OK:
        assert row is None, row
    else:
        assert row is not None and row["kind"] == kind
        assert reason is None or row["reason"] == reason


def test_single_pass_equals_side_outputs(judged):
    at = F.lit("2024-01-01").cast("timestamp")
    _, unreadable, invalid = route.split(judged)
    apart = route.parse_dlq(unreadable, at).unionByName(route.validation_dlq(invalid, at))
    together = route.dlq(judged, at)
    assert together.columns == apart.columns
    assert together.exceptAll(apart).count() == 0 and apart.exceptAll(together).count() == 0


def test_outcomes_cover_every_row_once(judged):
    at = F.lit("2024-01-01").cast("timestamp")
    landed = route.outcomes(judged, at)
    valid, *_ = route.split(judged)
    good = landed.where("outcome = 'valid'")
    raw = route.flatten(valid)
    assert landed.count() == len(GOLDEN)
    assert good.select(raw.columns).exceptAll(raw).count() == 0 and good.count() == raw.count()
    dead = route.dlq(judged, at)
    assert landed.where("outcome = 'dlq'").select(dead.columns).exceptAll(dead).count() == 0


def test_landed_rows_give_back_the_message(judged):
    landed = route.outcomes(judged).where("outcome = 'valid'")
    valid, *_ = route.split(judged)
    back = sorted(r["value"] for r in route.valid_json(landed).collect())
    assert back == sorted(r["j"] for r in valid.selectExpr(f"{route.message_json()} AS j").collect())


def one(spark, doc):
    frame = judge(spark.createDataFrame([(doc,)], "value string"), AS_OF)
    return route.flatten(route.split(frame)[0]).first()


def test_lenient_values(spark):
    assert one(spark, payload({"pump.rpm": "12"}))["rpm"] == 12
    assert one(spark, payload({"pump.rpm": 12.7}))["rpm"] == 12
    assert one(spark, payload({"pump.flow_rate_lpm": " 7.5 "}))["flow_rate_lpm"] == 7.5
    assert one(spark, payload({"pump.flow_rate_lpm": ""}))["flow_rate_lpm"] == 0.0
    assert one(spark, payload({"pump_id": "{odd}"}))["pump_id"] == "{odd}"
    assert one(spark, payload({"pump_id": 7}))["pump_id"] == "7"


def test_flatten_defaults(spark):
    row = one(spark, payload({"location": ABSENT, "environment": ABSENT, "solar_panel": {}}))
    assert (row["latitude"], row["longitude"], row["region"]) == (0.0, 0.0, "UNKNOWN")
    assert (row["ambient_temperature_c"], row["humidity_percent"]) == (0.0, 0.0)
    assert row["solar_power_w"] == 0.0
    row = one(spark, payload({"location": {"lat": "NaN", "lon": None}}))
    assert (row["latitude"], row["longitude"], row["region"]) == (0.0, 0.0, None)
    assert len(row) == 23


def test_dead_letter_payload_and_pump(spark):
    docs = [payload({"pump_id": ABSENT, "extra": 1, "pump.rpm": ABSENT}), payload()[:-1]]
    frame = judge(spark.createDataFrame([(d,) for d in docs], "value string"), AS_OF)
    rows = {r["error_type"]: r for r in route.dlq(frame).collect()}
    canonical = json.loads(rows["SCHEMA"]["original_payload"])
    assert canonical == {**message({"pump.rpm": 0}), "pump_id": None}
    assert rows["SCHEMA"]["pump_id"] is None
    assert rows[DES]["original_payload"] == docs[1] and rows[DES]["pump_id"] == "UNKNOWN"
    assert rows[DES]["error_timestamp"] is not None


def test_dlq_queue_form_round_trip(spark, judged):
    dead = route.dlq(judged, F.lit("2024-01-01 00:00:01.5").cast("timestamp"))
    back = route.dlq_from_json(route.dlq_json(dead))
    assert back.exceptAll(dead).count() == 0 and back.count() == dead.count()
    odd = spark.createDataFrame([('{"failed_at":"x","error_type":"RANGE"}',)], "value string")
    assert route.dlq_from_json(odd).first()["error_timestamp"] is not None


def test_counters(judged):
    row = metrics.pipeline_counters(judged).first().asDict()
    kinds = [kind for kind, _ in GOLDEN.values()]
    assert row == {
        "records_processed": len(kinds) - kinds.count(DES),
        "validation_errors_schema": kinds.count("SCHEMA"),
        "validation_errors_timestamp": kinds.count("TIMESTAMP"),
        "validation_errors_range": kinds.count("RANGE"),
        "records_valid": kinds.count(OK),
    }


def test_no_python_and_one_parser_per_row(spark):
    frame = spark.createDataFrame([("x",)], "value string").repartition(2)
    plan = route.flatten(route.split(judge(frame, AS_OF))[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("from_json(") <= 2  # typed, and VARIANT for the rest


def test_read_raw_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text(payload() + "\n" + payload({"pump": None}) + "\n")
    frame = ingest.read_raw(spark, path=str(tmp_path))
    assert frame.columns == ["value"] and frame.count() == 2
    assert ingest.read_raw(spark, path=str(tmp_path), streaming=True).isStreaming
