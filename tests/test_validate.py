from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T
from samples import AS_OF, at, message

from fluxwell import schema
from fluxwell.operators.validate import Rule, validate

NAN, INF = float("nan"), float("inf")


def out_of(path, value, low, high):
    return ("RANGE", f"{path}={value} out of range [{low}, {high}]")


def leaf(path, value):
    return int(value) if path.endswith("rpm") else value


def required(path):
    return ("SCHEMA", f"{path} is required")


def unreadable(text):
    return {"timestamp": text}, ("TIMESTAMP", f"Invalid ISO8601 timestamp: {text}")


def ahead(**delta):
    return {"timestamp": at(**delta)}, ("TIMESTAMP", f"Timestamp is in the future: {at(**delta)}")


BLANKS = (None, "", " ", "\t \n")
NOT_INSTANTS = (
    "yesterday", "2031", "1999-02-30T10:00:00Z", "2023-07-19", "2023-07-19 06:45:10", "2023-07-19T06:45Z",
    "2023-07-19T06:45:10", "2023-07-19T06:45:10+02:00", "2023-07-19T06:61:10Z", "19.07.2023",
)
INSTANTS = (
    "2023-07-19T06:45:10Z", "2023-07-19t06:45:10z", "2023-07-19T06:45:10.Z", "2023-07-19T06:45:10.987654321Z",
    "2023-07-19T24:00:00Z", "2023-07-19T23:59:60Z",
)

# every rule in the order of checks: one broken reading a case, then two at once
CASES = {"nothing": (None, ("SCHEMA", "Message is null"))}
CASES |= {f"{path} {value!r}": ({path: value}, required(path)) for path in ("pump_id", "timestamp", "system.status") for value in BLANKS}
CASES |= {part: ({part: None}, required(part)) for part in ("solar_panel", "pump", "system")}
CASES |= {part: ({part: None}, None) for part in ("location", "environment")}
CASES |= {text: unreadable(text) for text in NOT_INSTANTS}
CASES |= {text: ({"timestamp": text}, None) for text in INSTANTS}
CASES |= {f"{s} s": ({"timestamp": at(seconds=s)}, None) for s in (-86400, 0, 59, 60)}
CASES |= {"60.000001 s": ahead(seconds=60, microseconds=1), "2 days": ahead(days=2)}
for bound, low, high in schema.RANGE_BOUNDS:
    for value in (low, high, (low + high) / 2):
        CASES[f"{bound} {value}"] = ({bound: leaf(bound, value)}, None)
    for value in (low - 1, high + 1, 2 * high + 7):
        CASES[f"{bound} {value}"] = ({bound: leaf(bound, value)}, out_of(bound, float(value), low, high))
    if not bound.endswith("rpm"):
        for value in (NAN, INF, -INF):
            CASES[f"{bound} {value}"] = ({bound: value}, ("RANGE", f"{bound} is NaN or Infinite"))
for end in (1, 2):
    CASES[f"every bound {end}"] = ({b[0]: leaf(b[0], b[end]) for b in schema.RANGE_BOUNDS}, None)
for (one, low, high), (two, *_) in zip(schema.RANGE_BOUNDS, schema.RANGE_BOUNDS[1:]):
    changes = {one: leaf(one, high + 4), two: leaf(two, -500.0)}
    CASES[f"{one} before {two}"] = (changes, out_of(one, high + 4.0, low, high))
CASES["schema first"] = ({"system.status": "", "timestamp": "soon", "pump.rpm": 9999}, required("system.status"))
CASES["time second"] = ({"timestamp": "soon", "pump.rpm": 9999}, unreadable("soon")[1])


def judge(spark, cases, **kw):
    rows = [(name, None if changes is None else message(changes)) for name, changes in cases.items()]
    ddl = T.StructType([T.StructField("name", T.StringType()), T.StructField("msg", schema.TELEMETRY_SCHEMA)])
    judged = validate(spark.createDataFrame(rows, ddl), AS_OF, **kw)
    return {r["name"]: r["error"] and tuple(r["error"]) for r in judged.select("name", "error").collect()}


@pytest.fixture(scope="module")
def verdicts(spark):
    return judge(spark, {name: changes for name, (changes, _) in CASES.items()})


@pytest.mark.parametrize("name", CASES)
def test_rule(verdicts, name):
    assert verdicts[name] == CASES[name][1]


def test_absent_leaf_counts_as_zero(spark):
    assert judge(spark, {"x": {"pump.rpm": None, "solar_panel.power_w": None}}) == {"x": None}


def test_strict_profile(spark):
    cases = {
        "ok": {},
        "id": {"pump_id": "P1"},
        "location": {"location": None},
        "status": {"system.status": "ODD"},
        "latitude": {"location.latitude": 91.0},
    }
    assert judge(spark, cases, profile="strict") == {
        "ok": None,
        "id": ("SCHEMA", "pump_id does not follow the naming convention: P1"),
        "location": ("SCHEMA", "location is required"),
        "status": ("SCHEMA", "unknown system.status: ODD"),
        "latitude": out_of("location.latitude", 91.0, -90.0, 90.0),
    }
    assert set(judge(spark, cases).values()) == {None}
    with pytest.raises(ValueError):
        judge(spark, {"ok": {}}, profile="other")


def test_extra_rule_runs_last(spark):
    extra = (Rule("RANGE", "msg.system.error_code > 500", "concat('code ', msg.system.error_code)"),)
    cases = {"a": {"system.error_code": 612}, "b": {"system.error_code": 612, "pump.rpm": -1}}
    found = judge(spark, cases, extra=extra)
    assert found == {"a": ("RANGE", "code 612"), "b": out_of("pump.rpm", -1.0, 0.0, 5000.0)}


def test_parsed_time(spark):
    texts = {
        "2024-01-01T24:00:00Z": "2024-01-02 00:00:00",
        "2024-01-01T23:59:60.5Z": "2024-01-01 23:59:59.5",
        "2024-01-01t01:02:03.004z": "2024-01-01 01:02:03.004",
        "2024-01-01T01:02:03.Z": "2024-01-01 01:02:03",
    }
    from fluxwell.functions.instants import parse_instant

    frame = spark.createDataFrame([Row(t=t) for t in texts])
    got = frame.select("t", parse_instant("t").cast("string").alias("x")).collect()
    assert {r["t"]: r["x"] for r in got} == texts


def test_undecidable_extra_rules_are_processing_errors(spark):
    named = Rule("RANGE", "try_divide(msg.pump.flow_rate_lpm, msg.pump.rpm) > 5", "'flow per turn'", "flow per turn")
    unnamed = Rule("SCHEMA", "msg.environment.humidity_percent > 90", "'too humid'")
    cases = {
        "ok": {},
        "stands still": {"pump.rpm": 0},
        "broken": {"pump.rpm": 1, "pump.flow_rate_lpm": 50.0},
        "no environment": {"environment": None},
        "humid": {"environment.humidity_percent": 95.0},
        "no pump": {"pump": None},
    }
    assert judge(spark, cases, extra=(named, unnamed)) == {
        "ok": None,
        "stands still": ("PROCESSING_ERROR", "Unexpected processing error: undecidable flow per turn"),
        "broken": ("RANGE", "flow per turn"),
        "no environment": ("PROCESSING_ERROR", "Unexpected processing error: undecidable extra rule 2"),
        "humid": ("SCHEMA", "too humid"),
        "no pump": ("SCHEMA", "pump is required"),
    }
