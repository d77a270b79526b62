"""Rule table that decides whether a message is valid; the first failing rule wins.

Rules are SQL text over the ``msg`` column: a table of text is easy to extend, and reaches
the optimizer in one call instead of one per operator.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp, interval, parse_instant
from fluxwell.functions.pinning import pin
from fluxwell.schema import (
    FUTURE_TOLERANCE_SECONDS,
    PROCESSING_ERROR,
    RANGE,
    RANGE_BOUNDS,
    SCHEMA,
    STRICT_BOUNDS,
    STRICT_PUMP_ID,
    STRICT_STATUSES,
    TIMESTAMP,
    UNDECIDED,
)

_LIMIT = "_latest_allowed"


@dataclass(frozen=True)
class Rule:
    """``failed`` is the condition of a bad message and ``reason`` its text, both as SQL.

    A condition may be NULL where it can't be decided. A built-in rule then counts as kept; an extra rule that has a
    ``name`` sends the message to the dead letters as a processing error, which names the rule.
    """

    error_type: str
    failed: str
    reason: str
    name: str | None = None


def _blank(column: str) -> str:
    return f"{column} IS NULL OR {column} RLIKE r'^\\s*$'"


def schema_rules() -> list[Rule]:
    checks = [
        ("msg IS NULL", "Message is null"),
        (_blank("msg.pump_id"), "pump_id is required"),
        (_blank("msg.timestamp"), "timestamp is required"),
        ("msg.solar_panel IS NULL", "solar_panel is required"),
        ("msg.pump IS NULL", "pump is required"),
        ("msg.system IS NULL", "system is required"),
        (_blank("msg.system.status"), "system.status is required"),
    ]
    return [Rule(SCHEMA, failed, f"'{reason}'") for failed, reason in checks]


def strict_rules() -> list[Rule]:
    """What the written message contract promises beyond the enforced rules."""
    statuses = ", ".join(f"'{s}'" for s in STRICT_STATUSES)
    return [
        Rule(
            SCHEMA,
            f"NOT msg.pump_id RLIKE r'{STRICT_PUMP_ID}'",
            "concat('pump_id does not follow the naming convention: ', msg.pump_id)",
        ),
        Rule(SCHEMA, "msg.location IS NULL", "'location is required'"),
        Rule(
            SCHEMA,
            f"msg.system.status NOT IN ({statuses})",
            "concat('unknown system.status: ', msg.system.status)",
        ),
    ]


def timestamp_rules() -> list[Rule]:
    """``time`` is the parsed instant, NULL when the text is not one."""
    return [
        Rule(TIMESTAMP, "time IS NULL", "concat('Invalid ISO8601 timestamp: ', msg.timestamp)"),
        Rule(TIMESTAMP, f"time > {_LIMIT}", "concat('Timestamp is in the future: ', msg.timestamp)"),
    ]


def range_rule(bounds: list[tuple[str, float, float]]) -> Rule:
    """Inclusive bounds on numeric leaves; the first leaf outside its bounds is reported.

    NaN sorts above every number, so it fails the upper bound too. An absent section or
    leaf passes. Good rows pay for plain comparisons only: the list of readings is built
    for rows already known to fail.
    """
    failed = " OR ".join(
        f"coalesce(msg.{path} < {low}D OR msg.{path} > {high}D, false)" for path, low, high in bounds
    )
    readings = ", ".join(
        f"named_struct('path', '{path}', 'x', double(msg.{path}), 'low', {low}D, 'high', {high}D)"
        for path, low, high in bounds
    )
    reason = f"""get(transform(
      filter(array({readings}), r -> r.x < r.low OR r.x > r.high),
      r -> CASE WHEN isnan(r.x) OR abs(r.x) = double('Infinity') THEN concat(r.path, ' is NaN or Infinite')
           ELSE concat(r.path, '=', string(r.x), ' out of range [', string(r.low), ', ', string(r.high), ']') END), 0)"""
    return Rule(RANGE, failed, reason)


def rules(profile: str = "standard", extra: tuple[Rule, ...] = ()) -> list[Rule]:
    if profile not in ("standard", "strict"):
        raise ValueError(f"unknown profile {profile!r}")
    strict = profile == "strict"
    table = schema_rules() + (strict_rules() if strict else []) + timestamp_rules()
    table.append(range_rule(RANGE_BOUNDS + STRICT_BOUNDS if strict else RANGE_BOUNDS))
    return table + [replace(rule, name=rule.name or f"extra rule {i + 1}") for i, rule in enumerate(extra)]


def verdict(table: list[Rule]) -> str:
    """SQL of ``struct(error_type, error_reason)`` of the first rule that fails or can't be decided, else NULL."""
    cases = []
    for rule in table:
        cases.append((f"coalesce({rule.failed}, false)", rule.error_type, rule.reason))
        if rule.name:
            cases.append((f"({rule.failed}) IS NULL", PROCESSING_ERROR, f"'{UNDECIDED}{rule.name}'"))
    chain = " ".join(f"WHEN {test} THEN named_struct('error_type', '{kind}', 'error_reason', {reason})" for test, kind, reason in cases)
    return f"CASE {chain} END"


def validate(
    messages: DataFrame,
    as_of=None,
    profile: str = "standard",
    extra: tuple[Rule, ...] = (),
    pinned: bool = True,
) -> DataFrame:
    """Add ``time`` (the parsed instant) and ``error`` to rows with a ``msg`` column.

    Rows whose ``parse_error`` is set keep a NULL message verdict; routing handles them.
    ``extra`` rules run after the built-in ones; one without a name gets its number as its name,
    so that no message passes a rule that could not be decided. The result is pinned so that splitting it
    cannot evaluate the rules again; pass ``pinned=False`` when no filter follows.
    """
    error = verdict(rules(profile, extra))
    if "parse_error" in messages.columns:
        error = f"CASE WHEN parse_error IS NULL THEN {error} END"
    limit = as_timestamp(as_of) + interval(f"{FUTURE_TOLERANCE_SECONDS} seconds")
    out = (
        messages.withColumns({"time": parse_instant("msg.timestamp"), _LIMIT: limit})
        .withColumn("error", F.expr(error))
        .drop(_LIMIT)
    )
    fixed = [c for c in ("msg", "parse_error", "time", "error") if c in out.columns]
    return pin(out, *fixed) if pinned else out
