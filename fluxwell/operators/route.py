"""Splitting judged messages into the valid table and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwell.functions.instants import format_instant, parse_instant
from fluxwell.schema import (
    DEAD,
    DESERIALIZATION_ERROR,
    DLQ_COLUMNS,
    LANDED_SCHEMA,
    PARSE_PREFIX,
    RAW_FROM_MESSAGE,
    SECTIONS,
    UNKNOWN_PUMP,
    VALID,
)
from fluxwell.sources.ingest import with_defaults

_KEEP_NULLS = {"ignoreNullFields": "false"}


def message_json(msg: str = "msg") -> str:
    """SQL of a message's canonical JSON: declared fields only, absent sections as null."""
    return f"to_json({with_defaults(msg)}, map('ignoreNullFields', 'false'))"


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid, unreadable, invalid)``: the main stream and its two side outputs."""
    readable = judged.where("parse_error IS NULL")
    return (
        readable.where("error IS NULL"),
        judged.where("parse_error IS NOT NULL"),
        readable.where("error IS NOT NULL"),
    )


def _flat_columns() -> dict[str, str]:
    """SQL of every table column taken from the message."""
    out = {}
    for column, path, kind, absent in RAW_FROM_MESSAGE:
        leaf = f"msg.{path}" if kind == "string" else f"coalesce(msg.{path}, {kind}(0))"
        if absent is not None:
            section = path.split(".")[0]
            literal = f"'{absent}'" if kind == "string" else f"{kind}({absent})"
            leaf = f"CASE WHEN msg.{section} IS NULL THEN {literal} ELSE {leaf} END"
        out[column] = leaf
    return out


# SQL of the dead-letter columns of a row that is known to be bad.
_UNREADABLE = {
    "pump_id": f"'{UNKNOWN_PUMP}'",
    "error_type": f"'{DESERIALIZATION_ERROR}'",
    "error_reason": f"concat('{PARSE_PREFIX}', parse_error)",
    "original_payload": "value",
}
_INVALID = {
    "pump_id": f"CASE WHEN msg IS NULL THEN '{UNKNOWN_PUMP}' ELSE msg.pump_id END",
    "error_type": "error.error_type",
    "error_reason": "error.error_reason",
    "original_payload": f"CASE WHEN msg IS NULL THEN 'null' ELSE {message_json()} END",
}
_DEAD = {
    name: f"CASE WHEN parse_error IS NOT NULL THEN {_UNREADABLE[name]} ELSE {_INVALID[name]} END"
    for name in _INVALID
}


def _select(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    return frame.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def _stamped(frame: DataFrame, failed_at: Column | None) -> DataFrame:
    stamp = F.current_timestamp() if failed_at is None else failed_at
    return frame.withColumn("error_timestamp", stamp)


def flatten(valid: DataFrame) -> DataFrame:
    """Valid messages as the 23 columns of ``raw_telemetry``."""
    return _select(valid, {"time": "time", "pump_id": "msg.pump_id", **_flat_columns()})


def parse_dlq(unreadable: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Dead letters of payloads that are not a message; the payload stays as received."""
    return _select(_stamped(unreadable, failed_at), {"error_timestamp": "error_timestamp", **_UNREADABLE})


def validation_dlq(invalid: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Dead letters of messages that break a rule; ``pump_id`` is NULL when it was missing."""
    return _select(_stamped(invalid, failed_at), {"error_timestamp": "error_timestamp", **_INVALID})


def dlq(judged: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Both kinds of dead letters: ``parse_dlq`` and ``validation_dlq`` in one pass."""
    dead = judged.where("parse_error IS NOT NULL OR error IS NOT NULL")
    return _select(_stamped(dead, failed_at), {"error_timestamp": "error_timestamp", **_DEAD})


def outcomes(judged: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Every input row once, in the landed layout: raw columns for valid rows, dead-letter
    columns for the rest.

    One pass over the input replaces a filter per sink; the writer splits the rows by the
    ``outcome`` and ``date`` partitions. The helper columns are what is needed to give a
    valid row back as its message.
    """
    good = {
        "time": "time",
        **_flat_columns(),
        "timestamp_text": "msg.timestamp",
        "has_location": "msg.location IS NOT NULL",
        "has_environment": "msg.environment IS NOT NULL",
    }
    dead = {"error_timestamp": "error_timestamp", **{k: v for k, v in _DEAD.items() if k != "pump_id"}}
    columns = {name: f"CASE WHEN _good THEN {sql} END" for name, sql in good.items()}
    columns |= {name: f"CASE WHEN NOT _good THEN {sql} END" for name, sql in dead.items()}
    columns["pump_id"] = _DEAD["pump_id"]
    columns["outcome"] = f"CASE WHEN _good THEN '{VALID}' ELSE '{DEAD}' END"
    columns["date"] = "to_date(CASE WHEN _good THEN time ELSE error_timestamp END)"
    flagged = _stamped(judged, failed_at).withColumn(
        "_good", F.expr("parse_error IS NULL AND error IS NULL")
    )
    return _select(flagged, {name: columns[name] for name in LANDED_SCHEMA.names})


def valid_json(landed_valid: DataFrame) -> DataFrame:
    """Landed valid rows back as message JSON in ``value``."""
    column_of = {path: column for column, path, _, _ in RAW_FROM_MESSAGE}
    present = {"location": "has_location", "environment": "has_environment"}
    fields = ["'pump_id', pump_id", "'timestamp', timestamp_text"]
    for section, leaves in SECTIONS.items():
        body = ", ".join(f"'{leaf}', {column_of[f'{section}.{leaf}']}" for leaf, _ in leaves)
        body = f"named_struct({body})"
        if section in present:
            body = f"CASE WHEN {present[section]} THEN {body} END"
        fields.append(f"'{section}', {body}")
    message = f"named_struct({', '.join(fields)})"
    return landed_valid.selectExpr(f"to_json({message}, map('ignoreNullFields', 'false')) AS value")


def dlq_json(dead: DataFrame) -> DataFrame:
    """Dead letters as queue messages in ``value``; the time field is named ``failed_at``."""
    return dead.select(
        F.to_json(
            F.struct(
                "original_payload",
                "error_reason",
                "error_type",
                "pump_id",
                format_instant(F.col("error_timestamp")).alias("failed_at"),
            ),
            _KEEP_NULLS,
        ).alias("value")
    )


def dlq_from_json(messages: DataFrame) -> DataFrame:
    """Queue messages back as table rows; an unreadable ``failed_at`` becomes now."""
    ddl = "original_payload string, error_reason string, error_type string, pump_id string, failed_at string"
    m = F.from_json(F.col("value"), ddl)
    stamp = F.coalesce(parse_instant("m.failed_at"), F.current_timestamp())
    return messages.select(m.alias("m")).select(
        stamp.alias("error_timestamp"), *[F.col(f"m.{name}") for name in DLQ_COLUMNS[1:]]
    )
