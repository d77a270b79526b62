"""Reading payloads and turning JSON text into typed messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwell.functions.pinning import pin
from fluxwell.schema import ENVELOPE, SECTIONS, message_ddl

_BAD = "_unreadable"
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BAD,
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}
_TYPED = f"{message_ddl()}, {_BAD} string"
_LENIENT = f"{message_ddl('variant', 'variant', 'variant')}, {_BAD} string"
_TEXT_LEAVES = [*ENVELOPE] + [
    f"{section}.{leaf}"
    for section, leaves in SECTIONS.items()
    for leaf, kind in leaves
    if kind == "string"
]


def read_raw(
    spark: SparkSession,
    format: str = "text",
    path: str | None = None,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """One payload per row in ``value``, from files or a queue, batch or stream.

    A queue source that delivers bytes (for example Kafka) is decoded as UTF-8.
    """
    reader = (spark.readStream if streaming else spark.read).format(format).options(**options)
    frame = reader.load(path) if path else reader.load()
    return frame.withColumn("value", F.col("value").cast("string"))


def parse(payloads: DataFrame, pinned: bool = True) -> DataFrame:
    """Add ``msg`` (nested message or NULL) and ``parse_error`` (text or NULL).

    Nearly every payload already has the declared types, so it is read once by a typed
    parser. Only the rest is read again with VARIANT leaves, where numbers written as
    text are accepted and real type errors are told apart. Unknown fields are dropped.
    A numeric leaf that is absent from a present section stays NULL here and counts as
    zero wherever it is used (``with_defaults``).

    The result is pinned so that a filter on it cannot run the parsers again; pass
    ``pinned=False`` when no filter follows.
    """
    looks_nested = " OR ".join(
        f"coalesce(startswith(_typed.{p}, '{mark}'), false)" for p in _TEXT_LEAVES for mark in "{["
    )
    clean = f"_typed IS NOT NULL AND _typed.{_BAD} IS NULL AND NOT ({looks_nested})"
    read = (
        payloads.withColumn("_typed", F.from_json("value", _TYPED, _JSON_OPTIONS))
        .withColumn("_clean", F.expr(clean))
        .withColumn("_loose", F.when(~F.col("_clean"), F.from_json("value", _LENIENT, _JSON_OPTIONS)))
    )
    problem = f"""CASE WHEN _clean THEN NULL
      WHEN value IS NULL OR value RLIKE r'^\\s*$' THEN 'empty payload'
      WHEN value RLIKE r'^\\s*null(\\s|$)' THEN 'null'
      WHEN _loose IS NULL OR _loose.{_BAD} IS NOT NULL THEN 'malformed document'
      ELSE {_wrong_type()} END"""
    either = f"CASE WHEN _clean THEN {_message('_typed', _as_is)} ELSE {_message('_loose', _loose_leaf)} END"
    keep = [c for c in payloads.columns if c not in ("msg", "parse_error")]
    read = read.select(*keep, F.expr(either).alias("_msg"), F.expr(problem).alias("parse_error"))
    out = read.select(
        *keep, F.when(F.col("parse_error").isNull(), F.col("_msg")).alias("msg"), "parse_error"
    )
    return pin(out, "msg", "parse_error") if pinned else out


def with_defaults(msg: str = "msg") -> str:
    """SQL of the message with absent numeric leaves of present sections set to zero."""
    return _message(msg, lambda x, kind: x if kind == "string" else f"coalesce({x}, {kind}(0))")


def _leaves() -> list[tuple[str, str]]:
    out = [(name, "string") for name in ENVELOPE]
    for section, leaves in SECTIONS.items():
        out += [(f"{section}.{leaf}", kind) for leaf, kind in leaves]
    return out


def _message(root: str, leaf: Callable[[str, str], str]) -> str:
    """SQL that rebuilds the nested message from ``root`` with ``leaf`` put on every leaf."""
    fields = [f"'{name}', {leaf(f'{root}.{name}', 'string')}" for name in ENVELOPE]
    for section, leaves in SECTIONS.items():
        part = f"{root}.{section}"
        body = ", ".join(f"'{name}', {leaf(f'{part}.{name}', kind)}" for name, kind in leaves)
        fields.append(f"'{section}', CASE WHEN {part} IS NOT NULL THEN named_struct({body}) END")
    return f"named_struct({', '.join(fields)})"


def _as_is(x: str, kind: str) -> str:
    return x


def _text(x: str) -> str:
    return f"try_variant_get({x}, '$', 'string')"


def _number(text: str) -> str:
    """Value of a number or of text holding one; empty text and the word null read as zero."""
    return f"CASE WHEN trim({text}) IN ('', 'null') THEN 0D ELSE try_cast(trim({text}) AS double) END"


def _loose_leaf(x: str, kind: str) -> str:
    return _text(x) if kind == "string" else f"try_cast({_number(_text(x))} AS {kind})"


def _wrong_type() -> str:
    """SQL naming the first leaf whose value cannot be read as its declared type."""
    leaves = ", ".join(
        f"named_struct('path', '{path}', 'kind', '{kind}', "
        f"'found', schema_of_variant(_loose.{path}), 'text', {_text(f'_loose.{path}')})"
        for path, kind in _leaves()
    )
    number = _number("leaf.text")
    return f"""get(transform(filter(array({leaves}), leaf -> CASE
        WHEN leaf.text IS NULL THEN false
        WHEN leaf.kind = 'string' THEN leaf.found RLIKE '^(OBJECT|ARRAY)'
        WHEN leaf.kind = 'int' THEN try_cast({number} AS int) IS NULL
          OR (leaf.found = 'STRING' AND NOT trim(leaf.text) RLIKE r'^(null|[+-]?[0-9]+)?$')
        ELSE {number} IS NULL END),
      leaf -> concat('wrong type for ', leaf.path)), 0)"""
