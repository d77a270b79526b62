"""Telemetry, payload and metric-sample tables derived from the ``events`` test table.

Deterministic, no randomness: the same rows come out of any engine. Thirty days of events
are compressed into one day. Every twentieth event is broken, in one of 32 ways by turns, so that each rule of the
standard profile but that of a null message fails somewhere; four more events in 640 only break rules of the strict one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp
from fluxwell.functions.pinning import pin
from fluxwell.operators.route import message_json
from fluxwell.schema import SECTIONS

AS_OF = "2024-01-02 00:00:00"
EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
_BASE = 1704067200000000  # 2024-01-01T00:00:00Z in microseconds
_COMPRESSION = 30


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).schema(EVENTS_DDL)
    # A stream takes a folder or a glob, and the table may be either a file or a folder; this glob has one match.
    return reader.parquet(f"{sf_dir}/events.parque[t]" if streaming else f"{sf_dir}/events.parquet")


#: Slices that the events of a day arrive in: eight hours each, and a last one for what is late.
SLICES = 4
_LATE = "CASE WHEN event_id % 16 = 5 THEN 1 ELSE 0 END"


def arrival(source: DataFrame, late: bool = True) -> Column:
    """The slice in which an event arrives; of those meant to be ``late``, each comes one slice after its time."""
    hour = f"(({_TIME_US}) - {_BASE}) div 28800000000"
    return F.expr(f"CAST(least({hour} + {_LATE if late else 0}, {SLICES - 1}) AS INT)")


def telemetry(source: DataFrame, since=None) -> DataFrame:
    """Events as messages: ``event_time``, ``msg`` and ``parse_ok``.

    ``since`` (event time, inclusive) is also put on the stored timestamp, so the bound
    reaches the file scan.
    """
    if since is not None:
        shift = F.unix_micros(as_timestamp(since)) - F.lit(_BASE)
        bound = F.timestamp_micros(F.lit(_BASE) + shift * _COMPRESSION).cast("timestamp_ntz")
        source = source.where(F.col("ts") >= bound)
    b = pin(
        source.selectExpr(
            "event_id AS e",
            "user_id AS u",
            "event_type AS et",
            "value AS v",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
            f"timestamp_micros({_TIME_US}) AS event_time",
        ),
        "k",
        "event_time",
    )
    fields = [
        f"'pump_id', {_PUMP_ID}",
        f"'timestamp', {_TIMESTAMP}",
    ]
    for section, names in SECTIONS.items():
        body = ", ".join(f"'{name}', CAST({_LEAVES[f'{section}.{name}']} AS {kind})" for name, kind in names)
        body = f"named_struct({body})"
        if section in _PRESENT:
            body = f"CASE WHEN {_PRESENT[section]} THEN {body} END"
        fields.append(f"'{section}', {body}")
    return b.selectExpr("event_time", f"named_struct({', '.join(fields)}) AS msg", "e % 640 <> 140 AS parse_ok")


_TIME_US = f"{_BASE} + (unix_micros(CAST(ts AS TIMESTAMP)) - {_BASE}) div {_COMPRESSION}"

# --- Fixed values: the derived message ------------------------------------------------------
_PUMP_ID = """CASE e % 640 WHEN 60 THEN NULL WHEN 160 THEN '  ' WHEN 7 THEN concat('pump-', u)
  ELSE concat('PUMP_', lpad(CAST(u AS STRING), 3, '0')) END"""
_TIMESTAMP = """CASE e % 640 WHEN 100 THEN '2024-01-02T00:10:00.000000Z' WHEN 120 THEN 'not-a-date' WHEN 180 THEN NULL WHEN 200 THEN ''
  ELSE date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END"""
_LEAVES = {
    "location.latitude": "CASE WHEN e % 640 = 27 THEN 95.5D ELSE CASE u % 3 WHEN 0 THEN 51.25D WHEN 1 THEN 47.5D ELSE 44.75D END END",
    "location.longitude": "CASE WHEN e % 640 = 37 THEN -181.0D ELSE CASE u % 3 WHEN 0 THEN 6.5D WHEN 1 THEN 8.25D ELSE 11.0D END END",
    "location.region": "CASE u % 3 WHEN 0 THEN 'Polder' WHEN 1 THEN 'Foothill' ELSE 'Lagoon' END",
    "solar_panel.irradiance_w_m2": "CASE WHEN e % 640 = 280 THEN 1500.5D ELSE k * 11.0D END",
    "solar_panel.voltage_v": "CASE e % 640 WHEN 300 THEN 100.25D WHEN 580 THEN -0.25D ELSE 48.0D END",
    "solar_panel.current_a": "CASE WHEN e % 640 = 320 THEN 30.5D ELSE v / 12.5D END",
    "solar_panel.power_w": "CASE WHEN e % 640 = 340 THEN 3000.5D ELSE v * 8.0D END",
    "solar_panel.temperature_c": "CASE e % 640 WHEN 360 THEN -40.5D WHEN 600 THEN 90.5D ELSE 20 + k % 40 END",
    "pump.motor_voltage_v": "CASE WHEN e % 640 = 380 THEN -0.5D ELSE 46.0D END",
    "pump.motor_current_a": "CASE WHEN e % 640 = 400 THEN 30.5D ELSE k % 25 END",
    "pump.rpm": "CASE e % 640 WHEN 20 THEN -100 WHEN 420 THEN 5001 ELSE k * 30 END",
    "pump.flow_rate_lpm": "CASE WHEN e % 640 = 0 THEN -1.0D - v ELSE v END",
    "pump.discharge_pressure_bar": "CASE WHEN e % 640 = 440 THEN 20.5D ELSE k % 5 END",
    "pump.suction_pressure_bar": "CASE WHEN e % 640 = 460 THEN 20.25D ELSE 0.25D END",
    "pump.water_temperature_c": "CASE WHEN e % 640 = 480 THEN 80.5D ELSE 18 + k % 10 END",
    "system.operating_hours": "CASE WHEN e % 640 = 500 THEN 100000.5D ELSE 1000 + e % 4000 END",
    "system.vibration_mm_s": "CASE WHEN e % 640 = 520 THEN 50.5D ELSE (e % 40) / 8.0D END",
    "system.error_code": "CASE WHEN et = 'error' THEN 301 + 7 * (e % 3) ELSE 0 END",
    "system.status": """CASE WHEN e % 640 = 80 THEN '  ' WHEN e % 640 = 260 THEN NULL WHEN e % 640 = 17 THEN 'IDLE' WHEN et <> 'error' THEN 'OPERATIONAL'
      WHEN e % 3 = 0 THEN 'FAULTED' WHEN e % 3 = 1 THEN 'ALERT' ELSE 'DEGRADED' END""",
    "environment.ambient_temperature_c": "CASE e % 640 WHEN 540 THEN -40.5D WHEN 620 THEN 60.5D ELSE 25 + k % 10 END",
    "environment.humidity_percent": "CASE WHEN e % 640 = 560 THEN 100.5D ELSE k % 100 END",
}
_PRESENT = {
    "location": "e % 11 <> 5",
    "solar_panel": "e % 640 <> 220",
    "pump": "e % 640 <> 40",
    "system": "e % 640 <> 240",
    "environment": "e % 7 <> 3 OR e % 640 IN (540, 560, 620)",
}
# A document that should not parse loses its last brace.
_CUT = "left({json}, length({json}) - 1)"


def messages(source: DataFrame, since=None) -> DataFrame:
    """Already parsed form, as ``ingest.parse`` would return it.

    ``value`` is filled for unreadable rows, the only ones whose payload is kept as received.
    """
    return telemetry(source, since).selectExpr(
        "event_time",
        f"CASE WHEN NOT parse_ok THEN {_CUT.format(json=message_json())} END AS value",
        "CASE WHEN parse_ok THEN msg END AS msg",
        "CASE WHEN NOT parse_ok THEN 'malformed document' END AS parse_error",
    )


def payloads(source: DataFrame, since=None) -> DataFrame:
    """Raw JSON form: one document per row in ``value``."""
    frame = telemetry(source, since).withColumn("_json", F.expr(message_json()))
    value = f"CASE WHEN parse_ok THEN _json ELSE {_CUT.format(json='_json')} END AS value"
    return pin(frame.selectExpr("event_time", value), "value")


SCRAPE_SECONDS = 15
_SLOTS = 86400 // SCRAPE_SECONDS


def metric_samples(source: DataFrame) -> DataFrame:
    """Samples every 15 s of the day, per event type, from counts of events so far.

    Two counters (restarted at noon), a gauge and an up flag. Events are counted per slot
    before anything is ordered, so the running totals see a fixed number of rows per kind.
    """
    slot = F.floor((F.unix_micros("event_time") - _BASE) / (SCRAPE_SECONDS * 1_000_000))
    k = F.get_json_object("props", "$.k").cast("bigint")
    counts = (
        source.select(
            F.col("event_type").alias("kind"), F.timestamp_micros(F.expr(_TIME_US)).alias("event_time"), k.alias("k")
        )
        .groupBy("kind", slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))
    )
    grid = counts.select("kind").distinct().select(
        "kind", F.explode(F.expr(f"sequence(0L, {_SLOTS - 1}L)")).alias("slot")
    )
    running = Window.partitionBy("kind", F.col("slot") >= _SLOTS // 2).orderBy("slot")
    filled = (
        grid.join(counts, ["kind", "slot"], "left")
        .select("kind", "slot", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"))
        .withColumn("total_n", F.sum("n").over(running))
        .withColumn("total_k", F.sum("k").over(running))
    )

    def sample(metric: str, label: str, value):
        return F.struct(
            F.lit(metric).alias("metric"),
            F.create_map(F.lit(label), F.col("kind")).alias("labels"),
            value.cast("double").alias("value"),
        )

    rows = F.array(
        sample("messages_published_total", "kind", F.col("total_n")),
        sample("message_units_total", "kind", F.col("total_k")),
        sample("queue_messages", "queue", F.col("n")),
        sample("up", "job", (F.col("n") > 0).cast("int")),
    )
    at = F.timestamp_micros((F.col("slot") + 1) * (SCRAPE_SECONDS * 1_000_000) + _BASE)
    return filled.select(at.alias("ts"), F.inline(rows))
