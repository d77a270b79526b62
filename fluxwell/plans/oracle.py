"""The catalog's queries as plain SQL, written independently for result checks in DuckDB."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-02 00:00:00'"
DAY_END = "TIMESTAMP '2024-01-01 23:59:59'"


def _num(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def _round3(x: str) -> str:
    return f"floor(round(({x}) * 1000, 6) + 0.5) / 1000"


_TELEMETRY = """
b AS (
  SELECT event_id AS e, user_id AS u, event_type AS et, value AS v,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 30) AS event_time
  FROM events),
m AS (
  SELECT e, event_time,
    CASE WHEN e % 640 = 60 THEN NULL WHEN e % 640 = 160 THEN '  ' WHEN e % 640 = 7 THEN concat('pump-', u)
         ELSE concat('PUMP_', lpad(CAST(u AS VARCHAR), 3, '0')) END AS pump_id,
    CASE WHEN e % 640 = 100 THEN '2024-01-02T00:10:00.000000Z' WHEN e % 640 = 120 THEN 'not-a-date'
         WHEN e % 640 = 180 THEN NULL WHEN e % 640 = 200 THEN ''
         ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS ts_text,
    CAST(CASE WHEN e % 640 = 27 THEN 95.5 WHEN u % 3 = 0 THEN 51.25 WHEN u % 3 = 1 THEN 47.5 ELSE 44.75 END AS DOUBLE) AS latitude,
    CAST(CASE WHEN e % 640 = 37 THEN -181.0 WHEN u % 3 = 0 THEN 6.5 WHEN u % 3 = 1 THEN 8.25 ELSE 11.0 END AS DOUBLE) AS longitude,
    CASE u % 3 WHEN 0 THEN 'Polder' WHEN 1 THEN 'Foothill' ELSE 'Lagoon' END AS region,
    CAST(if(e % 640 = 280, 1500.5, k * CAST(11.0 AS DOUBLE)) AS DOUBLE) AS irradiance_w_m2,
    CAST(CASE e % 640 WHEN 300 THEN 100.25 WHEN 580 THEN -0.25 ELSE 48.0 END AS DOUBLE) AS solar_voltage_v,
    CAST(if(e % 640 = 320, 30.5, v / CAST(12.5 AS DOUBLE)) AS DOUBLE) AS solar_current_a,
    CAST(if(e % 640 = 340, 3000.5, v * CAST(8.0 AS DOUBLE)) AS DOUBLE) AS solar_power_w,
    CAST(CASE e % 640 WHEN 360 THEN -40.5 WHEN 600 THEN 90.5 ELSE 20 + k % 40 END AS DOUBLE) AS solar_temperature_c,
    CAST(if(e % 640 = 380, -0.5, 46.0) AS DOUBLE) AS motor_voltage_v, CAST(if(e % 640 = 400, 30.5, k % 25) AS DOUBLE) AS motor_current_a,
    CAST(CASE e % 640 WHEN 20 THEN -100 WHEN 420 THEN 5001 ELSE k * 30 END AS INT) AS rpm,
    CASE WHEN e % 640 = 0 THEN CAST(-1.0 AS DOUBLE) - v ELSE v END AS flow_rate_lpm,
    CAST(if(e % 640 = 440, 20.5, k % 5) AS DOUBLE) AS discharge_pressure_bar, CAST(if(e % 640 = 460, 20.25, 0.25) AS DOUBLE) AS suction_pressure_bar,
    CAST(if(e % 640 = 480, 80.5, 18 + k % 10) AS DOUBLE) AS water_temperature_c,
    CAST(if(e % 640 = 500, 100000.5, 1000 + e % 4000) AS DOUBLE) AS operating_hours,
    CAST(if(e % 640 = 520, 50.5, CAST(e % 40 AS DOUBLE) / CAST(8.0 AS DOUBLE)) AS DOUBLE) AS vibration_mm_s,
    CAST(CASE WHEN et = 'error' THEN 301 + 7 * (e % 3) ELSE 0 END AS INT) AS error_code,
    CASE WHEN e % 640 = 80 THEN '  ' WHEN e % 640 = 260 THEN NULL WHEN e % 640 = 17 THEN 'IDLE' WHEN et <> 'error' THEN 'OPERATIONAL'
         WHEN e % 3 = 0 THEN 'FAULTED' WHEN e % 3 = 1 THEN 'ALERT' ELSE 'DEGRADED' END AS status,
    CAST(CASE e % 640 WHEN 540 THEN -40.5 WHEN 620 THEN 60.5 ELSE 25 + k % 10 END AS DOUBLE) AS ambient_temperature_c,
    CAST(if(e % 640 = 560, 100.5, k % 100) AS DOUBLE) AS humidity_percent,
    e % 640 <> 40 AS has_pump, e % 640 <> 220 AS has_solar, e % 640 <> 240 AS has_system,
    e % 7 <> 3 OR e % 640 IN (540, 560, 620) AS has_environment, e % 11 <> 5 AS has_location, e % 640 <> 140 AS parse_ok
  FROM b),
p AS (
  SELECT *, concat(
    '{"pump_id":', CASE WHEN pump_id IS NULL THEN 'null' ELSE concat('"', pump_id, '"') END,
    ',"timestamp":', CASE WHEN ts_text IS NULL THEN 'null' ELSE concat('"', ts_text, '"') END, ',"location":',
    CASE WHEN has_location THEN concat('{"latitude":', latitude, ',"longitude":', longitude, ',"region":"', region, '"}') ELSE 'null' END,
    ',"solar_panel":', CASE WHEN has_solar THEN concat('{"irradiance_w_m2":', irradiance_w_m2, ',"voltage_v":', solar_voltage_v,
    ',"current_a":', CASE WHEN solar_current_a = 0.0008 THEN '8.0E-4' ELSE CAST(solar_current_a AS VARCHAR) END,
    ',"power_w":', solar_power_w, ',"temperature_c":', solar_temperature_c, '}') ELSE 'null' END, ',"pump":',
    CASE WHEN has_pump THEN concat('{"motor_voltage_v":', motor_voltage_v, ',"motor_current_a":', motor_current_a,
      ',"rpm":', rpm, ',"flow_rate_lpm":', flow_rate_lpm, ',"discharge_pressure_bar":', discharge_pressure_bar,
      ',"suction_pressure_bar":', suction_pressure_bar, ',"water_temperature_c":', water_temperature_c, '}') ELSE 'null' END,
    ',"system":', CASE WHEN has_system THEN concat('{"operating_hours":', operating_hours, ',"vibration_mm_s":', vibration_mm_s,
    ',"error_code":', error_code, ',"status":', CASE WHEN status IS NULL THEN 'null' ELSE concat('"', status, '"') END, '}') ELSE 'null' END,
    ',"environment":',
    CASE WHEN has_environment THEN concat('{"ambient_temperature_c":', ambient_temperature_c,
      ',"humidity_percent":', humidity_percent, '}') ELSE 'null' END, '}') AS message
  FROM m),
"""

_RANGES = [
    ("solar_panel.irradiance_w_m2", "irradiance_w_m2", 0.0, 1500.0),
    ("solar_panel.voltage_v", "solar_voltage_v", 0.0, 100.0),
    ("solar_panel.current_a", "solar_current_a", 0.0, 30.0),
    ("solar_panel.power_w", "solar_power_w", 0.0, 3000.0),
    ("solar_panel.temperature_c", "solar_temperature_c", -40.0, 90.0),
    ("pump.motor_voltage_v", "motor_voltage_v", 0.0, 100.0),
    ("pump.motor_current_a", "motor_current_a", 0.0, 30.0),
    ("pump.rpm", "CAST(rpm AS DOUBLE)", 0.0, 5000.0),
    ("pump.flow_rate_lpm", "flow_rate_lpm", 0.0, 500.0),
    ("pump.discharge_pressure_bar", "discharge_pressure_bar", 0.0, 20.0),
    ("pump.suction_pressure_bar", "suction_pressure_bar", 0.0, 20.0),
    ("pump.water_temperature_c", "water_temperature_c", 0.0, 80.0),
    ("system.vibration_mm_s", "vibration_mm_s", 0.0, 50.0),
    ("system.operating_hours", "operating_hours", 0.0, 100000.0),
    ("environment.ambient_temperature_c", "ambient_temperature_c", -40.0, 60.0),
    ("environment.humidity_percent", "humidity_percent", 0.0, 100.0),
]
_STRICT = [("location.latitude", "latitude", -90.0, 90.0), ("location.longitude", "longitude", -180.0, 180.0)]


def _judged(strict: bool = False) -> str:
    """CTEs up to ``j``: verdict of every row."""
    cases = [
        ("NOT parse_ok", "DESERIALIZATION_ERROR", "'JSON parse error: malformed document'"),
        ("coalesce(trim(pump_id), '') = ''", "SCHEMA", "'pump_id is required'"),
        ("coalesce(trim(ts_text), '') = ''", "SCHEMA", "'timestamp is required'"),
        ("NOT has_solar", "SCHEMA", "'solar_panel is required'"),
        ("NOT has_pump", "SCHEMA", "'pump is required'"),
        ("NOT has_system", "SCHEMA", "'system is required'"),
        ("coalesce(trim(status), '') = ''", "SCHEMA", "'system.status is required'"),
    ]
    if strict:
        naming = "concat('pump_id does not follow the naming convention: ', pump_id)"
        cases.append(("NOT regexp_full_match(pump_id, 'PUMP_[0-9]{3,}')", "SCHEMA", naming))
        cases.append(("NOT has_location", "SCHEMA", "'location is required'"))
        cases.append(("status = 'IDLE'", "SCHEMA", "concat('unknown system.status: ', status)"))
    cases += [
        ("ts_text = 'not-a-date'", "TIMESTAMP", "concat('Invalid ISO8601 timestamp: ', ts_text)"),
        (
            "ts_text = '2024-01-02T00:10:00.000000Z'",
            "TIMESTAMP",
            "concat('Timestamp is in the future: ', ts_text)",
        ),
    ]
    for path, column, low, high in _RANGES + (_STRICT if strict else []):
        section = path.split(".")[0]
        there = f"has_{section} AND " if section in ("environment", "location") else ""
        cases.append(
            (
                f"({there}({column} < {low} OR {column} > {high}))",
                "RANGE",
                f"concat('{path}=', {column}, ' out of range [{low}, {high}]')",
            )
        )
    kind = " ".join(f"WHEN {test} THEN '{error}'" for test, error, _ in cases)
    reason = " ".join(f"WHEN {test} THEN {text}" for test, _, text in cases)
    return (
        "WITH "
        + _TELEMETRY
        + f"j AS (SELECT *, CASE {kind} END AS error_type, CASE {reason} END AS error_reason FROM p)"
    )


_TABLES = (
    _judged()
    + """,
raw_telemetry AS (
  SELECT event_time AS time, pump_id,
    CASE WHEN has_location THEN latitude ELSE 0.0 END AS latitude,
    CASE WHEN has_location THEN longitude ELSE 0.0 END AS longitude,
    CASE WHEN has_location THEN region ELSE 'UNKNOWN' END AS region,
    irradiance_w_m2, solar_voltage_v, solar_current_a, solar_power_w, solar_temperature_c,
    motor_voltage_v, motor_current_a, rpm, flow_rate_lpm, discharge_pressure_bar, suction_pressure_bar,
    water_temperature_c, operating_hours, vibration_mm_s, error_code, status,
    CASE WHEN has_environment THEN ambient_temperature_c ELSE 0.0 END AS ambient_temperature_c,
    CASE WHEN has_environment THEN humidity_percent ELSE 0.0 END AS humidity_percent
  FROM j WHERE error_type IS NULL),
dlq_records AS (
  SELECT event_time AS error_timestamp,
    CASE WHEN parse_ok THEN pump_id ELSE 'UNKNOWN' END AS pump_id, error_type, error_reason,
    CASE WHEN parse_ok THEN message ELSE left(message, length(message) - 1) END AS original_payload
  FROM j WHERE error_type IS NOT NULL)
"""
)


def _windows(size: str, minutes: int, source: str = "raw_telemetry") -> str:
    stats = ", ".join(
        f"{_round3(f'{stat}({column})')} AS {stat}_{name}"
        for name, column in (
            ("flow_rate", "flow_rate_lpm"),
            ("solar_power", "solar_power_w"),
            ("vibration", "vibration_mm_s"),
        )
        for stat in ("avg", "max", "min")
    )
    return f"""SELECT time_bucket(INTERVAL '{minutes} minutes', time) AS window_start,
      time_bucket(INTERVAL '{minutes} minutes', time) + INTERVAL '{minutes} minutes' AS window_end,
      '{size}' AS window_size, pump_id, {stats}, count(*) AS record_count
      FROM {source} GROUP BY 1, 2, 4"""


def _custom(size: str, minutes: int) -> str:
    flow, solar = "flow_rate_lpm", "solar_power_w"
    stats = [f"{_round3(f'sum({flow})')} AS sum_flow_rate", f"{_round3(f'avg({flow})')} AS avg_flow_rate", f"count({flow}) AS count_flow_rate"]
    stats += [f"{_round3(f'var_samp({flow})')} AS variance_flow_rate", f"{_round3(f'stddev_samp({flow})')} AS stddev_flow_rate"]
    stats += [f"{_round3(f'{s}(vibration_mm_s)')} AS {s}_vibration" for s in ("min", "max")] + ["count(DISTINCT vibration_mm_s) AS distinct_vibration"]
    stats += [f"{_round3(f'{s}({solar})')} AS {s}_solar_power" for s in ("avg", "max", "min")]
    return f"""SELECT time_bucket(INTERVAL '{minutes} minutes', time) AS window_start,
      time_bucket(INTERVAL '{minutes} minutes', time) + INTERVAL '{minutes} minutes' AS window_end,
      '{size}' AS window_size, pump_id, {", ".join(stats)}, count(*) AS record_count
      FROM raw_telemetry GROUP BY 1, 2, 4"""


def _streamed(size: str, minutes: int) -> str:
    """Windows of a stream: open are those that end later than the last reading minus the delay."""
    return f"""{_TABLES}, w AS ({_windows(size, minutes)})
      SELECT *, window_end > (SELECT max(time) FROM raw_telemetry) - INTERVAL '10 seconds' AS is_open FROM w"""


_LATE = f"""{_TABLES}, v AS (
  SELECT *, least((epoch_us(event_time) - 1704067200000000) // 28800000000 + CASE WHEN e % 16 = 5 THEN 1 ELSE 0 END, 3) AS slice
  FROM j WHERE error_type IS NULL),
marks AS (SELECT slice, max(epoch_us(event_time)) // 1000 * 1000 - 10000000 AS mark FROM v GROUP BY slice),
l AS (
  SELECT v.event_time AS time, pump_id, flow_rate_lpm, time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
    (SELECT max(mark) FROM marks WHERE marks.slice < v.slice) AS mark FROM v),
late AS (SELECT *, make_timestamp(mark) AS watermark FROM l WHERE epoch_us(window_start) + 300000000 <= mark)
"""


_SAMPLES = """WITH counts AS (
  SELECT event_type AS kind,
    (epoch_us(make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 30)) - 1704067200000000)
      // 15000000 AS slot,
    count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k
  FROM events GROUP BY 1, 2),
grid AS (SELECT kind, slot FROM (SELECT DISTINCT kind FROM counts), (SELECT unnest(range(0, 5760)) AS slot)),
s AS (
  SELECT kind, slot, make_timestamp(1704067200000000 + (slot + 1) * 15000000) AS ts,
    CAST(coalesce(n, 0) AS DOUBLE) AS gauge,
    CAST(sum(coalesce(n, 0)) OVER w AS DOUBLE) AS total_n,
    CAST(sum(coalesce(k, 0)) OVER w AS DOUBLE) AS total_k
  FROM grid LEFT JOIN counts USING (kind, slot)
  WINDOW w AS (PARTITION BY kind, slot >= 2880 ORDER BY slot))
"""


def _extrapolated(value: str, range_s: int, step_s: int, name: str) -> str:
    """CTEs giving ``kind, t, inc`` of one counter column."""
    copies = ", ".join(str(i * step_s) for i in range(range_s // step_s))
    return f""", {name}_a AS (
      SELECT kind, {value} AS v, epoch_us(ts) / 1e6 AS sec,
        CAST(ceil(epoch_us(ts) / 1e6 / {step_s}) * {step_s} AS BIGINT) + unnest([{copies}]) AS t
      FROM s),
    {name}_b AS (SELECT *, lag(v) OVER (PARTITION BY kind, t ORDER BY sec) AS pv FROM {name}_a),
    {name}_c AS (
      SELECT kind, t, count(*) AS n, min(sec) AS a, max(sec) AS z, min_by(v, sec) AS first,
        coalesce(sum(CASE WHEN v < pv THEN v ELSE v - pv END), 0) AS gain
      FROM {name}_b GROUP BY kind, t HAVING count(*) >= 2),
    {name}_d AS (
      SELECT *, z - a AS span, (z - a) / (n - 1) AS gap, a - t + {range_s} AS s0, t - z AS e0 FROM {name}_c),
    {name}_e AS (
      SELECT *, CASE WHEN s0 >= gap * 1.1 THEN gap / 2 ELSE s0 END AS s1,
        CASE WHEN e0 >= gap * 1.1 THEN gap / 2 ELSE e0 END AS e1,
        CASE WHEN gain > 0 AND first >= 0 THEN span * first / gain END AS zero FROM {name}_d),
    {name} AS (
      SELECT kind, make_timestamp(t * 1000000) AS ts, gain,
        gain * (span + least(s1, coalesce(zero, s1)) + e1) / span AS inc FROM {name}_e)
    """


def _select(body: str) -> str:
    return f"{_TABLES} {body}"


def oracle_sql() -> dict[str, str]:
    verdicts = "SELECT coalesce(error_type, 'OK') AS verdict, count(*) AS n FROM j GROUP BY 1"
    out = {
        "validate_counts": f"{_judged()} {verdicts}",
        "validate_strict_counts": f"{_judged(strict=True)} {verdicts}",
        "parse_counts": f"{_judged()} {verdicts}",
        "raw_telemetry": _select("SELECT * FROM raw_telemetry"),
        "raw_telemetry_json": _select("SELECT * FROM raw_telemetry"),
        "dlq_records": _select("SELECT * FROM dlq_records"),
        "dlq_records_json": _select("SELECT * FROM dlq_records"),
        "landed_outcomes": _select(
            """SELECT CASE WHEN error_type IS NULL THEN 'valid' ELSE 'dlq' END AS outcome,
            strftime(event_time, '%Y-%m-%d') AS day, count(*) AS n, count(error_reason) AS n_dead,
            count(*) FILTER (WHERE error_type IS NULL AND has_location) AS n_location,
            count(*) FILTER (WHERE error_type IS NULL AND has_environment) AS n_environment FROM j GROUP BY 1, 2"""
        ),
        "valid_json": _select("SELECT message AS value FROM j WHERE error_type IS NULL"),
        "dlq_json": _select(
            r"""SELECT concat('{"original_payload":"', replace(original_payload, '"', '\"'),
            '","error_reason":"', error_reason, '","error_type":"', error_type, '","pump_id":',
            CASE WHEN pump_id IS NULL THEN 'null' ELSE concat('"', pump_id, '"') END,
            ',"failed_at":"', strftime(error_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ'), '"}') AS value FROM dlq_records"""
        ),
        "pipeline_counters": f"""{_judged()} SELECT count(*) FILTER (WHERE parse_ok) AS records_processed,
            count(*) FILTER (WHERE error_type = 'SCHEMA') AS validation_errors_schema,
            count(*) FILTER (WHERE error_type = 'TIMESTAMP') AS validation_errors_timestamp,
            count(*) FILTER (WHERE error_type = 'RANGE') AS validation_errors_range,
            count(*) FILTER (WHERE error_type IS NULL) AS records_valid FROM j""",
        "agg_1m": _select(_windows("1m", 1)),
        "agg_5m": _select(_windows("5m", 5)),
        "aggregated_metrics": _select(f"{_windows('1m', 1)} UNION ALL {_windows('5m', 5)}"),
        "agg_custom": _select(f"{_custom('1m', 1)} UNION ALL {_custom('5m', 5)}"),
        "agg_quantiles": _select(
            """SELECT count(*) AS windows, count(*) AS close FROM (
              SELECT DISTINCT pump_id, date_trunc('hour', time) FROM raw_telemetry)"""
        ),
        "stream_agg_1m": _streamed("1m", 1),
        "stream_agg_5m": _streamed("5m", 5),
        "stream_restart_5m": _select(_windows("5m", 5)),
        "late_rows": f"{_LATE} SELECT time, pump_id, flow_rate_lpm, window_start, watermark FROM late",
        "late_windows": f"""{_LATE}, c AS (
              SELECT window_start, pump_id, count(*) AS record_count,
                count(*) FILTER (WHERE coalesce(epoch_us(window_start) + 300000000 > mark, true)) AS stream_count
              FROM l GROUP BY ALL)
            SELECT *, record_count - stream_count AS late_count FROM c WHERE stream_count < record_count""",
        "dead_reasons": " UNION ALL ".join(
            f"""SELECT * FROM ({_judged(strict)} SELECT '{profile}' AS profile, error_type, error_reason, count(*) AS n
              FROM j WHERE error_type IS NOT NULL GROUP BY ALL)"""
            for profile, strict in (("standard", False), ("strict", True))
        ),
        "validate_extra_rules": f"""{_judged()}, x AS (
              SELECT *, CASE WHEN error_type IS NOT NULL THEN error_type
                WHEN rpm <> 0 AND flow_rate_lpm / rpm > 10 THEN 'RANGE' WHEN rpm = 0 THEN 'PROCESSING_ERROR'
                WHEN has_environment AND humidity_percent > 98 THEN 'RANGE'
                WHEN NOT has_environment THEN 'PROCESSING_ERROR' ELSE 'OK' END AS verdict FROM j)
            SELECT verdict, CASE WHEN verdict = 'PROCESSING_ERROR' THEN concat('Unexpected processing error: undecidable ',
                CASE WHEN rpm = 0 THEN 'flow per turn' ELSE 'extra rule 2' END) END AS reason, count(*) AS n
            FROM x GROUP BY 1, 2""",
        "q1_top_water": _select(
            f"""SELECT pump_id, {_num("sum(flow_rate_lpm * (5.0 / 60.0))", 2)} AS total_liters,
            {_num("sum(flow_rate_lpm * (5.0 / 60.0)) / 1000.0", 2)} AS cubic_meters
            FROM raw_telemetry WHERE time >= {AS_OF} - INTERVAL '24 hours'
            GROUP BY pump_id ORDER BY total_liters DESC, pump_id LIMIT 10"""
        ),
        "q2_offline": _select(
            f"""SELECT pump_id, last_seen, us AS inactivity, us / CAST(1000000 AS DOUBLE) AS inactivity_seconds FROM (
              SELECT pump_id, max(time) AS last_seen,
                greatest(epoch_us(max(max(time)) OVER ()), epoch_us({AS_OF})) - epoch_us(max(time)) AS us
              FROM raw_telemetry GROUP BY pump_id) WHERE us > 300 * 1000000"""
        ),
        "q3_hourly_solar": _select(
            f"""SELECT date_trunc('hour', time) AS hour_bucket, pump_id,
            {_num("avg(solar_power_w)", 2)} AS avg_power_w, {_num("max(solar_power_w)", 2)} AS peak_power_w
            FROM raw_telemetry WHERE time >= {AS_OF} - INTERVAL '48 hours' GROUP BY 1, 2"""
        ),
        "q4_error_codes": _select(
            """SELECT error_code, status, CAST(sum(n) AS BIGINT) AS occurrences,
              string_agg(pump_id, ',' ORDER BY pump_id) FILTER (WHERE place <= 5) AS sample_pumps, max(seen) AS last_seen
            FROM (SELECT error_code, status, pump_id, count(*) AS n, max(time) AS seen,
                row_number() OVER (PARTITION BY error_code, status ORDER BY pump_id) AS place
              FROM raw_telemetry WHERE NOT (error_code = 0 AND status = 'OPERATIONAL')
              GROUP BY error_code, status, pump_id)
            GROUP BY error_code, status"""
        ),
        "q5_latest_dlq": _select(
            """SELECT error_timestamp, pump_id, error_type, error_reason, original_payload FROM dlq_records
            ORDER BY error_timestamp DESC, pump_id NULLS FIRST, error_type, error_reason LIMIT 1"""
        ),
        "o1_pumps_online": _select(
            f"""SELECT {AS_OF} AS time, count(DISTINCT pump_id) AS pumps_online
            FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '5 minutes'"""
        ),
        "o2_water_today": _select(
            f"""SELECT {DAY_END} AS time, {_num("sum(flow_rate_lpm * 5.0 / 60.0)", 1)} AS litres_today
            FROM raw_telemetry WHERE time > date_trunc('day', {DAY_END})"""
        ),
        "o3_avg_solar": _select(
            f"""SELECT {AS_OF} AS time, {_num("avg(solar_power_w)", 1)} AS avg_solar_power
            FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '5 minutes'"""
        ),
        "o4_latest_status": _select(
            f"""SELECT pump_id, latitude, longitude, region, status, error_code, flow_rate_lpm, solar_power_w, time
            FROM (SELECT *, row_number() OVER (PARTITION BY pump_id ORDER BY time DESC, latitude DESC, longitude DESC,
              region DESC, status DESC, error_code DESC, flow_rate_lpm DESC, solar_power_w DESC) AS r
              FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '5 minutes') WHERE r = 1"""
        ),
        "o7_error_dist": _select(
            f"""SELECT CASE WHEN error_code = 0 THEN 'No Error (0)' ELSE concat('Error ', error_code) END AS error_code,
            count(*) AS count FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '15 minutes' GROUP BY raw_telemetry.error_code"""
        ),
        "o8_solar_ts": _select(
            f"""SELECT time_bucket(INTERVAL '1 minute', time) AS time, round(avg(irradiance_w_m2), 6) AS avg_irradiance_w_m2,
            round(avg(solar_power_w), 6) AS avg_solar_power_w FROM raw_telemetry
            WHERE time BETWEEN {AS_OF} - INTERVAL '1 hour' AND {AS_OF} GROUP BY 1"""
        ),
        "o9_underperforming": _select(
            f"""SELECT pump_id, {_num("avg(flow_rate_lpm)", 2)} AS avg_flow_rate,
            {_num("avg(solar_power_w)", 2)} AS avg_solar_power, max(error_code) AS last_error_code,
            count(*) AS readings, max(region) AS region
            FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '15 minutes'
            GROUP BY pump_id ORDER BY avg_flow_rate, pump_id LIMIT 10"""
        ),
        "d1_success_rate": _select(
            f""", c AS (SELECT (SELECT count(*) FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '1 hour') AS good,
              (SELECT count(*) FROM dlq_records WHERE error_timestamp > {AS_OF} - INTERVAL '1 hour') AS bad)
            SELECT {AS_OF} AS time, CASE WHEN good + bad = 0 THEN 1.0
              ELSE round(CAST(good AS DOUBLE) / (good + bad), 9) END AS success_rate FROM c"""
        ),
        "d2_valid": _select(
            f"SELECT {AS_OF} AS time, count(*) AS valid FROM raw_telemetry WHERE time > {AS_OF} - INTERVAL '1 hour'"
        ),
        "d3_dlq": _select(
            f"""SELECT {AS_OF} AS time, count(*) AS dlq FROM dlq_records
            WHERE error_timestamp > {AS_OF} - INTERVAL '1 hour'"""
        ),
        "d4_dlq_rate": _select(
            f"""SELECT time_bucket(INTERVAL '1 minute', error_timestamp) AS time, count(*) AS dlq_messages
            FROM dlq_records WHERE error_timestamp BETWEEN {AS_OF} - INTERVAL '1 hour' AND {AS_OF} GROUP BY 1"""
        ),
        "d5_error_types": _select(
            f"""SELECT error_type AS metric, count(*) AS value, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
            FROM dlq_records WHERE error_timestamp > {AS_OF} - INTERVAL '1 hour' GROUP BY error_type"""
        ),
        "d6_freshness": _select(
            f"""SELECT pump_id, max(time) AS last_seen,
            CAST(round(epoch_us({AS_OF} - max(time)) / 1000000.0) AS INT) AS seconds_since_last,
            max(region) AS region, max(status) AS last_status,
            (max((time, status)))[2] AS true_status FROM raw_telemetry GROUP BY pump_id"""
        ),
        "d7_recent_dlq": _select(
            """SELECT error_timestamp, pump_id, error_type, error_reason, left(original_payload, 500) AS original_payload
            FROM dlq_records ORDER BY error_timestamp DESC, pump_id NULLS FIRST, error_type, error_reason LIMIT 10"""
        ),
        "d8_error_reasons": _select(
            f"""SELECT error_reason, error_type, count(*) AS count FROM dlq_records
            WHERE error_timestamp > {AS_OF} - INTERVAL '1 hour' GROUP BY 1, 2"""
        ),
        "h_instant": f"""{_SAMPLES} SELECT kind, max(ts) AS ts, max_by(total_n, ts) AS value FROM s
            WHERE ts > {AS_OF} - INTERVAL '5 minutes' AND ts <= {AS_OF} GROUP BY kind""",
        "h_select_label": f"{_SAMPLES} SELECT kind AS queue, ts, gauge AS value FROM s WHERE kind = 'error'",
        "h_select_regex": f"""{_SAMPLES} SELECT kind AS queue, ts, gauge AS value FROM s
            WHERE regexp_full_match(kind, 's.*|view')""",
        "h_range": f"""{_SAMPLES} SELECT kind AS queue, ts, gauge AS value FROM s
            WHERE ts BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-01 18:00:00'""",
        "h_increase": _SAMPLES + _extrapolated("total_n", 60, 60, "i")
        + "SELECT kind, ts, round(inc, 6) AS value FROM i",
        "h_increase_observed": _SAMPLES + _extrapolated("total_n", 60, 60, "i")
        + "SELECT kind, ts, round(gain, 6) AS value FROM i",
        "h_rate": _SAMPLES + _extrapolated("total_n", 60, 30, "i")
        + "SELECT kind, ts, round(inc / 60, 6) AS value FROM i",
        "h_rate_per_minute": _SAMPLES + _extrapolated("total_n", 60, 60, "i")
        + "SELECT kind, ts, round(inc / 60 * 60, 6) AS value FROM i WHERE kind = 'error'",
        "h_sum_rate": _SAMPLES + _extrapolated("total_n", 60, 60, "i")
        + "SELECT ts, round(sum(inc / 60), 6) AS value FROM i GROUP BY ts",
        "h_rate_ratio": _SAMPLES + _extrapolated("total_k", 300, 60, "x") + _extrapolated("total_n", 300, 60, "y")
        + """SELECT kind, ts, CASE WHEN y.inc <> 0 THEN round((x.inc / 300) / (y.inc / 300), 6)
              WHEN x.inc > 0 THEN CAST('infinity' AS DOUBLE) ELSE CAST('nan' AS DOUBLE) END AS value
            FROM x JOIN y USING (kind, ts)""",
        "h_summarize": f"""{_SAMPLES} SELECT kind AS queue, round(avg(gauge), 6) AS mean, max(gauge) AS max
            FROM s GROUP BY kind""",
        "b_value_map": _select(
            """SELECT error_type, count(*) AS n,
            CASE error_type WHEN 'DESERIALIZATION_ERROR' THEN 'DESER' ELSE error_type END AS label,
            CASE error_type WHEN 'SCHEMA' THEN 'orange' WHEN 'RANGE' THEN 'yellow'
              WHEN 'TIMESTAMP' THEN 'purple' ELSE 'red' END AS color FROM dlq_records GROUP BY error_type"""
        ),
        "b_pivot": _select(
            "SELECT time_bucket(INTERVAL '1 minute', time) AS time, "
            + ", ".join(
                f"round(sum(flow_rate_lpm) FILTER (WHERE region = '{r}'), 6) AS {r.lower()}"
                for r in ("Foothill", "Lagoon", "Polder", "UNKNOWN")
            )
            + " FROM raw_telemetry GROUP BY 1"
        ),
    }
    out["b_band"] = out["d6_freshness"].replace(
        "SELECT pump_id, max(time) AS last_seen,", ", f AS (SELECT pump_id, max(time) AS last_seen,"
    ) + (
        """) SELECT pump_id, seconds_since_last, CASE WHEN seconds_since_last >= 120 THEN 'red'
        WHEN seconds_since_last >= 30 THEN 'yellow' ELSE 'green' END AS band FROM f"""
    )
    out["o1_pumps_by_hour"] = _select(
        "SELECT date_trunc('hour', time) AS time, count(DISTINCT pump_id) AS pumps_online, true AS close FROM raw_telemetry GROUP BY 1"
    )
    for name in ("q2_offline", "q4_error_codes", "d6_freshness"):
        out[f"{name}_rollup"] = out[name]
    flows = f"""SELECT time_bucket(INTERVAL '1 minute', time) AS time, pump_id, {{fn}}(flow_rate_lpm) AS x
        FROM raw_telemetry WHERE time BETWEEN {AS_OF} - INTERVAL '1 hour' AND {AS_OF} GROUP BY 1, 2"""
    for name, fn in (("o5_flow_avg", "avg"), ("o6_flow_sum", "sum")):
        out[name] = _select(
            f", f AS ({flows.format(fn=fn)}) SELECT time, pump_id, round(x, 6) AS flow_rate FROM f"
        )
    out["o6_flow_stacked"] = _select(
        f""", f AS ({flows.format(fn="sum")}) SELECT time, pump_id, round(x, 6) AS flow_rate,
        round(sum(x) OVER (PARTITION BY time ORDER BY pump_id), 6) AS stacked FROM f"""
    )
    minutes = "SELECT time_bucket(INTERVAL '1 minute', error_timestamp) AS time, count(*) AS n FROM dlq_records GROUP BY 1"
    out["b_reduce_last"] = _select(f", f AS ({minutes}) SELECT max_by(n, time) AS dlq_messages FROM f")
    out["b_reduce_sum"] = _select(f", f AS ({minutes}) SELECT CAST(sum(n) AS BIGINT) AS dlq_messages FROM f")
    return out
