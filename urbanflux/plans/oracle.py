"""The queries once more as SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from urbanflux import constants as K

# ------------------------------------------------------------------- shared subqueries

_E = "e AS (SELECT *, CAST(props->>'k' AS INTEGER) AS k FROM events)"
_INDEX = "round(greatest(CAST(0 AS DOUBLE), 1 - {speed} / 55), 2)"
_ISO = "strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f')"
_DATE_KEY = "CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"
_TIME_KEY = "CAST(strftime({ts}, '%H%M') AS INTEGER)"


def _keys(ts: str) -> str:
    return f"{_DATE_KEY.format(ts=ts)} AS date_key, {_TIME_KEY.format(ts=ts)} AS time_key"


def _levels(index: str) -> str:
    return " ".join(f"WHEN {index} >= {low} THEN '{label}'" for low, label in K.CONGESTION_LEVELS)


def _bands(hour: str) -> str:
    return " ".join(
        f"WHEN {hour} BETWEEN {first} AND {last} THEN '{label}'"
        for first, last, label in K.TIME_BANDS
    )


def _scores() -> str:
    return " ".join(f"WHEN '{name}' THEN {score}" for name, score in K.HAZARD_SCORES.items())


_TRAFFIC = f"""{_E},
t0 AS (
  SELECT event_id, user_id, ts, k,
    event_type = 'error' AND k >= 95 AS junk,
    CASE WHEN NOT (event_type = 'signup' AND k < 10) THEN 'SNS-' || user_id END AS sensor_id,
    round(value - 20, 2) AS speed,
    event_type = 'view' AND k = 50 AS no_index,
    event_type = 'click' AND k = 7 AS bad_time
  FROM e),
t AS (
  SELECT *,
    CASE WHEN NOT no_index THEN {_INDEX.format(speed="speed")} END AS congestion_index,
    CASE WHEN bad_time THEN 'soon' ELSE {_ISO.format(ts="ts")} END AS time_text
  FROM t0),
traffic AS (
  SELECT *,
    CASE WHEN junk THEN 'MALFORMED_JSON_STRING_' || event_id ELSE
      '{{' || CASE WHEN sensor_id IS NULL THEN '' ELSE '"sensor_id":"' || sensor_id || '",' END
      || '"speed":' || CAST(speed AS VARCHAR) || ',"vehicle_volume":' || k
      || ',"occupancy":' || CAST(k / CAST(100 AS DOUBLE) AS VARCHAR)
      || CASE WHEN no_index THEN '' ELSE
           ',"congestion_index":' || CAST(congestion_index AS VARCHAR) END
      || ',"timestamp":"' || time_text || '"}}' END AS payload,
    CASE WHEN junk THEN '{K.MALFORMED_REASON}'
         WHEN sensor_id IS NULL THEN '{K.MISSING_FIELD_REASON}sensor_id'
         WHEN congestion_index IS NULL THEN '{K.MISSING_FIELD_REASON}congestion_index'
         WHEN speed < 0 THEN '{K.NEGATIVE_SPEED_REASON}'
         WHEN bad_time THEN 'Unparseable time: timestamp' END AS strict_reason,
    junk OR sensor_id IS NULL OR speed < 0 AS job_invalid
  FROM t)"""

_GPS = f"""g0 AS (
  SELECT event_id, user_id, ts, k, event_type,
    round(value - 95, 2) AS latitude, round(value * 2 - 180, 2) AS longitude,
    CAST(k - 2 AS DOUBLE) AS speed
  FROM e),
gps AS (
  SELECT *,
    '{{"vehicle_id":"VH-' || user_id || '"'
      || CASE WHEN event_type = 'view' THEN '' ELSE ',"route_id":"RT-' || k || '"' END
      || ',"latitude":' || CAST(latitude AS VARCHAR)
      || ',"longitude":' || CAST(longitude AS VARCHAR) || ',"speed":' || CAST(speed AS VARCHAR)
      || ',"timestamp":"' || {_ISO.format(ts="ts")} || '"}}' AS payload,
    CASE WHEN latitude < -90 OR latitude > 90 THEN '{K.LATITUDE_REASON}'
         WHEN longitude < -180 OR longitude > 180 THEN '{K.LONGITUDE_REASON}'
         WHEN speed < 0 THEN '{K.NEGATIVE_SPEED_REASON}' END AS reason
  FROM g0)"""

_SENSORS = """sensors AS (
  SELECT c_custkey + 1 AS sensor_key, 'SNS-' || c_custkey AS sensor_id,
    c_mktsegment AS location_name, CAST(c_nationkey AS DOUBLE) AS latitude,
    c_acctbal AS longitude, c_acctbal >= 0 AS is_current
  FROM customer)"""

_VEHICLES = """vehicles AS (
  SELECT c_custkey * 2 + v AS vehicle_key, 'VH-' || c_custkey AS vehicle_id,
    CASE WHEN c_acctbal >= 0 THEN 'BUS' ELSE 'TAXI' END AS vehicle_type,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'RT-' || CASE
      WHEN c_mktsegment = 'MACHINERY' AND v = 1 THEN c_nationkey + 100
      ELSE c_nationkey END END AS assigned_route_id,
    v = 1 AS is_current
  FROM customer, (VALUES (0), (1)) AS versions(v))"""

_CALENDAR = """dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day,
    CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
    isodow(d) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(min({ts})::DATE, max({ts})::DATE, INTERVAL 1 DAY)) AS d
        FROM {table}) AS days),
dim_time AS (
  SELECT CAST(m // 60 * 100 + m % 60 AS INTEGER) AS time_key, CAST(m // 60 AS INTEGER) AS hour,
    CAST(m % 60 AS INTEGER) AS minute
  FROM range(1440) AS minutes(m))"""

_EVENT_CALENDAR = _CALENDAR.format(ts="ts", table="events")
_ORDER_CALENDAR = _CALENDAR.format(ts="o_orderdate", table="orders")

_READINGS = f"""readings AS (
  SELECT user_id + 1 AS sensor_key, {_keys("ts")}, value AS speed, k AS vehicle_volume,
    k / CAST(100 AS DOUBLE) AS occupancy, {_INDEX.format(speed="value")} AS congestion_index
  FROM e)"""

_PINGS = f"""pings AS (
  SELECT event_id AS ping_id, ts, value AS speed, {_keys("ts")},
    user_id * 2 + CAST(ts >= TIMESTAMP '2024-01-15' AS INTEGER) AS vehicle_key
  FROM events)"""

# ------------------------------------------------------------------------ view queries

_CONGESTION_VIEW = f"""{_E}, {_SENSORS}, {_EVENT_CALENDAR}, {_READINGS},
v_congestion AS (
  SELECT sensor_id, location_name, latitude, longitude, date, year, month_name, day_name,
    is_weekend, hour, minute, speed, vehicle_volume, occupancy, congestion_index,
    CASE {_levels("congestion_index")} ELSE '{K.LOWEST_CONGESTION_LEVEL}' END AS congestion_level
  FROM readings JOIN sensors USING (sensor_key) JOIN dim_date USING (date_key)
  JOIN dim_time USING (time_key))"""

_TRAVEL_VIEW = f"""{_VEHICLES}, {_EVENT_CALENDAR}, {_PINGS},
v_travel AS (
  SELECT vehicle_id, vehicle_type, assigned_route_id, date, hour,
    avg(speed) AS avg_speed_mph,
    CASE WHEN avg(speed) > 0 THEN 60 / avg(speed) ELSE 0 END AS estimated_minutes_per_mile
  FROM pings JOIN vehicles USING (vehicle_key) JOIN dim_date USING (date_key)
  JOIN dim_time USING (time_key)
  GROUP BY ALL)"""

_HOTSPOT_VIEW = f"""{_E}, {_EVENT_CALENDAR},
incidents AS (
  SELECT event_type AS incident_type,
    CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'MAJOR'
                    WHEN 'signup' THEN 'MINOR' END AS severity,
    'Zone ' || (k % 10) AS location_name, CAST(k % 10 AS DOUBLE) AS latitude,
    CAST(k AS DOUBLE) AS longitude, {_keys("ts")}
  FROM e),
v_hotspots AS (
  SELECT incident_type, severity, location_name, latitude, longitude, date, hour,
    count(*) AS incident_count,
    CAST(CASE severity {_scores()} ELSE {K.OTHER_HAZARD_SCORE} END AS INTEGER) AS hazard_score
  FROM incidents JOIN dim_date USING (date_key) JOIN dim_time USING (time_key)
  GROUP BY ALL)"""

_PUNCTUALITY_VIEW = f"""{_VEHICLES}, {_PINGS},
route_pings AS (
  SELECT assigned_route_id, ts,
    lead(ts) OVER (PARTITION BY vehicle_id ORDER BY ts, ping_id) AS next_ts
  FROM pings JOIN vehicles USING (vehicle_key)
  WHERE vehicle_type = 'BUS' AND assigned_route_id IS NOT NULL),
gaps AS (
  SELECT assigned_route_id,
    avg(CAST(epoch_us(next_ts) - epoch_us(ts) AS DOUBLE) / 60000000) AS gap
  FROM route_pings WHERE next_ts IS NOT NULL GROUP BY assigned_route_id),
v_punctuality AS (
  SELECT assigned_route_id, gap AS avg_actual_gap_minutes,
    CASE WHEN gap > 460 THEN '{K.DELAYED}' WHEN gap < 420 THEN '{K.EARLY}'
         ELSE '{K.ON_SCHEDULE}' END AS punctuality_status
  FROM gaps)"""

_SCHEDULE_PUNCTUALITY = f"""{_VEHICLES}, {_PINGS}, schedules AS (
  SELECT 'RT-' || (n + o) AS route_id, CASE v WHEN 0 THEN 400 + n % 5 * 20 ELSE 430 + n % 7 * 10 END AS minutes,
    CASE WHEN v = 0 THEN TIMESTAMP '2024-01-01' WHEN n % 4 = 0 THEN TIMESTAMP '2024-01-12'
      ELSE TIMESTAMP '2024-01-10 06:00:00' END AS start_date,
    CASE v WHEN 0 THEN TIMESTAMP '2024-01-10 06:00:00' END AS end_date
  FROM (SELECT DISTINCT c_nationkey AS n FROM customer), (VALUES (0), (100)) offsets(o), (VALUES (0), (1)) versions(v)
  WHERE n % 6 <> 5),
route_pings AS (
  SELECT assigned_route_id, ts,
    lead(ts) OVER (PARTITION BY vehicle_id ORDER BY ts, ping_id) AS next_ts
  FROM pings JOIN vehicles USING (vehicle_key)
  WHERE vehicle_type = 'BUS' AND assigned_route_id IS NOT NULL),
gaps AS (
  SELECT assigned_route_id, minutes, avg(CAST(epoch_us(next_ts) - epoch_us(ts) AS DOUBLE) / 60000000) AS gap
  FROM route_pings LEFT JOIN schedules ON route_id = assigned_route_id
    AND start_date <= ts AND (end_date IS NULL OR ts < end_date)
  WHERE next_ts IS NOT NULL GROUP BY ALL)
SELECT assigned_route_id, CAST(minutes AS INTEGER) AS schedule_interval_minutes,
  round(gap, 6) AS avg_actual_gap_minutes,
  CASE WHEN gap > coalesce(minutes * CAST(1.02 AS DOUBLE), 460) THEN '{K.DELAYED}'
    WHEN gap < coalesce(minutes * CAST(0.98 AS DOUBLE), 420) THEN '{K.EARLY}'
    ELSE '{K.ON_SCHEDULE}' END AS punctuality_status
FROM gaps"""

_PEAK_VIEW = f"""{_E}, {_EVENT_CALENDAR}, {_READINGS},
v_peak AS (
  SELECT CASE {_bands("hour")} ELSE '{K.OFF_PEAK}' END AS time_period,
    day_name, avg(speed) AS avg_speed, avg(vehicle_volume) AS avg_volume,
    avg(congestion_index) AS avg_congestion_index
  FROM readings JOIN dim_date USING (date_key) JOIN dim_time USING (time_key)
  GROUP BY ALL)"""

# --------------------------------------------------------------- maintenance subqueries

_SENSOR_STATES = """source AS (
  SELECT 'SNS-' || c_custkey AS sensor_id, c_name AS location_name,
    CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal AS longitude, c_mktsegment AS status
  FROM customer),
dimension AS (
  SELECT c_custkey * 2 + 1 AS sensor_key, 'SNS-' || c_custkey AS sensor_id,
    c_name AS location_name, CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal AS longitude,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'MAINTENANCE' ELSE c_mktsegment END AS status,
    TIMESTAMP '2024-01-01' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date,
    TRUE AS is_current, TIMESTAMP '2024-01-01' AS created_at
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT c_custkey * 2 + 2, 'SNS-' || c_custkey, c_name, CAST(c_nationkey AS DOUBLE), c_acctbal,
    'PLANNED', TIMESTAMP '2023-01-01', TIMESTAMP '2024-01-01', FALSE, TIMESTAMP '2023-01-01'
  FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'),
classified AS (
  SELECT s.*, d.sensor_key,
    CASE WHEN d.sensor_id IS NULL THEN 'new'
         WHEN s.location_name IS DISTINCT FROM d.location_name
           OR s.latitude IS DISTINCT FROM d.latitude OR s.longitude IS DISTINCT FROM d.longitude
           OR s.status IS DISTINCT FROM d.status THEN 'changed'
         ELSE 'unchanged' END AS change_type
  FROM source s LEFT JOIN dimension d ON s.sensor_id = d.sensor_id AND d.is_current)"""

_VEHICLE_STATES = """source AS (
  SELECT 'VH-' || c_custkey AS vehicle_id, c_name AS license_plate, 'BUS' AS vehicle_type,
    c_mktsegment AS operator_name,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'RT-' || c_nationkey END AS assigned_route_id,
    'IN_SERVICE' AS status
  FROM customer),
dimension AS (
  SELECT c_custkey + 1 AS vehicle_key, 'VH-' || c_custkey AS vehicle_id,
    c_name AS license_plate, 'BUS' AS vehicle_type,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'OTHER' ELSE c_mktsegment END AS operator_name,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'RT-0' WHEN 'FURNITURE' THEN NULL
      ELSE 'RT-' || c_nationkey END AS assigned_route_id,
    'IN_SERVICE' AS status, TIMESTAMP '2024-01-01' AS start_date,
    CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current,
    TIMESTAMP '2024-01-01' AS created_at
  FROM customer),
classified AS (
  SELECT s.*, d.vehicle_key,
    CASE WHEN d.vehicle_id IS NULL THEN 'new'
         WHEN s.license_plate IS DISTINCT FROM d.license_plate
           OR s.assigned_route_id IS DISTINCT FROM d.assigned_route_id
           OR s.status IS DISTINCT FROM d.status THEN 'changed'
         ELSE 'unchanged' END AS change_type,
    CASE WHEN d.vehicle_id IS NULL THEN 'new'
         WHEN s.license_plate <> d.license_plate OR s.assigned_route_id <> d.assigned_route_id
           OR s.status <> d.status THEN 'changed'
         ELSE 'unchanged' END AS plain_change_type
  FROM source s LEFT JOIN dimension d ON s.vehicle_id = d.vehicle_id AND d.is_current)"""


def _merge(key: str, entity: str, attributes: str) -> str:
    """Untouched and closed versions, then the opened ones with the next keys."""
    return f"""
SELECT d.* REPLACE (
  CASE WHEN closing THEN TIMESTAMP '2024-02-01' ELSE d.end_date END AS end_date,
  CASE WHEN closing THEN FALSE ELSE d.is_current END AS is_current)
FROM (SELECT dimension.*, dimension.is_current AND EXISTS (
        SELECT 1 FROM classified c WHERE c.{key} = dimension.{key} AND c.change_type = 'changed')
        AS closing FROM dimension) AS x(
        {key}, {entity}, {attributes}, start_date, end_date, is_current, created_at, closing)
JOIN dimension AS d USING ({key})
UNION ALL
SELECT (SELECT max({key}) FROM dimension) + row_number() OVER (ORDER BY {entity}),
  {entity}, {attributes}, TIMESTAMP '2024-02-01', CAST(NULL AS TIMESTAMP), TRUE,
  TIMESTAMP '2024-02-01'
FROM classified WHERE change_type IN ('new', 'changed')"""


_STATIONS = f"""known AS (
  SELECT s_suppkey + 1 AS station_key, 'WTH-' || s_suppkey AS station_id,
    s_name AS station_name, CAST(s_nationkey AS DOUBLE) AS latitude, s_acctbal AS longitude,
    TIMESTAMP '2024-01-01' AS created_at
  FROM supplier WHERE s_acctbal >= 2000),
reported AS (SELECT DISTINCT 'WTH-' || l_suppkey AS station_id FROM lineitem),
stations AS (
  SELECT station_key, station_id,
    CASE WHEN station_id IN (SELECT station_id FROM reported)
      THEN station_id || '{K.STATION_NAME_SUFFIX}' ELSE station_name END AS station_name,
    latitude, longitude, created_at
  FROM known
  UNION ALL
  SELECT (SELECT coalesce(max(station_key), 0) FROM known)
      + row_number() OVER (ORDER BY station_id),
    station_id, station_id || '{K.STATION_NAME_SUFFIX}',
    CAST({K.DEFAULT_STATION_LATITUDE} AS DOUBLE), CAST({K.DEFAULT_STATION_LONGITUDE} AS DOUBLE),
    TIMESTAMP '2024-02-01'
  FROM reported WHERE station_id NOT IN (SELECT station_id FROM known))"""

_ORDER_VEHICLES = """target AS (
  SELECT 'VH-' || c_custkey AS vehicle_id, c_name AS license_plate,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'RT-' || c_nationkey END AS assigned_route_id,
    'IN_SERVICE' AS status
  FROM customer WHERE c_acctbal >= 0),
delta AS (
  SELECT 'VH-' || o_custkey AS vehicle_id, o_orderpriority AS license_plate,
    'RT-' || o_orderkey AS assigned_route_id, o_orderstatus AS status, o_orderdate, o_orderkey
  FROM orders)"""

_LINE_INCIDENTS = f"""facts AS (
  SELECT l_returnflag AS incident_type, l_linestatus AS severity,
    'Part ' || l_partkey AS location_name, l_quantity AS latitude,
    l_extendedprice AS longitude, {_keys("l_shipdate")}, l_shipdate AS record_timestamp,
    l_orderkey, l_linenumber
  FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY location_name, record_timestamp
    ORDER BY l_orderkey, l_linenumber, incident_type, severity, latitude, longitude) AS place
  FROM facts WHERE incident_type <> 'R'),
fresh AS (
  SELECT * EXCLUDE (place) FROM ranked WHERE place = 1 AND NOT EXISTS (
    SELECT 1 FROM facts s WHERE s.incident_type = 'R'
      AND s.location_name = ranked.location_name
      AND s.record_timestamp = ranked.record_timestamp))"""

_FACTS = f"""SELECT s.sensor_key, {_keys("t.ts")}, t.speed, t.k AS vehicle_volume,
  t.k / CAST(100 AS DOUBLE) AS occupancy, t.congestion_index, t.ts AS record_timestamp
FROM traffic t JOIN sensors s ON s.sensor_id = t.sensor_id AND s.is_current
WHERE t.strict_reason IS NULL"""

_HISTORY = """history AS (
  SELECT c_custkey * 4 + v AS sensor_key, 'SNS-' || c_custkey AS sensor_id,
    c_mktsegment || '/' || v AS location_name,
    CASE v WHEN 0 THEN TIMESTAMP '2024-01-03' + INTERVAL 1 DAY * (c_custkey % 5)
      WHEN 1 THEN CASE WHEN c_nationkey % 2 = 0 THEN TIMESTAMP '2024-01-12' ELSE TIMESTAMP '2024-01-14' END
      ELSE TIMESTAMP '2024-01-20 12:00:00' END AS start_date,
    CASE v WHEN 0 THEN TIMESTAMP '2024-01-12' WHEN 1 THEN TIMESTAMP '2024-01-20 12:00:00' END AS end_date
  FROM customer, (VALUES (0), (1), (2)) versions(v) WHERE c_acctbal >= 0)"""

_VALID_THEN = "h.start_date <= {ts} AND (h.end_date IS NULL OR {ts} < h.end_date)"

_REASON_WITH_UNKNOWN = f"""CASE WHEN strict_reason IS NOT NULL THEN strict_reason
  WHEN NOT EXISTS (SELECT 1 FROM sensors s WHERE s.sensor_id = traffic.sensor_id
                   AND s.is_current) THEN 'Unknown sensor_id' END"""

_GPS_UNKNOWN = """CASE WHEN reason IS NOT NULL THEN reason
  WHEN NOT EXISTS (SELECT 1 FROM vehicles v WHERE v.vehicle_id = 'VH-' || gps.user_id
                   AND v.is_current) THEN 'Unknown vehicle_id' END"""

_TRAFFIC_LETTERS = f"""SELECT payload, strict_reason AS validation_error,
  '{K.TRAFFIC_TOPIC}' AS source_topic
FROM traffic WHERE strict_reason IS NOT NULL"""


ORACLE: dict[str, str] = {
    "json_parse": f"WITH {_E} SELECT event_id, k FROM e",
    "validate_split_counts": f"""WITH {_TRAFFIC}, {_GPS}
SELECT 'traffic' AS feed, CASE WHEN job_invalid THEN 'invalid' ELSE 'valid' END AS outcome,
  count(*) AS n FROM traffic GROUP BY ALL
UNION ALL
SELECT 'gps', CASE WHEN reason IS NULL THEN 'valid' ELSE 'invalid' END, count(*)
FROM gps GROUP BY ALL""",
    "validation_reason": f"""WITH {_TRAFFIC}
SELECT event_id, strict_reason AS validation_error FROM traffic""",
    "gps_validation_reason": f"""WITH {_E}, {_GPS}
SELECT event_id, reason AS validation_error FROM gps""",
    "dead_letter_rows": f"""WITH {_TRAFFIC}, {_GPS}
SELECT payload, '{K.TRAFFIC_JOB_REASON}' AS validation_error,
  '{K.TRAFFIC_TOPIC}' AS source_topic FROM traffic WHERE job_invalid
UNION ALL
SELECT payload, '{K.GPS_JOB_REASON}', '{K.GPS_TOPIC}' FROM gps WHERE reason IS NOT NULL""",
    "dead_letter_json": f"""WITH {_TRAFFIC}, letters AS ({_TRAFFIC_LETTERS})
SELECT CAST(to_json(struct_pack(payload := payload, validation_error := validation_error,
  source_topic := source_topic)) AS VARCHAR) AS value FROM letters""",
    "dead_letter_latest": f"""WITH {_TRAFFIC}
SELECT payload, strict_reason AS validation_error, ts AS created_at
FROM traffic WHERE strict_reason IS NOT NULL ORDER BY ts DESC""",
    "severity_check": f"""WITH reports AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICAL'
    WHEN '2-HIGH' THEN 'MAJOR' WHEN '3-MEDIUM' THEN 'MINOR' WHEN '5-LOW' THEN 'LOW' END AS severity
  FROM orders)
SELECT o_orderkey, severity, CASE WHEN severity IS NULL THEN '{K.MISSING_FIELD_REASON}severity'
  WHEN severity NOT IN ('MINOR', 'MAJOR', 'CRITICAL')
  THEN '{K.SEVERITY_REASON}' END AS validation_error
FROM reports""",
    "date_time_keys": f"""WITH {_TRAFFIC}, timed AS (
  SELECT event_id, CASE WHEN NOT junk AND NOT bad_time THEN ts END AS record_timestamp FROM traffic)
SELECT event_id, record_timestamp, {_keys("record_timestamp")} FROM timed""",
    "dim_date": f"""WITH {_ORDER_CALENDAR}, per_day AS (
  SELECT {_DATE_KEY.format(ts="o_orderdate")} AS date_key, count(*) AS facts
  FROM orders GROUP BY ALL)
SELECT d.*, coalesce(facts, 0) AS facts FROM dim_date d LEFT JOIN per_day USING (date_key)""",
    "dim_time": f"""WITH {_EVENT_CALENDAR}, per_minute AS (
  SELECT {_TIME_KEY.format(ts="ts")} AS time_key, count(*) AS facts FROM events GROUP BY ALL)
SELECT t.*, coalesce(facts, 0) AS facts FROM dim_time t LEFT JOIN per_minute USING (time_key)""",
    "congestion_index": f"""SELECT event_id, {_INDEX.format(speed="value")} AS congestion_index,
  hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 16 AND 18 AS is_peak FROM events""",
    "fact_load": f"WITH {_TRAFFIC}, {_SENSORS} {_FACTS}",
    "fact_load_gps": f"""WITH {_E}, {_GPS}, {_VEHICLES}
SELECT v.vehicle_key, {_keys("g.ts")}, g.latitude, g.longitude, g.speed, g.ts AS record_timestamp
FROM gps g JOIN vehicles v ON v.vehicle_id = 'VH-' || g.user_id AND v.is_current
WHERE g.reason IS NULL""",
    "fact_load_job_profile": f"""WITH {_TRAFFIC}, {_SENSORS}, timed AS (
  SELECT *, CASE WHEN NOT bad_time THEN ts END AS record_timestamp FROM traffic)
SELECT s.sensor_key, {_keys("t.record_timestamp")}, t.speed, t.k AS vehicle_volume,
  t.k / CAST(100 AS DOUBLE) AS occupancy, t.congestion_index, t.record_timestamp
FROM timed t JOIN sensors s ON s.sensor_id = t.sensor_id AND s.is_current
WHERE NOT t.job_invalid""",
    "unknown_entity": f"""WITH {_TRAFFIC}, {_SENSORS}
SELECT event_id, sensor_id FROM traffic WHERE strict_reason IS NULL AND NOT EXISTS (
  SELECT 1 FROM sensors s WHERE s.sensor_id = traffic.sensor_id AND s.is_current)""",
    "unmatched_dead_letters": f"""WITH {_TRAFFIC}, {_SENSORS}, checked AS (
  SELECT payload, {_REASON_WITH_UNKNOWN} AS validation_error FROM traffic)
SELECT payload, validation_error, '{K.TRAFFIC_TOPIC}' AS source_topic
FROM checked WHERE validation_error IS NOT NULL""",
    "current_version_lookup": f"""WITH {_VEHICLES}
SELECT vehicle_id, vehicle_key FROM vehicles WHERE is_current""",
    "as_of_lookup": f"""WITH {_HISTORY}
SELECT e.event_id, 'SNS-' || e.user_id AS sensor_id, e.ts, h.sensor_key, h.location_name
FROM events e LEFT JOIN history h
  ON h.sensor_id = 'SNS-' || e.user_id AND {_VALID_THEN.format(ts="e.ts")}""",
    "fact_load_as_of": f"""WITH {_TRAFFIC}, {_HISTORY}
SELECT h.sensor_key, {_keys("t.ts")}, t.speed, t.k AS vehicle_volume,
  t.k / CAST(100 AS DOUBLE) AS occupancy, t.congestion_index, t.ts AS record_timestamp
FROM traffic t JOIN history h ON h.sensor_id = t.sensor_id AND {_VALID_THEN.format(ts="t.ts")}
WHERE t.strict_reason IS NULL""",
    "weather_fact_load": f"""WITH {_STATIONS}
SELECT station_key, {_keys("l_shipdate")}, l_quantity AS temperature,
  l_discount AS precipitation, l_extendedprice AS wind_speed, l_shipdate AS record_timestamp
FROM lineitem JOIN stations ON station_id = 'WTH-' || l_suppkey""",
    "weather_ids": """SELECT CAST(dayofmonth(l_shipdate) % 2 AS VARCHAR) AS run_id,
  l_suppkey + 1 AS station_key, l_shipdate AS record_timestamp, l_quantity AS temperature,
  TRUE AS id_is_unique
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal >= 2000""",
    "incident_dedupe": f"WITH {_LINE_INCIDENTS} SELECT * FROM fresh",
    "referential_check": f"""WITH {_ORDER_CALENDAR}, lines AS (
  SELECT l_orderkey, l_suppkey, {_DATE_KEY.format(ts="l_shipdate")} AS date_key, l_linenumber,
    l_partkey FROM lineitem)
SELECT *, nullif(concat_ws(',',
  CASE WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey
    AND o_orderstatus <> 'P') THEN 'l_orderkey' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey
    AND s_acctbal >= 2000) THEN 'l_suppkey' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = lines.date_key)
    THEN 'date_key' END), '') AS fk_violations
FROM lines""",
    "primary_key_check": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "landing_read": f"""WITH {_E}
SELECT row_number() OVER (ORDER BY event_id // 500, event_id DESC) AS arrival, event_id AS incident_id,
  event_type AS incident_type,
  CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'MAJOR' WHEN 'signup' THEN 'MINOR' END AS severity,
  'Zone ' || (k % 10) AS location_name, CAST(k % 10 AS DOUBLE) AS latitude, CAST(k AS DOUBLE) AS longitude,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS record_timestamp
FROM e""",
    "delta_rows": """SELECT 'VH-' || c_custkey AS vehicle_id, c_name AS license_plate,
  CASE WHEN c_custkey = 1 THEN 'RT-900' WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'RT-' || c_nationkey END AS assigned_route_id,
  CASE WHEN c_custkey = 1 THEN 'PARKED' ELSE 'IN_SERVICE' END AS status FROM customer
UNION ALL SELECT 'VH-new', 'by hand', 'RT-901', 'ORDERED'""",
    "delta_reference_check": """WITH routes AS (SELECT DISTINCT 'RT-' || c_nationkey AS route_id FROM customer),
target AS (
  SELECT 'VH-' || c_custkey AS vehicle_id, c_name AS license_plate,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'RT-' || c_nationkey END AS assigned_route_id, 'IN_SERVICE' AS status
  FROM customer WHERE c_acctbal >= 0),
last AS (SELECT o_custkey, max(o_orderkey) AS n FROM orders GROUP BY ALL),
delta AS (
  SELECT CASE WHEN o_custkey % 50 <> 0 THEN 'VH-' || o_custkey END AS vehicle_id, 'plate ' || o_custkey AS license_plate,
    CASE WHEN n % 9 <> 0 THEN 'RT-' || (n % 30) END AS assigned_route_id, 'S' || (n % 3) AS status FROM last),
checked AS (
  SELECT *, CASE WHEN vehicle_id IS NULL THEN 'Missing required field: vehicle_id'
    WHEN assigned_route_id IS NOT NULL AND assigned_route_id NOT IN (SELECT route_id FROM routes)
    THEN 'Unknown assigned_route_id' END AS error FROM delta),
good AS (SELECT * FROM checked WHERE error IS NULL)
SELECT 'stored' AS outcome, t.vehicle_id, t.license_plate,
  CASE WHEN g.vehicle_id IS NULL THEN t.assigned_route_id ELSE g.assigned_route_id END AS assigned_route_id,
  CASE WHEN g.vehicle_id IS NULL THEN t.status ELSE g.status END AS status
FROM target t LEFT JOIN good g USING (vehicle_id)
UNION ALL
SELECT 'stored', vehicle_id, license_plate, assigned_route_id, status FROM good
WHERE vehicle_id NOT IN (SELECT vehicle_id FROM target)
UNION ALL
SELECT error, vehicle_id, license_plate, assigned_route_id, status FROM checked WHERE error IS NOT NULL""",
    "surrogate_keys": """SELECT 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber,
  l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS line_key, l_orderkey, l_linenumber,
  l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem""",
    "scd2_classify": f"WITH {_SENSOR_STATES} SELECT * FROM classified",
    "scd2_merge": f"WITH {_SENSOR_STATES} "
    + _merge("sensor_key", "sensor_id", "location_name, latitude, longitude, status"),
    "scd2_merge_vehicles": f"WITH {_VEHICLE_STATES} "
    + _merge(
        "vehicle_key",
        "vehicle_id",
        "license_plate, vehicle_type, operator_name, assigned_route_id, status",
    ),
    "scd2_close_missing": """WITH source AS (
  SELECT c_custkey AS n, 'SNS-' || c_custkey AS sensor_id, c_name AS location_name,
    CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal AS longitude, c_mktsegment AS status,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'MAINTENANCE' ELSE c_mktsegment END AS earlier_status,
    CASE WHEN c_custkey % 14 = 0 THEN 'RENEWED' ELSE c_mktsegment END AS later_status,
    c_acctbal >= 0 AS known, c_custkey % 7 <> 0 AS in_first, c_custkey % 11 <> 3 AS in_second
  FROM customer),
states AS (
  -- version held before, after the first merge, after the second: its status, null if there is none
  SELECT *, CASE WHEN known THEN earlier_status END AS s0,
    CASE WHEN in_first THEN status END AS s1, CASE WHEN in_second THEN later_status END AS s2 FROM source),
versions AS (
  SELECT *, 'PLANNED' AS shown, TIMESTAMP '2023-01-01' AS start_date, TIMESTAMP '2024-01-01' AS end_date
  FROM states WHERE known AND status = 'BUILDING'
  UNION ALL
  SELECT *, s0, TIMESTAMP '2024-01-01', CASE WHEN s1 IS DISTINCT FROM s0 THEN TIMESTAMP '2024-02-01'
    WHEN s2 IS DISTINCT FROM s0 THEN TIMESTAMP '2024-03-01' END FROM states WHERE s0 IS NOT NULL
  UNION ALL
  SELECT *, s1, TIMESTAMP '2024-02-01', CASE WHEN s2 IS DISTINCT FROM s1 THEN TIMESTAMP '2024-03-01' END
  FROM states WHERE s1 IS NOT NULL AND s1 IS DISTINCT FROM s0
  UNION ALL
  SELECT *, s2, TIMESTAMP '2024-03-01', NULL FROM states
  WHERE s2 IS NOT NULL AND s2 IS DISTINCT FROM s1)
SELECT sensor_id, location_name, latitude, longitude, shown AS status, start_date, end_date,
  end_date IS NULL AS is_current, start_date AS created_at, TRUE AS key_is_unique FROM versions""",
    "scd2_null_change": f"""WITH {_VEHICLE_STATES}
SELECT vehicle_id, change_type, plain_change_type FROM classified""",
    "scd1_upsert": f"WITH {_STATIONS} SELECT * FROM stations",
    "partial_update_upsert": f"""WITH {_ORDER_VEHICLES}, last AS (
  SELECT * FROM delta QUALIFY row_number() OVER (
    PARTITION BY vehicle_id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT vehicle_id,
  CASE WHEN t.vehicle_id IS NULL THEN d.license_plate ELSE t.license_plate END AS license_plate,
  CASE WHEN d.vehicle_id IS NULL THEN t.assigned_route_id ELSE d.assigned_route_id END
    AS assigned_route_id,
  CASE WHEN d.vehicle_id IS NULL THEN t.status ELSE d.status END AS status
FROM target t FULL JOIN last d USING (vehicle_id)""",
    "insert_if_absent": f"""WITH {_ORDER_VEHICLES}, firsts AS (
  SELECT * FROM delta QUALIFY row_number() OVER (
    PARTITION BY vehicle_id ORDER BY o_orderdate, o_orderkey) = 1)
SELECT * FROM target
UNION ALL
SELECT vehicle_id, license_plate, assigned_route_id, status FROM firsts
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.vehicle_id = firsts.vehicle_id)""",
    "next_ping": """WITH instants AS (
  SELECT user_id, ts, count(*) AS pings FROM events GROUP BY ALL)
SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM instants""",
    "congestion_view": f"WITH {_CONGESTION_VIEW} SELECT * FROM v_congestion",
    "travel_time_view": f"""WITH {_TRAVEL_VIEW}
SELECT * REPLACE (round(avg_speed_mph, 6) AS avg_speed_mph,
  round(estimated_minutes_per_mile, 6) AS estimated_minutes_per_mile) FROM v_travel""",
    "hotspot_view": f"WITH {_HOTSPOT_VIEW} SELECT * FROM v_hotspots",
    "punctuality_view": f"""WITH {_PUNCTUALITY_VIEW}
SELECT * REPLACE (round(avg_actual_gap_minutes, 6) AS avg_actual_gap_minutes)
FROM v_punctuality""",
    "schedule_punctuality": f"WITH {_SCHEDULE_PUNCTUALITY}",
    "peak_hour_view": f"""WITH {_PEAK_VIEW}
SELECT time_period, day_name, round(avg_speed, 6) AS avg_speed,
  round(avg_volume, 6) AS avg_volume, round(avg_congestion_index, 6) AS avg_congestion_index
FROM v_peak""",
    "kpi_congestion": f"""WITH {_CONGESTION_VIEW}
SELECT location_name, congestion_level, round(avg(congestion_index), 6) AS avg_congestion_index
FROM v_congestion GROUP BY ALL""",
    "kpi_travel_time": f"""WITH {_TRAVEL_VIEW}
SELECT round(avg(avg_speed_mph), 6) AS avg_speed_mph,
  round(avg(estimated_minutes_per_mile), 6) AS avg_minutes_per_mile FROM v_travel""",
    "kpi_hotspots": f"""WITH {_HOTSPOT_VIEW}
SELECT latitude, longitude, CAST(sum(hazard_score) AS BIGINT) AS hazard_score,
  CAST(sum(incident_count) AS BIGINT) AS incident_count FROM v_hotspots GROUP BY ALL""",
    "kpi_punctuality": f"""WITH {_PUNCTUALITY_VIEW}
SELECT punctuality_status, assigned_route_id, count(*) AS routes FROM v_punctuality GROUP BY ALL""",
    "kpi_peak": f"""WITH {_PEAK_VIEW}
SELECT time_period, round(avg(avg_congestion_index), 6) AS avg_congestion_index,
  round(avg(avg_volume), 6) AS avg_volume FROM v_peak GROUP BY ALL""",
    "audit_counts": f"""
SELECT '{K.SENSORS_JOB}' AS job_name, 'SUCCESS' AS status, n AS records_read,
  w AS records_written, CAST(NULL AS VARCHAR) AS error_message
FROM (WITH {_SENSOR_STATES} SELECT count(*) AS n,
  count(*) FILTER (change_type <> 'unchanged') AS w FROM classified)
UNION ALL
SELECT '{K.VEHICLES_JOB}', 'SUCCESS', n, w, NULL
FROM (WITH {_VEHICLE_STATES} SELECT count(*) AS n,
  count(*) FILTER (change_type <> 'unchanged') AS w FROM classified)
UNION ALL
SELECT '{K.HOURLY_JOB}', 'SUCCESS', n, n + w, NULL
FROM (WITH {_LINE_INCIDENTS} SELECT (SELECT count(*) FROM lineitem) AS n,
  (SELECT count(*) FROM fresh) AS w)""",
    "audit_latest": """SELECT CAST(o_custkey AS VARCHAR) AS run_id,
  CASE o_orderstatus WHEN 'O' THEN 'STARTED' WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  o_orderdate AS start_time, o_orderkey, o_totalprice AS amount
FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
ORDER BY start_time DESC""",
    "stream_fact_ingest": f"""WITH {_TRAFFIC}, {_GPS}, {_SENSORS}, {_VEHICLES}
SELECT 'traffic' AS feed, s.sensor_key AS entity_key, {_keys("t.ts")}, t.speed,
  t.ts AS record_timestamp, TRUE AS id_is_unique
FROM traffic t JOIN sensors s ON s.sensor_id = t.sensor_id AND s.is_current
WHERE t.strict_reason IS NULL
UNION ALL
SELECT 'gps', v.vehicle_key, {_keys("g.ts")}, g.speed, g.ts, TRUE
FROM gps g JOIN vehicles v ON v.vehicle_id = 'VH-' || g.user_id AND v.is_current
WHERE g.reason IS NULL""",
    "stream_dead_letter_monitor": f"""WITH {_TRAFFIC}, {_GPS}, {_SENSORS}, {_VEHICLES},
letters AS (
  SELECT '{K.TRAFFIC_TOPIC}' AS source_topic, {_REASON_WITH_UNKNOWN} AS validation_error
  FROM traffic
  UNION ALL
  SELECT '{K.GPS_TOPIC}', {_GPS_UNKNOWN} FROM gps)
SELECT source_topic, validation_error, count(*) AS letters
FROM letters WHERE validation_error IS NOT NULL GROUP BY ALL""",
    "dead_letter_exactly_once": f"""WITH {_TRAFFIC}, {_SENSORS}, letters AS (
  SELECT '{K.TRAFFIC_TOPIC}' AS source_topic, {_REASON_WITH_UNKNOWN} AS validation_error
  FROM traffic)
SELECT source_topic, validation_error, count(*) AS letters
FROM letters WHERE validation_error IS NOT NULL GROUP BY ALL""",
    "stream_replay": f"WITH {_TRAFFIC}, {_SENSORS} {_FACTS}",
    "stream_compacted_facts": f"WITH {_TRAFFIC}, {_SENSORS} {_FACTS}",
    "stream_constraint_check": f"""WITH {_TRAFFIC}, {_SENSORS}
SELECT CASE WHEN job_invalid THEN '{K.TRAFFIC_JOB_REASON}'
  WHEN NOT EXISTS (SELECT 1 FROM sensors s WHERE s.sensor_id = traffic.sensor_id AND s.is_current)
    THEN 'Unknown sensor_id'
  WHEN congestion_index IS NULL THEN '{K.MISSING_FIELD_REASON}congestion_index'
  WHEN bad_time THEN '{K.MISSING_FIELD_REASON}record_timestamp'
  WHEN ts < '2024-01-01' OR ts >= '2024-01-15' THEN 'Unknown date_key'
  ELSE 'stored' END AS outcome, count(*) AS messages
FROM traffic GROUP BY ALL""",
    "event_time_zones": f"""WITH timed AS (
  SELECT event_id, CASE event_id % 23 WHEN 2 THEN ts - INTERVAL 5 HOUR
    WHEN 3 THEN ts + INTERVAL 210 MINUTE WHEN 4 THEN date_trunc('day', ts) WHEN 5 THEN NULL
    WHEN 7 THEN ts - INTERVAL 330 MINUTE WHEN 8 THEN ts + INTERVAL 3 HOUR WHEN 9 THEN ts - INTERVAL 5 HOUR
    WHEN 10 THEN ts - INTERVAL 19815 SECOND WHEN 11 THEN ts - INTERVAL 19815 SECOND
    WHEN 12 THEN ts - INTERVAL 5 HOUR WHEN 13 THEN ts + INTERVAL 210 MINUTE WHEN 14 THEN ts - INTERVAL 1 HOUR
    WHEN 16 THEN ts - INTERVAL 1 HOUR WHEN 17 THEN ts + INTERVAL 5 HOUR -- both in winter
    WHEN 18 THEN NULL WHEN 19 THEN NULL WHEN 20 THEN NULL WHEN 21 THEN NULL WHEN 22 THEN NULL
    ELSE ts END AS record_timestamp FROM events)
SELECT event_id, record_timestamp, {_keys("record_timestamp")} FROM timed""",
    "audit_failed_job": f"""SELECT '{K.HOURLY_JOB}' AS job_name, '{K.FAILED}' AS status,
  count(*) AS records_read, count(*) AS records_written,
  'landing unreadable' AS error_message FROM lineitem""",
}
