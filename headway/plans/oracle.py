"""DuckDB counterparts of the registered queries.

The common table expressions state the rules of ``fixtures.py`` once more, in
plain SQL and without sharing any expression with it.
"""

from __future__ import annotations

from headway.lookups import DIRECTION_NAMES, ROUTE_NAMES


def _rows(names: dict[str, str]) -> str:
    return ", ".join(f"('{key}', '{name}')" for key, name in names.items())


ROUTE = "['1','2','A','GS','SI','X9'][CAST({} % 6 AS INTEGER) + 1]"
EPOCH = "(epoch_us({}) // 1000000)"

DIMENSIONS = f"""
routes(route_id, route_name) AS (VALUES {_rows(ROUTE_NAMES)}),
directions(code, name) AS (VALUES {_rows(DIRECTION_NAMES)})"""

VEHICLES = f"""
ev AS (
  SELECT *, {ROUTE.format("user_id")} AS route, strftime(ts, '%H%M%S') AS hms,
    CASE WHEN event_id % 13 = 0 THEN 0 ELSE {EPOCH.format("ts")} END AS seconds,
    event_id % 17 = 0 AS no_trip, event_id % 11 = 0 AS no_position
  FROM events),
entity AS (
  SELECT event_type <> 'error' AS has_vehicle,
    event_id // 100 AS feed_no, event_id % 100 AS entity_pos,
    lpad(CAST(event_id AS VARCHAR), 12, '0') AS id,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 23 = 0 THEN ''
         ELSE 'V' || user_id END AS vehicle_id,
    CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'BADTRIP'
         WHEN 3 THEN hms || '_1.N03R' WHEN 4 THEN hms || '_7..'
         ELSE hms || '_' || route || '..' || substr('NSEWX', CAST(event_id % 5 + 1 AS INTEGER), 1)
              || lpad(CAST(event_id % 40 AS VARCHAR), 2, '0') || 'R' END AS trip_id,
    CASE WHEN no_trip THEN NULL WHEN event_id % 19 = 0 THEN '' ELSE route END AS route_id,
    CASE WHEN NOT no_position THEN CAST(CAST(value AS FLOAT) AS DOUBLE) END AS latitude,
    CASE WHEN NOT no_position THEN CAST(CAST(-value / 4 AS FLOAT) AS DOUBLE) END AS longitude,
    CASE WHEN no_position THEN NULL WHEN event_id % 3 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(event_id % 360 AS DOUBLE) END AS bearing,
    CASE WHEN no_position THEN NULL WHEN event_id % 4 = 1 THEN CAST(0 AS DOUBLE)
         ELSE CAST(CAST(user_id / 8 AS FLOAT) AS DOUBLE) END AS speed,
    CASE WHEN event_id % 29 <> 0 THEN CAST(seconds AS BIGINT) END AS "timestamp",
    CASE WHEN event_id % 31 <> 0 THEN user_id % 40 END AS current_stop_sequence,
    CASE WHEN event_id % 37 <> 0 THEN CAST(event_id % 3 AS INTEGER) END AS current_status,
    CASE WHEN event_id % 41 <> 0 THEN (user_id % 30) || 'N' END AS stop_id
  FROM ev),
vp AS (SELECT * EXCLUDE (has_vehicle) FROM entity WHERE has_vehicle)"""

PARSED = f"""{DIMENSIONS}, {VEHICLES},
cut AS (
  SELECT *, string_split(trip_id, '_') AS parts, string_split(string_split(trip_id, '_')[2], '..') AS pieces
  FROM vp),
judged AS (
  SELECT *, CASE
      WHEN trip_id IS NULL OR NOT contains(trip_id, '.') OR len(parts) < 2 THEN 'Invalid trip ID format'
      WHEN len(pieces) < 2 THEN 'Invalid route/direction format' END AS error,
    nullif(substr(pieces[2], 1, 1), '') AS code
  FROM cut),
tp AS (
  SELECT judged.*,
    CASE WHEN error IS NOT NULL THEN NULL
         WHEN length(parts[1]) >= 6
         THEN substr(parts[1], 1, 2) || ':' || substr(parts[1], 3, 2) || ':' || substr(parts[1], 5, 2)
         ELSE parts[1] END AS p_departure_time,
    CASE WHEN error IS NULL THEN pieces[1] END AS p_route_id,
    CASE WHEN error IS NULL THEN coalesce(r.route_name, 'Route ' || pieces[1]) END AS p_route_name,
    CASE WHEN error IS NULL THEN coalesce(d.name, judged.code) END AS p_direction,
    CASE WHEN error IS NULL THEN judged.code END AS p_direction_code,
    CASE WHEN error IS NULL THEN nullif(substr(pieces[2], 2), '') END AS p_destination_code,
    CASE WHEN judged.route_id <> '' THEN coalesce(v.route_name, 'Route ' || judged.route_id) END AS route_name,
    CASE WHEN "timestamp" <> 0
         THEN strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d %H:%M:%S') END AS timestamp_readable
  FROM judged
  LEFT JOIN routes r ON r.route_id = judged.pieces[1]
  LEFT JOIN routes v ON v.route_id = judged.route_id
  LEFT JOIN directions d ON d.code = judged.code)"""

TRIP_INFO = """
    p_departure_time AS trip_departure_time, p_route_id AS trip_route_id,
    p_route_name AS trip_route_name, p_direction AS trip_direction,
    p_direction_code AS trip_direction_code, p_destination_code AS trip_destination_code,
    CASE WHEN trip_id <> '' THEN error END AS trip_error"""

TRIPS = f"""
trip AS (
  SELECT o_orderkey, o_orderkey // 1000 AS feed_no,
    'T' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 14 = 0 THEN ''
         ELSE lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0') || '_' || {ROUTE.format("o_custkey")}
              || '..S01R' END AS trip_id,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 15 = 0 THEN ''
         ELSE {ROUTE.format("o_custkey")} END AS route_id,
    CASE WHEN o_orderkey % 9 <> 0 THEN CAST({EPOCH.format("o_orderdate")} AS BIGINT) END AS "timestamp"
  FROM orders),
stop_time AS (
  SELECT l_orderkey AS order_key,
    (l_partkey + l_suppkey + l_linenumber) % (count(*) OVER (PARTITION BY l_orderkey // 1000) // 500 + 1) AS part,
    CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_linenumber AS BIGINT) END AS stop_sequence,
    CASE WHEN l_partkey % 17 <> 0 THEN l_suppkey || 'N' END AS stop_id,
    CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN CAST(0 AS BIGINT)
         ELSE {EPOCH.format("l_shipdate")} END AS arrival_time,
    CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_linenumber % 3 = 0 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS arrival_delay,
    CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_partkey % 6 = 0 THEN CAST(0 AS BIGINT)
         ELSE {EPOCH.format("l_shipdate")} + 30 END AS departure_time,
    CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_linenumber % 4 = 0 THEN 0
         ELSE -CAST(l_quantity AS INTEGER) END AS departure_delay
  FROM lineitem),
stop_rows AS (
  SELECT trip.* EXCLUDE (o_orderkey), stop_time.* EXCLUDE (order_key, part), coalesce(part, 0) AS part,
    order_key IS NOT NULL AS has_stop_time
  FROM trip LEFT JOIN stop_time ON order_key = o_orderkey)"""

SNAPSHOTS = f"""
file AS (
  SELECT event_id, CASE event_id % 2 WHEN 0 THEN 'vehicle_positions' ELSE 'trip_updates' END AS feed_type,
    strftime(ts, '%Y%m%d_%H%M%S') AS stamp, {EPOCH.format("ts")} AS seconds, ts,
    event_id * 7 % 5000 AS size
  FROM events)"""

ATTEMPTS = f"""
tries AS (
  SELECT event_id, ts, unnest(generate_series(1, least(event_id % 4 + 1, 3))) AS attempt FROM events),
attempts AS (
  SELECT CASE event_id % 2 WHEN 0 THEN 'vehicle_positions' ELSE 'trip_updates' END AS feed_type,
    event_id * 4 + attempt AS n, attempt = event_id % 4 + 1 AS ok, attempt,
    {EPOCH.format("ts")} * 1000000 + event_id % 1000 * 1000 AS micros,
    CASE WHEN attempt <> event_id % 4 + 1 THEN 'HTTP 503 #' || event_id END AS error
  FROM tries)"""

FETCH_COUNTERS = """
    count(*) AS total_fetches,
    count(*) FILTER (WHERE ok) AS successful_fetches,
    count(*) FILTER (WHERE NOT ok AND attempt = 3) AS failed_fetches,
    replace(strftime(make_timestamp(max(micros) FILTER (WHERE ok)), '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '')
      AS last_fetch_time,
    arg_max_null(error, n) AS last_error"""

STAMP = (
    "strftime(make_timestamp((1704067200 + 20 * feed_no + part) * 1000000), '{}')"
)

FLAT_VEHICLES = "SELECT * EXCLUDE (entity_pos) FROM vp"
STOP_ROWS = f"WITH {TRIPS} SELECT * EXCLUDE (part) FROM stop_rows"

ORACLE: dict[str, str] = {
    "interpret_vehicles": f"""
WITH {PARSED}
SELECT feed_no, id, vehicle_id, trip_id, route_id, "timestamp", current_stop_sequence,
  current_status, stop_id, latitude, longitude, bearing, speed, route_name, timestamp_readable,
  {TRIP_INFO}
FROM tp""",
    "route_name": f"WITH {PARSED} SELECT id, route_id, route_name FROM tp",
    "route_name_join": f"WITH {PARSED} SELECT id, route_id, route_name FROM tp",
    "routes_dim": f"""
WITH {DIMENSIONS}, {VEHICLES}
SELECT routes.route_id, any_value(route_name) AS route_name, count(id) AS vehicle_count
FROM routes LEFT JOIN vp ON vp.route_id = routes.route_id GROUP BY routes.route_id""",
    "direction_name": f"""
WITH {DIMENSIONS}, coded AS (
  SELECT event_id, ['N','S','E','W','X',''][CAST(event_id % 6 AS INTEGER) + 1] AS direction_code FROM events)
SELECT event_id, direction_code, coalesce(name, nullif(direction_code, '')) AS direction
FROM coded LEFT JOIN directions ON code = direction_code""",
    "trip_parse": f"""
WITH {PARSED}
SELECT id, trip_id AS raw, p_departure_time AS departure_time, p_route_id AS route_id,
  p_route_name AS route_name, p_direction AS direction, p_direction_code AS direction_code,
  p_destination_code AS destination_code, error
FROM tp""",
    "trip_parse_errors": f"WITH {PARSED} SELECT id, trip_id, error FROM tp WHERE error IS NOT NULL",
    "departure_time": """
WITH cut AS (
  SELECT event_id, left(strftime(ts, '%H%M%S') || '9', CAST(event_id % 8 AS INTEGER)) AS digits FROM events)
SELECT event_id, digits, CASE WHEN length(digits) >= 6
  THEN substr(digits, 1, 2) || ':' || substr(digits, 3, 2) || ':' || substr(digits, 5, 2)
  ELSE digits END AS departure_time
FROM cut""",
    "timestamp_readable": f'WITH {PARSED} SELECT id, "timestamp", timestamp_readable FROM tp',
    "stop_name": """
WITH stops AS (
  SELECT s_suppkey || 'N' AS stop_id, min(s_name) AS name FROM supplier
  WHERE s_suppkey % 4 <> 0 GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_suppkey || 'N' AS stop_id,
  coalesce(name, 'Stop ' || l_suppkey || 'N') AS stop_name
FROM lineitem LEFT JOIN stops ON stop_id = l_suppkey || 'N'""",
    "snapshot_filename": f"""
WITH {SNAPSHOTS}
SELECT event_id, feed_type || '_' || stamp || '.pb' AS pb_name,
  feed_type || '_' || stamp || '.json' AS json_name, feed_type AS name_kind, seconds AS name_epoch
FROM file""",
    "feed_type_check": """
WITH asked AS (
  SELECT event_id, ['vehicle_positions','Trip_Updates','ALERTS','buses','',NULL][CAST(event_id % 6 AS INTEGER) + 1]
    AS requested FROM events)
SELECT event_id, requested,
  CASE WHEN lower(requested) IN ('vehicle_positions','trip_updates','alerts') THEN lower(requested) END AS feed_type,
  CASE lower(requested) WHEN 'vehicle_positions' THEN 'ok' WHEN 'trip_updates' THEN 'ok'
    WHEN 'alerts' THEN 'unsupported' ELSE 'invalid' END AS status
FROM asked""",
    "entity_filter": f"WITH {VEHICLES} SELECT feed_no, entity_pos, id FROM entity WHERE has_vehicle",
    "vehicle_projection": f"WITH {VEHICLES} {FLAT_VEHICLES}",
    "trip_projection": f"WITH {TRIPS} SELECT * EXCLUDE (part) FROM stop_time",
    "raw_decode_roundtrip": f"""
WITH {VEHICLES}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY feed_no ORDER BY id) - 1 AS place FROM entity)
SELECT * EXCLUDE (has_vehicle, entity_pos, place), place AS entity_pos FROM placed WHERE has_vehicle""",
    "raw_interpretation": f"""
WITH {PARSED}
SELECT feed_no, id, vehicle_id, trip_id, route_id, "timestamp", current_stop_sequence,
  current_status, stop_id, latitude, longitude, bearing, speed, route_name, timestamp_readable,
  {TRIP_INFO}
FROM tp""",
    "raw_kept": f"""
WITH {VEHICLES}, kept AS (
  SELECT feed_no, 0 AS part, unnest(['vehicle_positions', 'trip_updates', 'alerts']) AS feed_type,
    count(*) FILTER (WHERE has_vehicle) AS vehicle_count,
    count(*) FILTER (WHERE NOT has_vehicle) AS trip_count
  FROM entity GROUP BY feed_no)
SELECT feed_type || '_' || {STAMP.format("%Y%m%d_%H%M%S")} || '.pb' AS filename, feed_type,
  {STAMP.format("%Y")} AS year, {STAMP.format("%m")} AS month, {STAMP.format("%d")} AS day,
  true AS whole, vehicle_count, trip_count
FROM kept""",
    "trip_decode_roundtrip": f"""
WITH {TRIPS}
SELECT feed_no, part, id, trip_id, route_id, "timestamp", count(*) FILTER (WHERE has_stop_time) AS stop_times
FROM stop_rows GROUP BY ALL""",
    "stop_time_explode": STOP_ROWS,
    "feed_header": """
SELECT DISTINCT event_id // 100 AS feed_no, '2.0' AS gtfs_realtime_version,
  CASE WHEN event_id // 100 % 5 = 0 THEN CAST(0 AS BIGINT)
    ELSE 1704067200 + 20 * (event_id // 100) END AS header_timestamp
FROM events""",
    "decode_quarantine": f"""
WITH {VEHICLES}
SELECT feed_no, feed_no % 7 IN (3, 4, 5) AS quarantined,
  CASE WHEN feed_no % 7 IN (3, 4, 5) THEN 0 ELSE count(*) FILTER (WHERE has_vehicle) END AS vehicle_count
FROM entity GROUP BY feed_no""",
    "json_roundtrip": f"""
WITH {VEHICLES}
SELECT * EXCLUDE (feed_no, entity_pos, current_status, stop_id), current_status AS stop_id FROM vp""",
    "json_trip_roundtrip": f"WITH {TRIPS} SELECT * EXCLUDE (feed_no, part) FROM stop_rows",
    "json_pass_through": f"""
WITH {TRIPS}
SELECT feed_no, part,
  CASE WHEN feed_no % 5 = 0 THEN CAST(0 AS BIGINT) ELSE 1704067200 + 20 * feed_no END AS header_timestamp,
  count(DISTINCT id) AS trip_count, count(DISTINCT id) AS trips
FROM stop_rows WHERE (feed_no + part) % 9 <> 4 GROUP BY feed_no, part""",
    "json_one_per_file": f"""
WITH {VEHICLES}
SELECT * EXCLUDE (feed_no, entity_pos, current_status, stop_id), current_status AS stop_id,
  'ok' AS status, count(*) OVER (PARTITION BY feed_no) AS vehicle_count
FROM vp""",
    "json_file_listing": """
WITH feeds AS (SELECT DISTINCT event_id // 100 AS n FROM events)
SELECT count(*) + count(*) FILTER (WHERE n % 3 = 0) AS files, count(*) AS complete,
  count(*) FILTER (WHERE n % 3 = 0) AS empty
FROM feeds""",
    "daily_listing": f"""
WITH {SNAPSHOTS}, hours AS (
  SELECT strftime(ts, '%Y/%m/%d') AS day, sum(size) % 5000 AS bytes
  FROM file GROUP BY day, strftime(ts, '%H'), feed_type)
SELECT day, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM hours GROUP BY day""",
    "json_snapshot_scan": f"""
WITH {VEHICLES}
SELECT 'ok' AS status, CAST(NULL AS VARCHAR) AS label, id, trip_id, route_id FROM vp WHERE feed_no % 9 <> 4
UNION ALL
SELECT DISTINCT 'invalid_json', CAST(feed_no AS VARCHAR), NULL, NULL, NULL FROM entity WHERE feed_no % 9 = 4""",
    "interpret_stored_snapshots": f"""
WITH {PARSED},
feeds AS (
  SELECT DISTINCT feed_no,
    CASE WHEN feed_no % 5 = 0 THEN CAST(0 AS BIGINT) ELSE 1704067200 + 20 * feed_no END AS header_timestamp
  FROM entity WHERE feed_no % 9 <> 4),
first AS (
  SELECT *, count(*) OVER (PARTITION BY feed_no) AS total FROM tp WHERE feed_no % 7 <> 2
  QUALIFY row_number() OVER (PARTITION BY feed_no ORDER BY id) <= 50)
SELECT feeds.feed_no, header_timestamp, id, coalesce(total, 0) AS total_vehicles,
  'C' || id AS car, 'C' || id AS kept_car, route_name AS kept_route_name, route_name,
  timestamp_readable, {TRIP_INFO}
FROM feeds LEFT JOIN first ON first.feed_no = feeds.feed_no""",
    "json_invalid": f"""
WITH {VEHICLES} SELECT DISTINCT 'invalid_json' AS status, feed_no FROM entity WHERE feed_no % 9 = 4""",
    "vehicle_count": f"WITH {VEHICLES} SELECT feed_no, count(*) AS vehicle_count FROM vp GROUP BY feed_no",
    "trip_count": f"WITH {TRIPS} SELECT feed_no, count(*) AS trip_count FROM trip GROUP BY feed_no",
    "fetch_stats": f"WITH {ATTEMPTS} SELECT feed_type, {FETCH_COUNTERS} FROM attempts GROUP BY feed_type",
    "fetch_stats_total": f"WITH {ATTEMPTS} SELECT {FETCH_COUNTERS} FROM attempts",
    "upload_stats": """
SELECT count(*) FILTER (WHERE event_type <> 'view') AS total_uploads,
  count(*) FILTER (WHERE event_type NOT IN ('view', 'error')) AS successful_uploads,
  count(*) FILTER (WHERE event_type = 'error') AS failed_uploads
FROM events""",
    "flow_summary": f"""
WITH runs AS (
  SELECT event_id // 2 AS run_no, bool_and(event_type <> 'error') AS fine, count(*) AS feeds,
    max({EPOCH.format("ts")}) AS seconds
  FROM events GROUP BY ALL)
SELECT run_no, CASE WHEN fine THEN 'completed' ELSE 'failed' END AS flow_status,
  CASE WHEN fine THEN feeds END AS success_count, CASE WHEN fine THEN feeds END AS total_count,
  strftime(make_timestamp(seconds * 1000000), '%Y-%m-%dT%H:%M:%S') AS completed_at
FROM runs""",
    "latest20_files": f"""
WITH {SNAPSHOTS}
SELECT event_id, feed_type || '_' || stamp || '.json' AS filename, size
FROM file ORDER BY filename DESC, event_id DESC LIMIT 20""",
    "first50_per_feed": f"""
WITH {VEHICLES}
SELECT feed_no, entity_pos, id, trip_id, route_id FROM vp
QUALIFY row_number() OVER (PARTITION BY feed_no ORDER BY entity_pos) <= 50""",
    "union_feeds": f"""
WITH {VEHICLES}, {TRIPS}
SELECT feed_no, id, trip_id, route_id, "timestamp", 'vehicle_positions' AS feed_type FROM vp
UNION ALL
SELECT feed_no, id, trip_id, route_id, "timestamp", 'trip_updates' FROM trip""",
    "daily_partition": f"""
WITH {SNAPSHOTS}
SELECT feed_type, size, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  strftime(ts, '%Y/%m/%d/') || feed_type || '_' || stamp || '.json' AS object_key
FROM file""",
    "stream_vehicles_available_now": f"WITH {VEHICLES} {FLAT_VEHICLES}",
    "stream_status": """
WITH n AS (
  SELECT count(DISTINCT event_id // 100) AS n,
    strftime(make_timestamp((1704067200 + 20 * max(event_id // 100)) * 1000000), '%Y-%m-%dT%H:%M:%S') AS last
  FROM events)
SELECT unnest(['vehicle_positions', 'trip_updates', 'alerts']) AS feed_type, n AS snapshots,
  unnest([0, 0, n]) AS quarantined, false AS is_running, 'availableNow=True' AS trigger,
  CAST(NULL AS VARCHAR) AS last_error, 3 * n AS input_rows, true AS every_batch, true AS timed,
  unnest([last, last, NULL]) AS last_fetch_time
FROM n""",
    "stream_parsed": f"""
WITH {VEHICLES}, {TRIPS}, stored AS (
  SELECT feed_no, 0 AS part, 'vehicle_positions' AS feed_type, count(*) FILTER (WHERE has_vehicle) AS n
  FROM entity GROUP BY feed_no
  UNION ALL
  SELECT feed_no, part, 'trip_updates', count(DISTINCT id) FROM stop_rows GROUP BY feed_no, part)
SELECT feed_type || '_' || {STAMP.format("%Y%m%d_%H%M%S")} || '.pb' AS filename, feed_type,
  {STAMP.format("%Y")} AS year, {STAMP.format("%m")} AS month, {STAMP.format("%d")} AS day,
  CASE WHEN feed_no % 5 = 0 THEN CAST(0 AS BIGINT) ELSE 1704067200 + 20 * feed_no END AS header_timestamp,
  n AS counted, n AS listed
FROM stored""",
    "stream_mixed_kinds": f"""
WITH {VEHICLES}, own AS (
  SELECT feed_no, 0 AS part, id, trip_id, 'vehicle_positions' AS feed_type FROM vp
  UNION ALL
  SELECT feed_no, 0, id, 'T' || id, 'trip_updates' FROM entity WHERE NOT has_vehicle)
SELECT id, trip_id, feed_type, feed_type || '_' || {STAMP.format("%Y%m%d_%H%M%S")} || '.pb' AS filename
FROM own""",
    "stream_pair_ingest": f"""
WITH {VEHICLES}, {TRIPS}, both_kinds AS (
  SELECT feed_no, 0 AS part, id, trip_id, route_id, "timestamp", 'vehicle_positions' AS feed_type FROM vp
  UNION ALL
  SELECT DISTINCT feed_no, part, id, trip_id, route_id, "timestamp", 'trip_updates' FROM stop_rows)
SELECT id, trip_id, route_id, "timestamp", feed_type,
  {STAMP.format("%Y")} AS year, {STAMP.format("%m")} AS month, {STAMP.format("%d")} AS day,
  feed_type || '_' || {STAMP.format("%Y%m%d_%H%M%S")} || '.pb' AS filename
FROM both_kinds""",
}
