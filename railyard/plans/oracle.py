"""Independent ANSI-SQL (DuckDB dialect) statement of every registered query.

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are assumed registered.
Output column names and types equal the Spark results.
"""

from railyard.schemas import RAW_TRIP_UPDATES, RAW_VEHICLE_POSITIONS

_VP_ALL, _TU_ALL = RAW_VEHICLE_POSITIONS.fieldNames(), RAW_TRIP_UPDATES.fieldNames()
_DAY_BUCKET = "CAST(floor(epoch(ts)/86400)*86400 AS BIGINT)"
_CATEGORY = """CASE WHEN delay_seconds IS NULL THEN 'UNKNOWN' WHEN delay_seconds <= -60 THEN 'EARLY'
       WHEN delay_seconds <= 60 THEN 'ON_TIME' WHEN delay_seconds <= 300 THEN 'LATE' ELSE 'VERY_LATE' END"""

ORACLE_SQL: dict[str, str] = {
    "q_dedup_positions": f"""
SELECT event_id, user_id, {_DAY_BUCKET} AS feed_timestamp, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, {_DAY_BUCKET} ORDER BY ts DESC, event_id DESC) = 1
""",
    "q_dedup_trip_updates": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
""",
    "q_enrich_left": """
SELECT e.event_id, e.user_id, c.c_name AS customer_name, n.n_name AS nation_name, r.r_name AS region_name
FROM events e
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "q_speed_kmh": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN round(CAST(value AS FLOAT) * CAST(3.6 AS DOUBLE), 1) END AS speed_kmh
FROM events
""",
    "q_delay_category": f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_returnflag <> 'R' THEN date_diff('day', o_orderdate, l_shipdate) END AS arr,
    CASE WHEN l_linestatus <> 'F' THEN date_diff('day', o_orderdate, l_shipdate) + 1 END AS dep
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT *, CAST(coalesce(arr, dep) AS INT) AS delay_seconds FROM d)
SELECT l_orderkey, l_linenumber, l_partkey, delay_seconds, {_CATEGORY} AS delay_category FROM s
""",
    "q_epoch_time": """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS feed_timestamp, date_trunc('second', ts) AS feed_time FROM events
""",
    "q_fresh_cutoff": """
SELECT event_id, user_id FROM events
WHERE CAST(floor(epoch(ts)) AS BIGINT) >= (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) FROM events) - 900
""",
    "q_rolling_window": """
SELECT event_id, user_id FROM (
  SELECT * FROM events
  WHERE CAST(floor(epoch(ts)) AS BIGINT) >= (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) FROM events) - 7200)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""",
    "q_latest_per_vehicle": """
SELECT user_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""",
    "q_latest_delay_per_trip": """
SELECT l_orderkey AS trip_id, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
""",
    "q_gold_current": """
WITH v AS (
  SELECT user_id, event_id, value FROM events
  WHERE ts >= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
d AS (
  SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 365 DAY FROM orders)
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT v.user_id, v.event_id, v.value, d.o_orderkey AS latest_order, d.o_totalprice AS latest_price
FROM v LEFT JOIN d ON v.user_id = d.o_custkey
""",
    "q_unnest": """
SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos, unnest(embedding) AS val
FROM embeddings
""",
    "q_unnest_two_level": """
SELECT c_custkey, o_orderkey, l_linenumber, l_partkey
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
""",
    "q_zero_fill": """
SELECT c_custkey, coalesce(o_orderkey, 0) AS order_id, coalesce(o_totalprice, 0.0) AS price
FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') u ON u.o_custkey = c_custkey
""",
    "q_enum_name": """
SELECT vec_id, CASE label WHEN 0 THEN 'EMPTY' WHEN 1 THEN 'MANY_SEATS_AVAILABLE' WHEN 2 THEN 'FEW_SEATS_AVAILABLE'
  WHEN 3 THEN 'STANDING_ROOM_ONLY' WHEN 4 THEN 'CRUSHED_STANDING_ROOM_ONLY' WHEN 5 THEN 'FULL'
  WHEN 6 THEN 'NOT_ACCEPTING_PASSENGERS' WHEN 7 THEN 'NO_DATA_AVAILABLE' WHEN 8 THEN 'NOT_BOARDABLE'
  ELSE CAST(label AS VARCHAR) END AS occupancy_status
FROM embeddings
""",
    "q_feed_json": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
""",
    "q_csv_by_name": """
SELECT n_nationkey, n_name, n_regionkey FROM nation
""",
    "q_append_raw": """
SELECT event_id, user_id, value FROM events UNION ALL SELECT event_id, user_id, value FROM events
""",
    "q_silver_positions": f"""
WITH d AS (
  SELECT *, {_DAY_BUCKET} AS feed_timestamp FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, {_DAY_BUCKET} ORDER BY ts DESC, event_id DESC) = 1)
SELECT d.user_id AS entity_id, d.feed_timestamp, date_trunc('day', d.ts) AS feed_time,
  c.c_name AS route_long_name, n.n_name AS stop_name, d.value AS speed,
  round(CAST(d.value AS FLOAT) * CAST(3.6 AS DOUBLE), 1) AS speed_kmh
FROM d LEFT JOIN customer c ON d.user_id * 12 = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    "q_silver_trip_updates": f"""
WITH d AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
s AS (
  SELECT d.*, CAST(date_diff('day', o.o_orderdate, d.l_shipdate) AS INT) AS delay_seconds
  FROM d LEFT JOIN orders o ON d.l_orderkey = o.o_orderkey)
SELECT s.l_orderkey AS trip_id, s.l_linenumber AS stop_sequence, p.p_name AS stop_name,
  u.s_name AS route_long_name, s.delay_seconds, {_CATEGORY} AS delay_category
FROM s LEFT JOIN part p ON s.l_partkey + 50 = p.p_partkey
LEFT JOIN supplier u ON s.l_suppkey = u.s_suppkey
""",
}

# streaming twins: same result as their batch counterparts
ORACLE_SQL["q_stream_append"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
ORACLE_SQL["q_stream_silver"] = ORACLE_SQL["q_dedup_positions"]
ORACLE_SQL["q_stream_dedup_trip_updates"] = ORACLE_SQL["q_dedup_trip_updates"]

# ── transit tables derived from the driver tables, through silver and gold ──

# silver breaks exact ties on the raw columns it keeps, in table order
_VP_REST = ("trip_id route_id direction_id start_time start_date schedule_relationship vehicle_id "
            "vehicle_label latitude longitude bearing speed current_stop_sequence stop_id current_status "
            "vehicle_timestamp congestion_level occupancy_status").split()
_TU_REST = ("trip_id route_id direction_id start_time start_date schedule_relationship vehicle_id "
            "vehicle_label trip_delay stop_id arrival_delay arrival_time departure_delay departure_time "
            "stop_schedule_relationship").split()


# Enum names by number; NULL stands for a number without a name
_INCREMENTALITY = ["FULL_DATASET", "DIFFERENTIAL"]
_TRIP_RELATIONSHIP = ["SCHEDULED", "ADDED", "UNSCHEDULED", "CANCELED", None, "REPLACEMENT", "DUPLICATED", "DELETED", "NEW"]
_STOP_RELATIONSHIP = ["SCHEDULED", "SKIPPED", "NO_DATA", "UNSCHEDULED"]
_STOP_STATUS = ["INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO"]
_CONGESTION = ["UNKNOWN_CONGESTION_LEVEL", "RUNNING_SMOOTHLY", "STOP_AND_GO", "CONGESTION", "SEVERE_CONGESTION"]
_OCCUPANCY = ["EMPTY", "MANY_SEATS_AVAILABLE", "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY", "CRUSHED_STANDING_ROOM_ONLY",
              "FULL", "NOT_ACCEPTING_PASSENGERS", "NO_DATA_AVAILABLE", "NOT_BOARDABLE"]
_WHEELCHAIR = ["NO_VALUE", "UNKNOWN", "WHEELCHAIR_ACCESSIBLE", "WHEELCHAIR_INACCESSIBLE"]


def _pick(names, number, unset=None):
    """The name of ``number``, the number itself where it has none, ``unset`` for NULL."""
    listed = ", ".join("NULL" if n is None else f"'{n}'" for n in names)
    found = f"coalesce(list_extract([{listed}], CAST({number} AS BIGINT) + 1), CAST({number} AS VARCHAR))"
    return f"CASE WHEN ({number}) IS NULL THEN '{unset}' ELSE {found} END" if unset else found


def _asc(cols):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _transit_ctes(vp_window_seconds=None, copies=2):
    vp_filter = ""
    if vp_window_seconds:
        vp_filter = f"WHERE feed_timestamp >= (SELECT max(feed_timestamp) FROM raw_vp) - {vp_window_seconds}"
    return f"""
raw_vp AS (
  SELECT 'e' || user_id AS entity_id, {_DAY_BUCKET} AS feed_timestamp,
    '2.0' AS gtfs_realtime_version, {_pick(_INCREMENTALITY, 'event_id % 2')} AS incrementality,
    CAST(user_id * 150 AS VARCHAR) AS trip_id, CAST(user_id * 12 + 1 AS VARCHAR) AS route_id,
    CAST(user_id % 2 AS INT) AS direction_id,
    strftime(ts, '%H:%M:%S') AS start_time, strftime(ts, '%Y%m%d') AS start_date,
    {_pick(_TRIP_RELATIONSHIP, 'k % 9')} AS schedule_relationship,
    'v' || (user_id % 97) AS vehicle_id, event_type AS vehicle_label, 'P' || event_id AS license_plate,
    {_pick(_WHEELCHAIR, 'user_id % 4')} AS wheelchair_accessible, CAST(value AS FLOAT) AS latitude,
    CAST(-value / 2 AS FLOAT) AS longitude,
    CAST(event_id % 360 AS FLOAT) AS bearing, value * 10 + event_id AS odometer,
    CASE WHEN event_type <> 'error' THEN CAST(value / 4 AS FLOAT) END AS speed,
    CAST(event_id % 40 AS INT) AS current_stop_sequence, CAST(k * 25 AS VARCHAR) AS stop_id,
    {_pick(_STOP_STATUS, 'event_id % 3')} AS current_status,
    CAST(floor(epoch(ts)) AS BIGINT) AS vehicle_timestamp, {_pick(_CONGESTION, 'event_id % 5')} AS congestion_level,
    {_pick(_OCCUPANCY, 'event_id % 9')} AS occupancy_status, CAST(event_id % 101 AS INT) AS occupancy_percentage,
    epoch_us(ts) AS ingested_at
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)),
routes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS route_id, c_mktsegment AS route_short_name, c_name AS route_long_name,
    c_nationkey % 8 AS route_type FROM customer),
stops AS (
  SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name, p_retailprice AS stop_lat,
    CAST(-p_size AS DOUBLE) AS stop_lon FROM part),
trips AS (SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, o_orderpriority AS trip_headsign FROM orders),
vp AS (
  SELECT * FROM raw_vp {vp_filter}
  QUALIFY row_number() OVER (PARTITION BY entity_id, feed_timestamp ORDER BY ingested_at DESC, {_asc(_VP_REST)}) = 1),
slv_vp AS (
  SELECT vp.entity_id, vp.feed_timestamp, vp.feed_timestamp * 1000000 AS feed_time, vp.trip_id, vp.route_id,
    r.route_short_name, r.route_long_name, r.route_type, t.trip_headsign, vp.direction_id, vp.start_time,
    vp.start_date, vp.schedule_relationship, vp.vehicle_id, vp.vehicle_label, vp.latitude, vp.longitude,
    vp.bearing, vp.speed,
    CASE WHEN vp.speed IS NOT NULL THEN round(CAST(vp.speed AS DOUBLE) * CAST(3.6 AS DOUBLE), 1) END AS speed_kmh,
    vp.current_stop_sequence, vp.stop_id, s.stop_name, s.stop_lat AS stop_latitude, s.stop_lon AS stop_longitude,
    vp.current_status, vp.congestion_level, vp.occupancy_status, vp.vehicle_timestamp * 1000000 AS vehicle_time,
    vp.ingested_at
  FROM vp LEFT JOIN routes r ON vp.route_id = r.route_id LEFT JOIN stops s ON vp.stop_id = s.stop_id
  LEFT JOIN trips t ON vp.trip_id = t.trip_id),
lo AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority,
    (SELECT CAST(floor(floor(epoch(max(ts))) / 86400) * 86400 AS BIGINT) FROM events)
      - (date_diff('day', l.l_shipdate, (SELECT max(l_shipdate) FROM lineitem)) % 28) * 86400 AS fts,
    CAST(date_diff('day', o.o_orderdate, l.l_shipdate) * 60 AS INT) AS mins
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
raw_tu AS (
  SELECT 't' || l_orderkey AS entity_id, fts AS feed_timestamp, '2.0' AS gtfs_realtime_version,
    {_pick(_INCREMENTALITY, 'l_linenumber % 2')} AS incrementality, CAST(l_orderkey AS VARCHAR) AS trip_id,
    CAST(o_custkey + 100 AS VARCHAR) AS route_id, CAST(l_orderkey % 2 AS INT) AS direction_id,
    lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS start_time, strftime(o_orderdate, '%Y%m%d') AS start_date,
    {_pick(_TRIP_RELATIONSHIP, 'l_orderkey % 9')} AS schedule_relationship, 'v' || (o_custkey % 97) AS vehicle_id,
    o_orderpriority AS vehicle_label, mins + copy AS trip_delay, fts + l_linenumber AS trip_timestamp,
    l_linenumber AS stop_sequence, CAST(l_partkey + 50 AS VARCHAR) AS stop_id,
    CASE WHEN l_returnflag <> 'R' THEN mins + 2 * copy END AS arrival_delay, fts + mins AS arrival_time,
    CAST(l_suppkey AS INT) AS arrival_uncertainty,
    CASE WHEN l_linestatus <> 'F' THEN mins + 30 + 3 * copy END AS departure_delay, fts + mins + 1800 AS departure_time,
    CAST(l_quantity AS INT) AS departure_uncertainty,
    {_pick(_STOP_RELATIONSHIP, 'l_linenumber % 4')} AS stop_schedule_relationship,
    (fts + 60 * copy) * 1000000 + CAST(l_quantity * 1000000 AS BIGINT) AS ingested_at
  FROM lo, (SELECT CAST(c AS INT) AS copy FROM range({copies}) r(c))),
tu AS (
  SELECT * FROM raw_tu
  QUALIFY row_number() OVER (PARTITION BY entity_id, feed_timestamp, stop_sequence
    ORDER BY ingested_at DESC, {_asc(_TU_REST)}) = 1),
slv_tu AS (
  SELECT tu.entity_id, tu.feed_timestamp, tu.feed_timestamp * 1000000 AS feed_time, tu.trip_id, tu.route_id,
    r.route_short_name, r.route_long_name, r.route_type, t.trip_headsign, tu.direction_id, tu.start_time,
    tu.start_date, tu.schedule_relationship, tu.vehicle_id, tu.vehicle_label, tu.trip_delay, tu.stop_sequence,
    tu.stop_id, s.stop_name, tu.arrival_delay, tu.arrival_time, tu.departure_delay, tu.departure_time,
    tu.stop_schedule_relationship, coalesce(tu.arrival_delay, tu.departure_delay) AS delay_seconds,
    CASE WHEN coalesce(tu.arrival_delay, tu.departure_delay) IS NULL THEN 'UNKNOWN'
         WHEN coalesce(tu.arrival_delay, tu.departure_delay) <= -60 THEN 'EARLY'
         WHEN coalesce(tu.arrival_delay, tu.departure_delay) <= 60 THEN 'ON_TIME'
         WHEN coalesce(tu.arrival_delay, tu.departure_delay) <= 300 THEN 'LATE' ELSE 'VERY_LATE' END AS delay_category,
    tu.ingested_at
  FROM tu LEFT JOIN routes r ON tu.route_id = r.route_id LEFT JOIN stops s ON tu.stop_id = s.stop_id
  LEFT JOIN trips t ON tu.trip_id = t.trip_id)"""


ORACLE_SQL["q_transit_silver_positions"] = f"WITH {_transit_ctes()} SELECT * FROM slv_vp"
ORACLE_SQL["q_transit_silver_trip_updates"] = f"WITH {_transit_ctes()} SELECT * FROM slv_tu"
ORACLE_SQL["q_transit_dedup_trip_updates"] = f"""WITH {_transit_ctes(copies=5)}
SELECT * FROM raw_tu QUALIFY row_number() OVER (PARTITION BY entity_id, feed_timestamp, stop_sequence
  ORDER BY ingested_at DESC, {_asc(c for c in _TU_ALL if c not in ("entity_id", "feed_timestamp", "stop_sequence", "ingested_at"))}) = 1"""
ORACLE_SQL["q_transit_silver_window"] = f"WITH {_transit_ctes(2 * 86400)} SELECT * FROM slv_vp"
ORACLE_SQL["q_transit_gold_current"] = f"""WITH {_transit_ctes()},
ref_time AS (SELECT max(feed_timestamp) AS a FROM raw_vp),
lvp AS (
  SELECT * FROM slv_vp WHERE feed_timestamp >= (SELECT a FROM ref_time) - {7 * 86400}
  QUALIFY row_number() OVER (PARTITION BY vehicle_id
    ORDER BY feed_timestamp DESC, ingested_at DESC, entity_id ASC NULLS FIRST) = 1),
ltu AS (
  SELECT trip_id AS _tu_trip_id, trip_delay, delay_seconds, delay_category FROM slv_tu
  WHERE feed_timestamp >= (SELECT a FROM ref_time) - {7 * 86400}
  QUALIFY row_number() OVER (PARTITION BY trip_id
    ORDER BY feed_timestamp DESC, ingested_at DESC, stop_sequence ASC NULLS FIRST, entity_id ASC NULLS FIRST) = 1)
SELECT lvp.*, ltu.trip_delay, ltu.delay_seconds, ltu.delay_category
FROM lvp LEFT JOIN ltu ON lvp.trip_id = ltu._tu_trip_id"""

# ── feed snapshots built from the driver tables, flattened ──

_STAMP = "CAST(1700000000000000 AS BIGINT)"

ORACLE_SQL["q_feed_vehicles"] = f"""
WITH e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, {_DAY_BUCKET} AS snap,
    CASE WHEN event_type <> 'view' THEN event_id END AS nr FROM events)
SELECT CAST(event_id AS VARCHAR) AS entity_id, snap AS feed_timestamp, '2.0' AS gtfs_realtime_version,
  {_pick(_INCREMENTALITY, 'snap // 86400 % 2')} AS incrementality, 't' || user_id AS trip_id, 'r' || event_type AS route_id,
  CAST(coalesce(nr % 2, 0) AS INT) AS direction_id, strftime(ts, '%H:%M:%S') AS start_time,
  strftime(ts, '%Y%m%d') AS start_date, {_pick(_TRIP_RELATIONSHIP, 'k')} AS schedule_relationship,
  'v' || user_id AS vehicle_id, event_type AS vehicle_label, coalesce('P' || nr, '') AS license_plate,
  {_pick(_WHEELCHAIR, 'nr % 5', 'NO_VALUE')} AS wheelchair_accessible,
  CAST(value AS FLOAT) AS latitude, CAST(-value / 2 AS FLOAT) AS longitude, CAST(coalesce(nr % 360, 0) AS FLOAT) AS bearing,
  value * 10 + event_id AS odometer, CAST(value / 4 AS FLOAT) AS speed, CAST(event_id AS INT) AS current_stop_sequence,
  CAST(k AS VARCHAR) AS stop_id, {_pick(_STOP_STATUS, 'nr % 4', 'IN_TRANSIT_TO')} AS current_status,
  CAST(floor(epoch(ts)) AS BIGINT) AS vehicle_timestamp,
  {_pick(_CONGESTION, 'nr % 6', 'UNKNOWN_CONGESTION_LEVEL')} AS congestion_level,
  {_pick(_OCCUPANCY, 'nr % 10', 'EMPTY')} AS occupancy_status,
  CAST(coalesce(nr % 101, 0) AS INT) AS occupancy_percentage, {_STAMP} AS ingested_at
FROM e
"""

ORACLE_SQL["q_feed_trip_updates"] = f"""
WITH j AS (
  SELECT l.*, o.o_custkey, o.o_orderpriority, CAST(floor(epoch(l.l_shipdate)) AS BIGINT) AS snap,
    CASE WHEN l_linenumber < 6 THEN l_linenumber END AS nr, o.o_orderdate,
    CAST(date_diff('day', o.o_orderdate, l.l_shipdate) * 60 AS INT) AS mins
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT CAST(l_orderkey AS VARCHAR) AS entity_id, snap AS feed_timestamp, '2.0' AS gtfs_realtime_version,
  {_pick(_INCREMENTALITY, 'snap // 86400 % 2')} AS incrementality, 't' || l_orderkey AS trip_id, 'r' || o_custkey AS route_id,
  CAST(l_orderkey % 2 AS INT) AS direction_id, lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS start_time,
  strftime(o_orderdate, '%Y%m%d') AS start_date, {_pick(_TRIP_RELATIONSHIP, 'l_orderkey % 10')} AS schedule_relationship,
  'v' || o_custkey AS vehicle_id, o_orderpriority AS vehicle_label, CAST(l_orderkey % 1000 AS INT) AS trip_delay,
  snap + 5 AS trip_timestamp, l_linenumber AS stop_sequence, CAST(l_partkey AS VARCHAR) AS stop_id,
  CASE WHEN l_returnflag <> 'R' THEN mins ELSE 0 END AS arrival_delay,
  CASE WHEN l_returnflag <> 'R' THEN snap + mins ELSE 0 END AS arrival_time,
  CASE WHEN l_returnflag <> 'R' THEN CAST(l_suppkey AS INT) ELSE 0 END AS arrival_uncertainty,
  CASE WHEN l_linestatus <> 'F' THEN mins + 30 ELSE 0 END AS departure_delay,
  CASE WHEN l_linestatus <> 'F' THEN snap + mins + 1800 ELSE 0 END AS departure_time,
  CASE WHEN l_linestatus <> 'F' THEN CAST(l_quantity AS INT) ELSE 0 END AS departure_uncertainty,
  {_pick(_STOP_RELATIONSHIP, 'nr', 'SCHEDULED')} AS stop_schedule_relationship, {_STAMP} AS ingested_at
FROM j
"""

# the full refresh over the same derived tables publishes the same gold table
ORACLE_SQL["q_refresh_gold"] = ORACLE_SQL["q_transit_gold_current"]

# the streaming collector path produces the same rows as the batch flatten
ORACLE_SQL["q_stream_feed_vehicles"] = ORACLE_SQL["q_feed_vehicles"]

# ── incremental and stateful streams ──

ORACLE_SQL["q_stream_silver_window"] = ORACLE_SQL["q_transit_silver_window"]

ORACLE_SQL["q_versions_isolated"] = f"""
WITH old AS (
  SELECT event_id, user_id, {_DAY_BUCKET} AS feed_timestamp, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, {_DAY_BUCKET} ORDER BY ts DESC, event_id DESC) = 1),
new AS (
  SELECT event_id, user_id, feed_timestamp, value FROM (
    SELECT event_id, user_id, {_DAY_BUCKET} AS feed_timestamp, value, ts FROM events UNION ALL
    SELECT event_id, user_id, {_DAY_BUCKET}, value + 1, ts + INTERVAL 1 HOUR FROM events)
  QUALIFY row_number() OVER (PARTITION BY user_id, feed_timestamp ORDER BY ts DESC, event_id DESC) = 1)
SELECT 'staged' AS seen, * FROM old UNION ALL SELECT 'published', * FROM new UNION ALL SELECT 'old', * FROM old
"""

ORACLE_SQL["q_stream_stateful_positions"] = f"""WITH {_transit_ctes()}
SELECT * FROM raw_vp QUALIFY row_number() OVER (PARTITION BY entity_id, feed_timestamp ORDER BY ingested_at DESC,
  {_asc(c for c in _VP_ALL if c not in ("entity_id", "feed_timestamp", "ingested_at"))}) = 1"""

# the second copies up to the watermark of the first ones, three days behind, come too late
ORACLE_SQL["q_stream_late_rows"] = f"""WITH {_transit_ctes()},
closed AS (SELECT count(*) AS n FROM raw_vp WHERE feed_timestamp <= (SELECT max(feed_timestamp) FROM raw_vp) - {3 * 86400})
SELECT 2 * n AS raw_rows, n AS merged_rows, n AS late_rows FROM closed"""

ORACLE_SQL["q_stream_ledger"] = """
SELECT CAST(4 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS ledger_rows, count(*) AS table_rows FROM events"""

ORACLE_SQL["q_stream_compacted"] = f"""
SELECT event_id, ts, user_id, event_type, value, props, count(*) OVER (PARTITION BY {_DAY_BUCKET}) AS day_rows FROM events"""

# ── refresh by what changed; a whole delivery ──

# the newest day came late; the renamed route is used on the days of its rows
ORACLE_SQL["q_refresh_changed"] = f"""WITH {_transit_ctes()},
days AS (SELECT feed_timestamp FROM slv_vp WHERE route_id = '1' UNION SELECT max(feed_timestamp) FROM slv_vp)
SELECT *, feed_timestamp IN (SELECT feed_timestamp FROM days) AS rebuilt FROM slv_vp"""

ORACLE_SQL["q_reference_delivery"] = """
SELECT 'agency' AS member, CAST(1 AS BIGINT) AS delivery, CAST(r_regionkey AS VARCHAR) AS key,
  concat_ws('|', r_name, 'http://agency/' || r_regionkey, 'UTC', 'lang ' || r_regionkey, '+1' || r_regionkey) AS text,
  CAST(NULL AS BIGINT) AS number, false AS unparsed FROM region
UNION ALL
SELECT 'routes', 2, CAST(c_custkey AS VARCHAR),
  concat_ws('|', c_nationkey, c_mktsegment, upper('new ' || c_name), 'desc ' || c_nationkey, 'http://routes/' || c_custkey,
            'c' || c_custkey, 't' || c_custkey), c_nationkey % 8, false FROM customer
UNION ALL
SELECT 'stops', 2, CAST(p_partkey AS VARCHAR),
  concat_ws('|', 'code ' || p_partkey, p_name, p_type, p_brand, 'http://stops/' || p_partkey, 'parent ' || p_size, p_partkey % 10),
  p_partkey % 3, false FROM part
UNION ALL
SELECT 'trips', 2, CAST(o_orderkey AS VARCHAR),
  concat_ws('|', o_custkey, o_orderstatus, o_orderpriority, 'short ' || o_orderkey, 'block ' || o_custkey, 'shape ' || o_orderkey),
  10 * (o_orderkey % 2) + o_orderkey % 3, false FROM orders
UNION ALL
SELECT 'calendar', 2, CAST(s_suppkey AS VARCHAR), concat_ws('|', s_nationkey + 20240101, s_nationkey + 20250101),
  s_suppkey % 128, false FROM supplier
UNION ALL
SELECT 'calendar_dates', 2, CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y%m%d'),
  CASE WHEN o_orderkey % 5 > 1 THEN 1 + o_orderkey % 2 END, o_orderkey % 5 = 0 FROM orders
"""
