"""SQL building blocks of the oracle side, written for DuckDB and independent of the operators."""

from __future__ import annotations

from holdshort import airport
from holdshort.catalog.tables import FAR, PREFIXES, RUNWAY_SPOTS, WAKE


def num(x: float) -> str:
    """Number literal that is read as DOUBLE."""
    return f"{x!r}e0"


def strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def numbers(values) -> str:
    return "[" + ", ".join(num(v) for v in values) + "]"


def _place(points, spots, far, centre):
    return f"""CASE WHEN event_type IN ('view','click') AND event_id % 24 < 21
      THEN ({numbers(points)})[least(event_id % 24, 20) + 1] + (event_id % 3) * 5e-5
      WHEN event_id % 7 = 0 THEN {num(far)}
      WHEN event_id % 2 = 0 THEN ({numbers(spots)})[event_id % 4 + 1] ELSE {num(centre)} END"""


MSG = f"""msg AS (SELECT ts, CAST(user_id AS VARCHAR) AS icao,
  CASE WHEN event_type = 'error' THEN 20 WHEN event_id % 5 = 0 THEN 18 ELSE 17 END AS downlink_format,
  CAST(CASE WHEN event_type IN ('view','click') THEN 5 + event_id % 4
       WHEN event_type IN ('purchase','signup') THEN 9 + event_id % 10 ELSE 19 END AS DOUBLE) AS typecode,
  CASE WHEN event_type IN ('view','click') THEN 'on-ground'
       WHEN event_type IN ('purchase','signup') THEN 'airborne' END AS flight_status,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 11 = 0 THEN 'None'
       ELSE ({strings(WAKE)})[(user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 4 + 1] END AS wake_category,
  CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 17 = 0 THEN '########'
       ELSE ({strings(PREFIXES)})[user_id % 9 + 1] || CAST(user_id AS VARCHAR) END END AS callsign,
  {_place([p[3] for p in airport.HOLDING_POINTS], [s[0] for s in RUNWAY_SPOTS], FAR[0], airport.CENTRE[0])} AS lat,
  {_place([p[2] for p in airport.HOLDING_POINTS], [s[1] for s in RUNWAY_SPOTS], FAR[1], airport.CENTRE[1])} AS lon,
  CASE WHEN event_type = 'view' THEN 0e0 WHEN event_type IN ('click','purchase') THEN value END AS speed,
  CASE WHEN event_type IN ('purchase','signup') THEN value * 100 END AS altitude_ft
  FROM events)"""

POS = """pos AS (SELECT DISTINCT ts, icao, flight_status, lat, lon FROM msg
  WHERE typecode BETWEEN 5 AND 22 AND typecode <> 19)"""

FLT = """flt AS (SELECT DISTINCT ts, icao, callsign FROM msg
  WHERE callsign IS NOT NULL AND callsign NOT IN ('########', 'nan', 'None', 'null', ''))"""

VEL = "vel AS (SELECT ts, icao, flight_status, speed FROM msg WHERE speed IS NOT NULL)"

CAT = """votes AS (SELECT icao, wake_category, count(*) AS n FROM msg
  WHERE downlink_format IN (17, 18) AND wake_category IS NOT NULL AND wake_category <> 'None' GROUP BY ALL),
cat AS (SELECT icao, wake_category FROM (SELECT *, row_number() OVER (
  PARTITION BY icao ORDER BY n DESC, wake_category) AS rn FROM votes) WHERE rn = 1)"""

HP = "hp(i, designator, runway, plon, plat) AS (VALUES " + ", ".join(
    f"({i}, '{n}', '{r}', {num(lon)}, {num(lat)})" for i, (n, r, lon, lat) in enumerate(airport.HOLDING_POINTS)) + ")"

EDGES = "edges(i, runway, x0, y0, x1, y1) AS (VALUES " + ", ".join(
    f"({i}, '{name}', {num(a[0])}, {num(a[1])}, {num(b[0])}, {num(b[1])})"
    for i, (name, ring) in enumerate(airport.RUNWAY_RINGS.items()) for a, b in zip(ring, ring[1:])) + ")"

HOLIDAYS = "(" + ", ".join(f"'{d}'" for d in airport.HOLIDAYS) + ")"


def sec(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def great_circle(lat1, lon1, lat2, lon2) -> str:
    return (f"6371000e0 * acos(least(1e0, greatest(-1e0, sin(radians({lat1})) * sin(radians({lat2})) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon1}) - radians({lon2})))))")


def haversine(lat1, lon1, lat2, lon2) -> str:
    return (f"(12756e0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
            f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


CENTRE = great_circle(num(airport.CENTRE[0]), num(airport.CENTRE[1]), "lat", "lon")


def nearest(left: str, right: str, payload: str, tol: int, row: str = "l.*") -> str:
    """Left rows with the payload of the nearest right row of the same aircraft."""
    return f"""(SELECT * EXCLUDE (rn, rid) FROM (SELECT {row}, r.{payload}, row_number() OVER (PARTITION BY l.rid
      ORDER BY abs(epoch_us(l.ts) - epoch_us(r.ts)), r.ts, r.{payload}) AS rn
      FROM (SELECT *, row_number() OVER () AS rid FROM {left}) l JOIN {right} r ON l.icao = r.icao
      AND abs({sec('l.ts')} - {sec('r.ts')}) <= {tol}) WHERE rn = 1)"""


def located(tol: int) -> str:
    """CTEs up to `loc`: positions near the airport with callsign, holding point, category and runway by position."""
    return f"""{MSG}, {POS}, {FLT}, {VEL}, {CAT}, {HP}, {EDGES},
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao, ts ORDER BY flight_status, lat, lon) AS k
  FROM pos WHERE {CENTRE} <= 5000) WHERE k = 1),
named AS {nearest('near', 'flt', 'callsign', tol)},
spots AS (SELECT DISTINCT lat, lon FROM named),
spot_hp AS (SELECT lat, lon, min_by(designator, i) AS designator, min_by(runway, i) AS runway FROM spots, hp
  WHERE {great_circle('lat', 'lon', 'plat', 'plon')} < 20 GROUP BY lat, lon),
spot_rw AS (SELECT lat, lon, min_by(runway, i) AS runway_from_position FROM (
  SELECT lat, lon, i, runway, count(*) FILTER (WHERE ((y1 > lat) <> (y0 > lat))
     AND lon < (x0 - x1) * (lat - y1) / (y0 - y1 + 1e-9) + x1) AS hits FROM spots, edges GROUP BY ALL)
  WHERE hits % 2 = 1 GROUP BY lat, lon),
loc AS (SELECT n.ts, n.icao, n.flight_status, n.lat, n.lon, n.callsign, h.designator, h.runway, c.wake_category,
  w.runway_from_position, CAST(n.ts AS DATE) AS day
  FROM named n JOIN cat c ON n.icao = c.icao LEFT JOIN spot_hp h ON n.lat = h.lat AND n.lon = h.lon
  LEFT JOIN spot_rw w ON n.lat = w.lat AND n.lon = w.lon)"""


# Flight phases of `loc`: `seg` runs from the first holding point to the first airborne message of the flight's key.
def segment(key: str = "callsign, day") -> str:
    return f"""firsts AS (SELECT *, min(CASE WHEN flight_status = 'on-ground' THEN ts END) OVER w AS first_on_ground_time,
  min(CASE WHEN designator IS NOT NULL THEN ts END) OVER w AS first_holding_time FROM loc
  WINDOW w AS (PARTITION BY {key})),
after AS (SELECT * FROM firsts WHERE ts >= first_holding_time),
seg AS (SELECT * FROM (SELECT *, min(CASE WHEN flight_status = 'airborne' THEN ts END) OVER (PARTITION BY {key})
  AS first_airborne_time FROM after) WHERE ts <= first_airborne_time)"""


def stops(speed_tol: int, key: str = "callsign, day", air: str = "icao, day") -> str:
    """After `segment`: `kept` are the rows of stopping aircraft, `held` the stopped rows with their times."""
    return f"""fast AS {nearest('seg', 'vel', 'speed', speed_tol)},
kept AS (SELECT * FROM (SELECT * REPLACE (min(CASE WHEN designator IS NOT NULL AND speed = 0 THEN ts END)
    OVER (PARTITION BY {key}) AS first_holding_time) FROM fast
  WHERE ({air}) IN (SELECT ({air}) FROM fast WHERE speed = 0 AND designator IS NOT NULL))
  WHERE ts >= first_holding_time),
held AS (SELECT *, CAST({sec('first_airborne_time')} - {sec('ts')} AS DOUBLE) AS takeoff_time,
  CAST({sec('first_holding_time')} - {sec('first_on_ground_time')} AS DOUBLE) AS time_before_holding_point,
  CAST({sec('ts')} - {sec('first_holding_time')} AS DOUBLE) AS time_at_holding_point
  FROM kept WHERE speed = 0 AND designator IS NOT NULL)"""


def events(key: str = "icao, day") -> str:
    """Runway events of `loc`."""
    return f"""ev AS (SELECT runway, ts, wake_category, CASE WHEN flight_status = 'airborne' THEN 'takeoff' ELSE 'landing' END AS event,
  day FROM (SELECT coalesce(runway, runway_from_position) AS runway, ts, wake_category, flight_status, day,
    lag(flight_status) OVER (PARTITION BY {key} ORDER BY ts) AS prev FROM loc)
  WHERE runway IS NOT NULL AND ((flight_status = 'airborne' AND prev = 'on-ground')
    OR (flight_status = 'on-ground' AND prev = 'airborne')))"""


WAITS = f"""wr AS (SELECT *, hour(timestamp) AS hour, strftime(timestamp, '%a') AS weekday FROM (SELECT
  l_shipdate + to_minutes(CAST(l_orderkey % 1440 AS BIGINT)) + to_seconds(CAST(l_partkey % 60 AS DOUBLE)) AS timestamp,
  ({strings(PREFIXES)})[l_suppkey % 9 + 1] || CAST(l_orderkey % 50 AS VARCHAR) AS callsign,
  CAST(l_suppkey AS VARCHAR) AS icao, l_returnflag AS runway, 'P' || CAST(l_linenumber AS VARCHAR) AS holding_point,
  ({strings(WAKE)})[l_partkey % 4 + 1] AS turbulence_category,
  ({strings([*WAKE, 'N/C'])})[l_suppkey % 5 + 1] AS last_event_turb_cat,
  l_quantity * 5 AS takeoff_time, l_quantity * 4 + l_discount * 300 AS prediction,
  l_orderkey % 4 AS last_min_takeoffs, l_partkey % 4 AS last_min_landings,
  l_partkey % 120 AS time_since_last_event_seconds, l_orderkey % 7 = 0 AS is_holiday FROM lineitem))"""

ERR = f"""{WAITS}, er AS (SELECT *, prediction - takeoff_time AS error, abs(prediction - takeoff_time) AS abs_error,
  pow(prediction - takeoff_time, 2) AS squared_error,
  abs(prediction - takeoff_time) * 100 / CASE WHEN takeoff_time = 0 THEN 1 ELSE takeoff_time END AS mape FROM wr)"""

METEO = """meteo AS (SELECT date_trunc('hour', ts) AS time, CAST(count(*) AS DOUBLE) AS cloud, min(value) AS temp
  FROM events GROUP BY 1)"""
