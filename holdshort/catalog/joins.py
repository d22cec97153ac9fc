"""Joins by tolerance, last event, interval, minute, hour; semi and anti joins; dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort import airport
from holdshort.catalog import query
from holdshort.catalog.cleaning import DAY_S, FINAL, HOUR_S, LOCATED_SPEEDS, TEST_SETTINGS, micros
from holdshort.catalog.sql import CAT, ERR, FLT, MSG, POS, VEL, events, located, nearest, num, sec, segment, METEO
from holdshort.catalog.tables import RUNWAY_SPOTS, messages, meteo, wait_rows
from holdshort.operators import joins, movements, projections, reports
from holdshort.plans import features as plan
from holdshort.operators.spread import spread_join
from holdshort.session import freeze


@query("interval_join", f"""WITH {MSG}, {POS}, {FLT},
p1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao, ts ORDER BY flight_status, lat, lon) AS k FROM pos) WHERE k = 1)
SELECT epoch_us(ts) AS ts, icao, flight_status, callsign FROM {nearest('p1', 'flt', 'callsign', DAY_S)}""")
def _interval_join(spark, sf):
    m = messages(spark, sf)
    return joins.nearest_within(projections.positions(m), projections.flights(m), ["icao"], DAY_S, ["callsign"],
                                one_per_ts=True).select(micros("ts"), "icao", "flight_status", "callsign")


@query("interval_join_speed", f"""WITH {MSG}, {POS}, {VEL} SELECT epoch_us(ts) AS ts, icao, flight_status, speed
  FROM {nearest('pos', 'vel', 'speed', HOUR_S)}""")
def _interval_join_speed(spark, sf):
    m = messages(spark, sf)
    return joins.nearest_within(projections.positions(m), projections.velocities(m), ["icao"], HOUR_S, ["speed"]).select(
        micros("ts"), "icao", "flight_status", "speed")


STATES = f"""{LOCATED_SPEEDS}, {FLT},
st AS (SELECT DISTINCT v.rid, v.ts, v.icao, v.flight_status, v.speed, v.lat, v.lon, f.callsign
  FROM (SELECT *, row_number() OVER () AS rid FROM vl) v JOIN flt f ON v.icao = f.icao
  AND abs({sec('v.ts')} - {sec('f.ts')}) <= {DAY_S})"""


def states(spark, sf):
    m = messages(spark, sf)
    return joins.flight_state(projections.velocities_located(m, HOUR_S), projections.flights(m), DAY_S)


@query("flight_state_join", f"""WITH {STATES} SELECT epoch_us(ts) AS ts, icao, flight_status, round(speed, 4) AS speed, callsign,
  hour(ts) AS hour, strftime(ts, '%a') AS day_of_week FROM st""")
def _flight_state_join(spark, sf):
    return states(spark, sf).select(micros("ts"), "icao", "flight_status", F.round("speed", 4).alias("speed"), "callsign",
                                    "hour", "day_of_week")


@query("flights_info", f"""WITH {MSG}, {POS}, {FLT}, {VEL}, {CAT},
air AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao, ts ORDER BY flight_status, lat, lon) AS k FROM pos
  WHERE flight_status = 'airborne') WHERE k = 1),
named AS {nearest('air', 'flt', 'callsign', DAY_S)},
fast AS {nearest('named', 'vel', 'speed', HOUR_S * 6)},
alt AS (SELECT icao, callsign, ts, max(altitude_ft) AS altitude_ft FROM msg WHERE altitude_ft IS NOT NULL GROUP BY ALL)
SELECT epoch_us(f.ts) AS ts, f.icao, f.flight_status, f.callsign, f.speed, c.wake_category, round(a.altitude_ft, 4) AS altitude_ft FROM fast f
LEFT JOIN cat c ON f.icao = c.icao LEFT JOIN alt a ON f.icao = a.icao AND f.callsign = a.callsign AND f.ts = a.ts""")
def _flights_info(spark, sf):
    m = messages(spark, sf)
    return joins.flights_info(
        projections.positions(m), projections.flights(m), projections.velocities(m), projections.airplane_category(m),
        projections.altitudes(m), DAY_S, HOUR_S * 6,
    ).select(micros("ts"), "icao", "flight_status", "callsign", "speed", "wake_category", F.round("altitude_ft", 4).alias("altitude_ft"))


@query("join_categories", f"WITH {MSG}, {POS}, {CAT} SELECT epoch_us(ts) AS ts, icao, flight_status, wake_category FROM pos JOIN cat USING (icao)")
def _join_categories(spark, sf):
    m = messages(spark, sf)
    return joins.join_categories(projections.positions(m), projections.airplane_category(m)).select(
        micros("ts"), "icao", "flight_status", "wake_category")


def located_rows(spark, sf):
    return freeze(plan.located_positions(messages(spark, sf), TEST_SETTINGS))


@query("assign_holding_point", f"WITH {located(DAY_S)} SELECT epoch_us(ts) AS ts, icao, designator, runway FROM loc")
def _assign_holding_point(spark, sf):
    return located_rows(spark, sf).select(micros("ts"), "icao", "designator", "runway")


@query("point_in_polygon", f"WITH {located(DAY_S)} SELECT epoch_us(ts) AS ts, icao, runway_from_position FROM loc")
def _point_in_polygon(spark, sf):
    return located_rows(spark, sf).select(micros("ts"), "icao", "runway_from_position")


@query("semi_valid_flights", f"""WITH {located(DAY_S)} SELECT epoch_us(ts) AS ts, icao, callsign FROM loc
  WHERE (callsign, day) IN (SELECT (callsign, day) FROM loc WHERE designator IS NOT NULL)""")
def _semi_valid_flights(spark, sf):
    return movements.semi_valid_flights(located_rows(spark, sf)).select(micros("ts"), "icao", "callsign")


@query("semi_stopped", FINAL + " SELECT epoch_us(ts) AS ts, icao, callsign, epoch_us(first_holding_time) AS first_holding_time, speed FROM kept")
def _semi_stopped(spark, sf):
    m = messages(spark, sf)
    segment_rows = movements.flight_window(located_rows(spark, sf))
    fast = joins.nearest_within(segment_rows, projections.velocities(m), ["icao"], HOUR_S, ["speed"])
    return movements.semi_stopped(fast).select(micros("ts"), "icao", "callsign", micros("first_holding_time"), "speed")


ASOF = f"""{events()}, ev1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY runway, ts ORDER BY wake_category, event) AS k FROM ev) WHERE k = 1),
pts AS (SELECT ts, icao, callsign, runway, day FROM loc WHERE runway IS NOT NULL)"""


def _asof(keys, name):
    on = " AND ".join(f"p.{k} = e.{k}" for k in keys)
    return f"""{name} AS (SELECT p.ts, p.icao, p.callsign, p.runway, e.ts AS ets, e.event, e.wake_category FROM pts p ASOF LEFT JOIN ev1 e
  ON {on} AND p.ts > e.ts),
{name}_done AS (SELECT ts, icao, callsign, runway, coalesce(ets, ts - INTERVAL 65 SECONDS) AS event_ts, coalesce(wake_category, 'N/C') AS last_event_turb_cat,
  event AS last_event FROM {name} a WHERE ets IS NOT NULL OR NOT EXISTS (SELECT 1 FROM ev1 p WHERE
  {" AND ".join(f"p.{k} = " + ("CAST(a.ts AS DATE)" if k == "day" else f"a.{k}") for k in keys)}))"""


ASOF_OUT = """ SELECT epoch_us(ts) AS ts, icao, callsign, runway, epoch_us(event_ts) AS event_ts, last_event_turb_cat, last_event,
  epoch_us(ts) // 1000000 - epoch_us(event_ts) // 1000000 AS time_since_last_event_seconds FROM """


def _asof_rows(spark, sf, per_day):
    loc = located_rows(spark, sf)
    out = joins.asof_last_event(loc.where("runway IS NOT NULL").select("ts", "icao", "callsign", "runway"),
                                movements.runway_events(loc), per_day)
    return out.select(micros("ts"), "icao", "callsign", "runway", micros("event_ts"), "last_event_turb_cat", "last_event",
                      "time_since_last_event_seconds")


@query("asof_last_event", f"WITH {located(DAY_S)}, {ASOF}, {_asof(['runway'], 'a')} {ASOF_OUT} a_done")
def _asof_last_event(spark, sf):
    return _asof_rows(spark, sf, per_day=False)


@query("asof_last_event_per_day", f"WITH {located(DAY_S)}, {ASOF}, {_asof(['runway', 'day'], 'a')} {ASOF_OUT} a_done")
def _asof_last_event_per_day(spark, sf):
    return _asof_rows(spark, sf, per_day=True)


FLAGS = ", ".join([f"coalesce(bool_or(designator = '{n}'), false) AS \"{n}\"" for n in airport.HOLDING_POINT_NAMES]
                  + [f"coalesce(bool_or(runway_from_position = '{n}'), false) AS \"{n.replace('/', '_')}\"" for n in airport.RUNWAY_NAMES])
OCC = f"occ AS (SELECT (({sec('ts')} + 3599) // 3600) * 3600 AS bucket, {FLAGS} FROM loc GROUP BY 1)"
FLAG_NAMES = ", ".join(f'"{n}"' for n in plan.select_flags())


@query("join_occupancy", f"""WITH {located(DAY_S)}, {OCC} SELECT epoch_us(ts) AS ts, icao, {FLAG_NAMES} FROM loc
  JOIN occ ON ({sec('ts')} // 3600) * 3600 = bucket WHERE designator IS NOT NULL""")
def _join_occupancy(spark, sf):
    loc = located_rows(spark, sf)
    rows = loc.where("designator IS NOT NULL").select("ts", "icao")
    return joins.join_occupancy(rows, movements.occupancy(loc, 3600), 3600).withColumn("ts", F.unix_micros("ts"))


RATE = f"""rate AS (SELECT (({sec('ts')} + 86399) // 86400) * 86400 AS minute, count(*) FILTER (WHERE event = 'takeoff') AS last_min_takeoffs,
  count(*) FILTER (WHERE event = 'landing') AS last_min_landings FROM ev GROUP BY 1)"""


@query("join_minute_rate", f"""WITH {located(DAY_S)}, {events()}, {RATE} SELECT epoch_us(ts) AS ts, icao,
  coalesce(last_min_takeoffs, 0) AS last_min_takeoffs, coalesce(last_min_landings, 0) AS last_min_landings
  FROM loc LEFT JOIN rate ON ({sec('ts')} // 86400) * 86400 = minute""")
def _join_minute_rate(spark, sf):
    loc = located_rows(spark, sf)
    rate = movements.events_per_minute(movements.runway_events(loc), 86400)
    return joins.join_minute_rate(loc.select("ts", "icao"), rate, 86400).select(
        micros("ts"), "icao", "last_min_takeoffs", "last_min_landings")


@query("join_meteo_hourly", f"""WITH {MSG}, {METEO} SELECT epoch_us(ts) AS ts, icao, cloud AS "cloud_cover (%)", temp AS "temperature_2m (°C)"
  FROM msg JOIN meteo ON date_trunc('hour', ts) = time""")
def _join_meteo_hourly(spark, sf):
    rows = messages(spark, sf).select("ts", "icao", F.lit(0.0).alias("cloud_cover (%)"))
    return joins.join_meteo_hourly(rows, meteo(spark, sf)).withColumn("ts", F.unix_micros("ts"))


@query("join_meteo_prefixed", f"""WITH {MSG}, {METEO} SELECT epoch_us(ts) AS ts, icao, 0e0 AS "cloud_cover (%)", cloud AS "meteo_cloud_cover (%)",
  temp AS "meteo_temperature_2m (°C)" FROM msg JOIN meteo ON date_trunc('hour', ts) = time""")
def _join_meteo_prefixed(spark, sf):
    rows = messages(spark, sf).select("ts", "icao", F.lit(0.0).alias("cloud_cover (%)"))
    return joins.join_meteo_prefixed(rows, meteo(spark, sf)).withColumn("ts", F.unix_micros("ts"))


SPOTS = ", ".join(f"('{n}', {num(la)}, {num(lo)})" for n, la, lo in airport.NUMBERED_RUNWAYS)
NEAREST = f"(SELECT min_by(name, (l.lat - plat) * (l.lat - plat) + (l.lon - plon) * (l.lon - plon)) FROM (VALUES {SPOTS}) s(name, plat, plon))"
WT = f"""off AS (SELECT icao, callsign, ts, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY icao, callsign ORDER BY ts, lat, lon) AS k
  FROM st WHERE flight_status = 'airborne') WHERE k = 1),
wt AS (SELECT l.callsign, l.icao, g.ts AS ts_ground, l.ts AS ts_airborne, l.lat, l.lon, {NEAREST} AS runway,
  CAST({sec('l.ts')} - {sec('g.ts')} AS DOUBLE) AS wait_s, strftime(l.ts, '%a') AS day_of_week
  FROM off l JOIN (SELECT icao, callsign, min(ts) AS ts FROM st WHERE flight_status = 'on-ground' AND speed = 0 GROUP BY ALL) g
  ON l.icao = g.icao AND l.callsign = g.callsign WHERE l.ts > g.ts)"""


@query("wait_times", f"""WITH {STATES}, {WT} SELECT callsign, icao, epoch_us(ts_ground) AS ts_ground, epoch_us(ts_airborne) AS ts_airborne,
  runway, wait_s, day_of_week FROM wt""")
def _wait_times(spark, sf):
    return movements.wait_times(states(spark, sf)).select(
        "callsign", "icao", micros("ts_ground"), micros("ts_airborne"), "runway", "wait_s", "day_of_week")


@query("wait_times_by_callsign", f"""WITH {STATES}, g AS (SELECT callsign, min(ts) FILTER (WHERE flight_status = 'on-ground' AND speed = 0) AS a,
  min(ts) FILTER (WHERE flight_status = 'airborne') AS b FROM st GROUP BY 1)
SELECT callsign, {sec('b')} - {sec('a')} AS wait_s, strftime(a, '%a') AS day_of_week FROM g WHERE b > a""")
def _wait_times_by_callsign(spark, sf):
    return movements.wait_times_by_callsign(states(spark, sf)).select("callsign", "wait_s", "day_of_week")


@query("geo_error_join", f"""WITH {ERR}, er2 AS (SELECT CASE runway WHEN 'A' THEN '32L/14R' WHEN 'N' THEN '32R/14L' ELSE '36L/18R' END AS runway,
  abs_error, squared_error FROM er), g AS (SELECT runway, avg(abs_error) AS mae, sqrt(avg(squared_error)) AS rmse FROM er2 GROUP BY 1)
SELECT runway, round(mae, 6) AS mae, round(rmse, 6) AS rmse, lat, lon FROM g JOIN (VALUES {", ".join(f"('{n}', {num(lo)}, {num(la)})" for n, lo, la in airport.RUNWAY_LABEL_POSITIONS)}) p(runway, lon, lat) USING (runway)""")
def _geo_error_join(spark, sf):
    runway = F.when(F.col("runway") == "A", "32L/14R").when(F.col("runway") == "N", "32R/14L").otherwise("36L/18R")
    errors = reports.group_errors(wait_rows(spark, sf).withColumn("runway", runway), "runway")
    return joins.geo_error_join(errors, "runway").withColumns({"mae": F.round("mae", 6), "rmse": F.round("rmse", 6)})


REFS = list(zip(airport.RUNWAY_NAMES, [s[0] for s in RUNWAY_SPOTS], [s[1] for s in RUNWAY_SPOTS]))
REF_SQL = ", ".join(f"('{n}', {num(a)}, {num(b)})" for n, a, b in REFS)


@query("nearest_reference", f"""WITH {MSG}, {POS} SELECT epoch_us(ts) AS ts, icao, (SELECT min_by(name, (pos.lat - a) * (pos.lat - a) + (pos.lon - b) * (pos.lon - b))
  FROM (VALUES {REF_SQL}) s(name, a, b)) AS nearest FROM pos""")
def _nearest_reference(spark, sf):
    return joins.nearest_reference(projections.positions(messages(spark, sf)), REFS).select(micros("ts"), "icao", "nearest")


@query("anti_outliers", f"""WITH {MSG}, {POS}, {FLT} SELECT epoch_us(ts) AS ts, icao FROM pos WHERE icao NOT IN (SELECT icao FROM flt WHERE callsign LIKE 'IBE%')""")
def _anti_outliers(spark, sf):
    m = messages(spark, sf)
    out = projections.flights(m).where("callsign LIKE 'IBE%'").select("icao").distinct()
    return spread_join(projections.positions(m), out, ["icao"], "left_anti").select(micros("ts"), "icao")


@query("segment_of_flights", f"WITH {located(DAY_S)}, {segment()} SELECT epoch_us(ts) AS ts, icao, callsign, epoch_us(first_airborne_time) AS first_airborne_time FROM seg")
def _segment_of_flights(spark, sf):
    return movements.flight_window(located_rows(spark, sf)).select(micros("ts"), "icao", "callsign", micros("first_airborne_time"))
