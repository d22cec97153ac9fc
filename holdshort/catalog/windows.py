"""Flight phases, events, tracks and sequences."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from holdshort import airport
from holdshort.catalog import query
from holdshort.catalog.cleaning import DAY_S, FINAL, HOUR_S, TEST_SETTINGS, answer_sheet, micros, scenario_raw
from holdshort.catalog.joins import (
    FLAG_NAMES, OCC, RATE, STATES, WT, located_rows, states,
)
from holdshort.catalog.sql import CAT, HOLIDAYS, MSG, POS, WAITS, events, haversine, located, nearest, num, sec, segment
from holdshort.catalog.tables import messages, meteo, wait_rows
from holdshort.functions import labels
from holdshort.operators import joins, movements, prior_waits, projections
from holdshort.plans import features as plan
from holdshort.plans import scoring
from holdshort.session import freeze

SEG = f"WITH {located(DAY_S)}, {segment()}"


@query("first_times", SEG + """ SELECT epoch_us(ts) AS ts, icao, callsign, epoch_us(first_on_ground_time) AS first_on_ground_time,
  epoch_us(first_holding_time) AS first_holding_time FROM after""")
def _first_times(spark, sf):
    return movements.first_times(located_rows(spark, sf)).select(
        micros("ts"), "icao", "callsign", micros("first_on_ground_time"), micros("first_holding_time"))


@query("first_times_whole_table", f"WITH {located(DAY_S)}, {segment('callsign')}" + """ SELECT epoch_us(ts) AS ts, icao, callsign,
  epoch_us(first_on_ground_time) AS first_on_ground_time, epoch_us(first_holding_time) AS first_holding_time FROM after""")
def _first_times_whole(spark, sf):
    return movements.first_times(located_rows(spark, sf), per_day=False).select(
        micros("ts"), "icao", "callsign", micros("first_on_ground_time"), micros("first_holding_time"))


@query("takeoff_segment", SEG + """ SELECT epoch_us(ts) AS ts, icao, callsign, epoch_us(first_airborne_time) AS first_airborne_time FROM seg""")
def _takeoff_segment(spark, sf):
    return movements.takeoff_segment(movements.first_times(located_rows(spark, sf))).select(
        micros("ts"), "icao", "callsign", micros("first_airborne_time"))


def held_rows(spark, sf):
    return plan.waits(messages(spark, sf), located_rows(spark, sf), TEST_SETTINGS)


@query("holding_times", FINAL + """ SELECT epoch_us(ts) AS ts, icao, callsign, designator, speed, takeoff_time, time_before_holding_point,
  time_at_holding_point FROM held""")
def _holding_times(spark, sf):
    return held_rows(spark, sf).select(micros("ts"), "icao", "callsign", "designator", "speed", "takeoff_time",
                                       "time_before_holding_point", "time_at_holding_point")


@query("mean_wait_by_runway_hour", FINAL + """ SELECT runway, hour(ts) AS hour, count(*) AS n, round(avg(takeoff_time), 4) AS mean_wait_s
  FROM held WHERE ts = first_holding_time GROUP BY ALL""")
def _mean_wait(spark, sf):
    out = plan.mean_wait_by_runway_hour(held_rows(spark, sf))
    return out.withColumn("mean_wait_s", F.round("mean_wait_s", 4))


@query("runway_events", f"WITH {located(DAY_S)}, {events()} SELECT runway, epoch_us(ts) AS ts, wake_category, event FROM ev")
def _runway_events(spark, sf):
    return movements.runway_events(located_rows(spark, sf)).select("runway", micros("ts"), "wake_category", "event")


@query("runway_events_whole_table", f"WITH {located(DAY_S)}, {events('icao')} SELECT runway, epoch_us(ts) AS ts, wake_category, event FROM ev")
def _runway_events_whole(spark, sf):
    return movements.runway_events(located_rows(spark, sf), per_day=False).select("runway", micros("ts"), "wake_category", "event")


@query("occupancy_10s", f"WITH {located(DAY_S)}, {OCC.replace('3599', '9').replace('3600', '10')} SELECT bucket, {FLAG_NAMES} FROM occ")
def _occupancy(spark, sf):
    return movements.occupancy(located_rows(spark, sf), 10).withColumn("bucket", F.unix_seconds("bucket"))


@query("events_per_minute", f"WITH {located(DAY_S)}, {events()}, {RATE.replace('86399', '59').replace('86400', '60')} SELECT * FROM rate")
def _events_per_minute(spark, sf):
    return movements.events_per_minute(movements.runway_events(located_rows(spark, sf)), 60).withColumn(
        "minute", F.unix_seconds("minute"))


@query("feature_table", FINAL + f""", {OCC}, {events()}, {RATE},
ev1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY runway, ts ORDER BY wake_category, event) AS k FROM ev) WHERE k = 1),
f1 AS (SELECT held.*, {FLAG_NAMES}, coalesce(last_min_takeoffs, 0) AS last_min_takeoffs, coalesce(last_min_landings, 0) AS last_min_landings
  FROM held JOIN occ ON ({sec('ts')} // 3600) * 3600 = bucket LEFT JOIN rate ON ({sec('ts')} // 86400) * 86400 = minute),
f2 AS (SELECT f.*, e.ts AS ets, e.event AS last_event, e.wake_category AS ewc FROM f1 f ASOF LEFT JOIN ev1 e
  ON f.runway = e.runway AND f.day = e.day AND f.ts > e.ts)
SELECT takeoff_time, epoch_us(ts) AS timestamp, icao, callsign, designator AS holding_point, runway, substr(callsign, 1, 3) AS operator,
  wake_category AS turbulence_category, round(lat, 6) AS lat, round(lon, 6) AS lon, last_min_takeoffs, last_event, last_min_landings,
  coalesce(ewc, 'N/C') AS last_event_turb_cat, {sec('ts')} - {sec("coalesce(ets, ts - INTERVAL 65 SECONDS)")} AS time_since_last_event_seconds,
  coalesce(time_before_holding_point, 0) AS time_before_holding_point, time_at_holding_point, hour(date_trunc('day', ts)) AS hour,
  strftime(ts, '%a') AS weekday, CAST(CAST(ts AS DATE) AS VARCHAR) IN {HOLIDAYS} AS is_holiday,
  epoch_us(coalesce(ets, ts - INTERVAL 65 SECONDS)) AS event_timestamp, epoch_us(first_holding_time) AS first_holding_time,
  epoch_us(first_airborne_time) AS first_airborne_time, epoch_us(first_on_ground_time) AS first_on_ground_time, {FLAG_NAMES}
FROM f2 WHERE ets IS NOT NULL OR NOT EXISTS (SELECT 1 FROM ev1 x WHERE x.runway = f2.runway AND x.day = f2.day)""")
def _feature_table(spark, sf):
    out = plan.feature_table(messages(spark, sf), TEST_SETTINGS)
    times = ["timestamp", "event_timestamp", "first_holding_time", "first_airborne_time", "first_on_ground_time"]
    return out.withColumns({c: F.unix_micros(c) for c in times} | {"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


@query("latest_per_key", f"""WITH {WAITS} SELECT callsign, epoch_us(timestamp) AS timestamp, icao, takeoff_time FROM (SELECT *, row_number() OVER (
  PARTITION BY callsign ORDER BY timestamp DESC, icao DESC, takeoff_time DESC) AS k FROM wr) WHERE k = 1""")
def _latest_per_key(spark, sf):
    rows = wait_rows(spark, sf).select("callsign", "timestamp", "icao", "takeoff_time")
    return movements.latest_per_key(rows, ["callsign"], "timestamp").withColumn("timestamp", F.unix_micros("timestamp"))


@query("sequence_number", f"WITH {MSG} SELECT epoch_us(ts) AS ts, icao, row_number() OVER (PARTITION BY icao ORDER BY ts) AS row_num FROM msg")
def _sequence_number(spark, sf):
    return movements.sequence_number(messages(spark, sf).select("ts", "icao")).withColumn("ts", F.unix_micros("ts"))


@query("prev_category_on_runway", f"""WITH {STATES}, {WT}, {CAT},
p AS (SELECT wt.*, cat.wake_category, lag(cat.wake_category) OVER (PARTITION BY runway ORDER BY ts_airborne, wt.icao, callsign) AS prev_category
  FROM wt JOIN cat ON wt.icao = cat.icao WHERE runway IN ('3', '4') AND wait_s < 1000000)
SELECT callsign, icao, runway, wait_s, wake_category, prev_category FROM p WHERE prev_category IS NOT NULL""")
def _prev_category(spark, sf):
    waits = movements.wait_times(states(spark, sf))
    return movements.prev_category_on_runway(waits, projections.airplane_category(messages(spark, sf)), 1_000_000).select(
        "callsign", "icao", "runway", "wait_s", "wake_category", "prev_category")


TRK = f"""t1 AS (SELECT * FROM (SELECT ts, icao, lat, lon, row_number() OVER (PARTITION BY icao, ts ORDER BY lat, lon) AS k
  FROM msg WHERE lat IS NOT NULL) WHERE k = 1)"""


@query("step_distance", f"""WITH {MSG}, {TRK}, s AS (SELECT *, lag(ts) OVER w AS pts, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
  FROM t1 WINDOW w AS (PARTITION BY icao ORDER BY ts))
SELECT epoch_us(ts) AS ts, icao, epoch_us(pts) AS prev_ts, round({haversine('lat', 'lon', 'plat', 'plon')}, 4) AS distance_km,
  {sec('ts')} - {sec('pts')} AS time_diff_s FROM s""")
def _step_distance(spark, sf):
    return movements.step_distance(messages(spark, sf), ["icao"]).select(
        micros("ts"), "icao", micros("prev_ts"), F.round("distance_km", 4).alias("distance_km"), "time_diff_s")


@query("state_durations", f"""WITH {MSG}, s AS (SELECT icao, flight_status, epoch_us(coalesce(lead(ts) OVER (PARTITION BY icao ORDER BY ts),
  (SELECT max(ts) FROM msg))) - epoch_us(ts) AS span FROM msg)
SELECT icao, round(coalesce(sum(span) FILTER (WHERE flight_status = 'on-ground') / 1e6, 0), 4) AS ground_s,
  round(coalesce(sum(span) FILTER (WHERE flight_status = 'airborne') / 1e6, 0), 4) AS airborne_s FROM s GROUP BY 1""")
def _state_durations(spark, sf):
    out = movements.state_durations(messages(spark, sf))
    return out.withColumns({c: F.round(c, 4) for c in ("ground_s", "airborne_s")})


RADAR_KM = haversine(num(airport.RADAR[0]), num(airport.RADAR[1]), "lat", "lon")


@query("thin_trajectory", f"""WITH {MSG}, r AS (SELECT ts, icao, speed, lat, lon, row_number() OVER (PARTITION BY icao
  ORDER BY ts, speed NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST) - 1 AS i FROM msg)
SELECT epoch_us(ts) AS ts, icao, speed FROM r WHERE i % (CASE WHEN {RADAR_KM} < 10 AND speed <= 300 THEN 10 ELSE 50 END) = 0""")
def _thin_trajectory(spark, sf):
    rows = messages(spark, sf).select("ts", F.col("icao").alias("callsign"), "speed", "lat", "lon")
    return movements.thin_trajectory(rows).select(micros("ts"), F.col("callsign").alias("icao"), "speed")


@query("trajectory_class", f"""WITH {MSG}, {POS}, e AS (SELECT icao, arg_min(lat, ts) AS alat, arg_min(lon, ts) AS alon, arg_max(lat, ts) AS blat,
  arg_max(lon, ts) AS blon FROM pos GROUP BY 1),
d AS (SELECT icao, {haversine(num(airport.RADAR[0]), num(airport.RADAR[1]), 'alat', 'alon')} AS a,
  {haversine(num(airport.RADAR[0]), num(airport.RADAR[1]), 'blat', 'blon')} AS b FROM e)
SELECT icao, round(a, 4) AS start_km, round(b, 4) AS end_km, CASE WHEN a < 10 THEN 'Take-off' WHEN b < 10 THEN 'Landing' ELSE 'In flight' END AS kind FROM d""")
def _trajectory_class(spark, sf):
    rows = projections.positions(messages(spark, sf)).withColumn("callsign", F.lit("-"))
    return movements.trajectory_class(rows).drop("callsign").withColumns({c: F.round(c, 4) for c in ("start_km", "end_km")})


@query("trajectory_mean_altitude", f"""WITH {MSG}, a AS (SELECT ts, icao, altitude_ft, lead(altitude_ft) OVER (PARTITION BY icao ORDER BY ts) AS nxt,
  avg(altitude_ft) OVER (PARTITION BY icao) AS mean FROM msg WHERE altitude_ft IS NOT NULL)
SELECT epoch_us(ts) AS ts, icao, round((altitude_ft + nxt) / 2, 3) AS segment_altitude_ft, round(mean, 3) AS mean_altitude_ft FROM a WHERE nxt IS NOT NULL""")
def _trajectory_mean_altitude(spark, sf):
    return movements.trajectory_mean_altitude(messages(spark, sf), ["icao"]).select(
        micros("ts"), "icao", F.round("segment_altitude_ft", 3).alias("segment_altitude_ft"),
        F.round("mean_altitude_ft", 3).alias("mean_altitude_ft"))


@query("rolling_prior_mean", f"""WITH {WAITS}, rows AS (SELECT *, row_number() OVER () AS rid, CAST(timestamp AS DATE) AS day,
  epoch_us(timestamp) AS t, CAST(takeoff_time * 1000000 AS BIGINT) AS w FROM wr),
pairs AS (SELECT a.rid, b.callsign, b.t, b.w, b.takeoff_time, row_number() OVER (PARTITION BY a.rid, b.callsign ORDER BY b.t, greatest(b.t, b.t + b.w), b.takeoff_time) AS k
  FROM rows a JOIN rows b ON a.runway = b.runway AND a.day = b.day AND b.t < a.t AND b.t + b.w < a.t AND a.callsign <> b.callsign),
top AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY t DESC, callsign DESC) AS r FROM pairs WHERE k = 1),
m AS (SELECT rid, avg(takeoff_time) AS m FROM top WHERE r <= 3 GROUP BY 1)
SELECT t AS timestamp, callsign, runway, takeoff_time, round(coalesce(m, 170), 6) AS prediction FROM rows LEFT JOIN m USING (rid)""")
def _rolling_prior_mean(spark, sf):
    rows = wait_rows(spark, sf).select(F.col("timestamp").alias("ts"), "callsign", "runway", "takeoff_time")
    out = prior_waits.rolling_prior_mean(rows)
    return out.select(F.unix_micros("ts").alias("timestamp"), "callsign", "runway", "takeoff_time",
                      F.round("prediction", 6).alias("prediction"))


def _sequence_sql(frame, first):
    return f"""WITH {WAITS}, s AS (SELECT runway, epoch_us(timestamp) AS timestamp, callsign, icao, takeoff_time,
  row_number() OVER w AS seq, list(takeoff_time) OVER (PARTITION BY runway ORDER BY timestamp, callsign, icao, takeoff_time, holding_point
  ROWS BETWEEN {frame}) AS steps FROM wr WINDOW w AS (PARTITION BY runway ORDER BY timestamp, callsign, icao, takeoff_time, holding_point))
SELECT runway, timestamp, takeoff_time, CAST(seq AS BIGINT) AS seq, array_to_string(list_transform(steps, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') AS steps
FROM s WHERE seq >= {first}"""


def _sequences(spark, sf, include_self):
    rows = wait_rows(spark, sf).select("runway", "timestamp", "callsign", "icao", "takeoff_time", "holding_point")
    out = movements.sequences(rows, 10, ["takeoff_time"], ["runway"], ["timestamp", "callsign", "icao", "takeoff_time", "holding_point"], include_self)
    text = F.array_join(F.transform("steps", lambda x: x.cast("long").cast("string")), ",")
    return out.select("runway", micros("timestamp"), "takeoff_time", F.col("seq").cast("long").alias("seq"), text.alias("steps"))


@query("sequences", _sequence_sql("10 PRECEDING AND 1 PRECEDING", 11))
def _sequences_before(spark, sf):
    return _sequences(spark, sf, False)


@query("sequences_with_self", _sequence_sql("9 PRECEDING AND CURRENT ROW", 10))
def _sequences_self(spark, sf):
    return _sequences(spark, sf, True)


@query("position_time_slices", f"""WITH {MSG}, {POS}, b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM pos),
sl AS (SELECT lo + k * 3600000000 AS mid FROM b, unnest(generate_series(0, CAST((hi - lo) // 3600000000 AS BIGINT))) u(k))
SELECT mid AS slice_ts, epoch_us(ts) AS ts, icao, round(lat, 6) AS lat, round(lon, 6) AS lon FROM sl JOIN pos
  ON epoch_us(ts) BETWEEN mid - 1800000000 AND mid + 1800000000""")
def _position_time_slices(spark, sf):
    out = movements.position_time_slices(projections.positions(messages(spark, sf)), 60)
    return out.select(micros("slice_ts"), micros("ts"), "icao", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("scenario_feature_table", f"""WITH {located(DAY_S)}, firsts AS (SELECT *, min(CASE WHEN flight_status = 'on-ground' THEN ts END) OVER w AS first_on_ground_time,
  min(CASE WHEN designator IS NOT NULL THEN ts END) OVER w AS first_holding_time FROM loc WINDOW w AS (PARTITION BY callsign, day)),
seg AS (SELECT * FROM firsts WHERE ts >= first_holding_time), fast AS {nearest('seg', 'vel', 'speed', HOUR_S)},
stp AS (SELECT * FROM fast WHERE speed = 0 AND designator IS NOT NULL),
held AS (SELECT * REPLACE (min(ts) OVER (PARTITION BY callsign, day) AS first_holding_time) FROM stp)
SELECT 'scenario_' || CAST(CAST(icao AS BIGINT) % 10 AS VARCHAR) AS scenario_name, epoch_us(ts) AS timestamp, icao, callsign, designator AS holding_point,
  CAST({sec('first_holding_time')} - {sec('first_on_ground_time')} AS DOUBLE) AS time_before_holding_point,
  CAST({sec('ts')} - {sec('first_holding_time')} AS DOUBLE) AS time_at_holding_point FROM held
WHERE EXISTS (SELECT 1 FROM loc o WHERE CAST(o.icao AS BIGINT) % 10 = CAST(held.icao AS BIGINT) % 10
  AND ({sec('o.ts')} + 3599) // 3600 = {sec('held.ts')} // 3600)""")
def _scenario_feature_table(spark, sf):
    """Ten scenarios by aircraft number in one table; a row needs its scenario's occupancy of the hour before."""
    rows = messages(spark, sf).withColumn("scenario_name", F.concat(F.lit("scenario_"), (F.col("icao").cast("long") % 10).cast("string")))
    settings = replace(TEST_SETTINGS, scenario=True, by=("scenario_name",))
    located_once = freeze(plan.located_positions(rows, settings))
    flags = movements.occupancy(located_once, 3600, settings.by)
    out = joins.join_occupancy(plan.waits(rows, located_once, settings), flags, 3600, settings.by)
    return out.select("scenario_name", F.unix_micros("ts").alias("timestamp"), "icao", "callsign", F.col("designator").alias("holding_point"),
                      "time_before_holding_point", "time_at_holding_point")


@query("scenario_scoring")
def _scenario_scoring(spark, sf):
    """Features of ten scenarios, the rule-based estimate as model, answers for all of them."""
    raw = scenario_raw(spark, sf).withColumns({"tc": 5 + F.col("tc") % 17, "df": F.lit(17)})
    near = F.col("ts") % 2 == 0
    raw = raw.withColumns({"lat_deg": F.when(near, airport.CENTRE[0]).otherwise(F.col("lat_deg")), "lon_deg": F.when(near, airport.CENTRE[1]).otherwise(F.col("lon_deg"))})
    answers = answer_sheet(spark, sf)
    rows = scoring.scenario_features(raw, answers, replace(TEST_SETTINGS, per_day=False, occupancy_s=DAY_S))
    return scoring.score_scenarios(rows, answers, lambda df: df.withColumn("prediction", labels.rule_based_wait().cast("double")), meteo(spark, sf)).select(
        "scenario_name", "icao", "holding_point", "time_to_takeoff_s")
