"""Cleaning, projections and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort import airport
from holdshort.catalog import query
from holdshort.catalog.sql import CAT, FLT, HP, MSG, POS, VEL, WAITS, located, segment, sec, stops
from holdshort.catalog.tables import messages, pick, table, wait_rows
from holdshort.operators import cleaning, movements, projections, scenarios
from holdshort.plans import features as plan
from holdshort.session import freeze

DAY_S = 86400
HOUR_S = 3600


def micros(c):
    return F.unix_micros(F.col(c)).alias(c)


@query("null_strings", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 AND event_id % 8 = 1 THEN NULL
  ELSE event_type END AS a, CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS b FROM events""")
def _null_strings(spark, sf):
    e = F.col("event_id")
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(e % 4 == 0, "nan").when(e % 8 == 1, "None").otherwise(F.col("event_type")).alias("a"),
        F.when(e % 6 == 0, "null").when(e % 3 == 0, "").otherwise(F.col("props")).alias("b"))
    return cleaning.null_strings(rows)


@query("cast_schema", """SELECT CAST(event_id AS INTEGER) AS "Downlink Format", CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS "Speed",
  CAST(user_id AS VARCHAR) AS "ICAO", event_type AS other FROM events""")
def _cast_schema(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("Downlink Format"),
        F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("Speed"),
        F.col("user_id").alias("ICAO"), F.col("event_type").alias("other"))
    return cleaning.cast_schema(rows)


@query("positions", f"WITH {MSG}, {POS} SELECT epoch_us(ts) AS ts, icao, flight_status, round(lat, 6) AS lat, round(lon, 6) AS lon FROM pos")
def _positions(spark, sf):
    return projections.positions(messages(spark, sf)).select(
        micros("ts"), "icao", "flight_status", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("airplane_categories", f"""WITH {MSG} SELECT DISTINCT icao, wake_category FROM msg
  WHERE downlink_format IN (17, 18) AND wake_category IS NOT NULL AND wake_category <> 'None'""")
def _airplane_categories(spark, sf):
    return projections.airplane_categories(messages(spark, sf))


@query("airplane_category", f"WITH {MSG}, {CAT} SELECT icao, wake_category FROM cat")
def _airplane_category(spark, sf):
    return projections.airplane_category(messages(spark, sf))


@query("flights", f"WITH {MSG}, {FLT} SELECT epoch_us(ts) AS ts, icao, callsign FROM flt")
def _flights(spark, sf):
    return projections.flights(messages(spark, sf)).select(micros("ts"), "icao", "callsign")


@query("altitudes", f"""WITH {MSG} SELECT epoch_us(ts) AS ts, icao, callsign, flight_status, round(altitude_ft, 4) AS altitude_ft,
  round(lat, 6) AS lat, round(lon, 6) AS lon FROM msg WHERE altitude_ft IS NOT NULL""")
def _altitudes(spark, sf):
    return projections.altitudes(messages(spark, sf)).select(
        micros("ts"), "icao", "callsign", "flight_status", F.round("altitude_ft", 4).alias("altitude_ft"),
        F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("velocities", f"WITH {MSG}, {VEL} SELECT epoch_us(ts) AS ts, icao, flight_status, speed FROM vel")
def _velocities(spark, sf):
    return projections.velocities(messages(spark, sf)).select(micros("ts"), "icao", "flight_status", "speed")


LOCATED_SPEEDS = f"""{MSG}, {POS}, spd AS (SELECT ts, icao, flight_status, speed, lat, lon FROM msg WHERE speed IS NOT NULL),
air AS (SELECT ts, icao, flight_status, speed FROM spd WHERE flight_status = 'airborne'),
placed AS (SELECT * EXCLUDE (rn, rid) FROM (SELECT l.*, r.lat, r.lon, row_number() OVER (PARTITION BY l.rid
  ORDER BY abs(epoch_us(l.ts) - epoch_us(r.ts)), r.ts, r.lat, r.lon) AS rn
  FROM (SELECT *, row_number() OVER () AS rid FROM air) l JOIN pos r ON l.icao = r.icao
  AND abs({sec('l.ts')} - {sec('r.ts')}) <= {HOUR_S}) WHERE rn = 1),
vl AS (SELECT ts, icao, flight_status, speed * 1.852e0 AS speed, lat, lon FROM
  (SELECT ts, icao, flight_status, speed, lat, lon FROM spd WHERE flight_status = 'on-ground'
   UNION ALL SELECT ts, icao, flight_status, speed, lat, lon FROM placed))"""


@query("velocities_located", f"""WITH {LOCATED_SPEEDS}
SELECT epoch_us(ts) AS ts, icao, flight_status, round(speed, 4) AS speed, round(lat, 6) AS lat, round(lon, 6) AS lon FROM vl""")
def _velocities_located(spark, sf):
    return projections.velocities_located(messages(spark, sf), HOUR_S).select(
        micros("ts"), "icao", "flight_status", F.round("speed", 4).alias("speed"),
        F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("messages_of_aircraft", f"WITH {MSG} SELECT epoch_us(ts) AS ts, icao, typecode, callsign FROM msg WHERE icao = '7'")
def _messages_of_aircraft(spark, sf):
    return projections.messages_of_aircraft(messages(spark, sf), "7").select(micros("ts"), "icao", "typecode", "callsign")


@query("latest_n", f"WITH {MSG} SELECT epoch_us(ts) AS ts, icao, typecode FROM msg WHERE icao = '7' ORDER BY msg.ts DESC LIMIT 3")
def _latest_n(spark, sf):
    return projections.latest_n(messages(spark, sf), "7", 3).select(micros("ts"), "icao", "typecode")


@query("clean_basic", f"""WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, callsign, takeoff_time,
  trim(regexp_replace(turbulence_category, '\\(.*\\)', '')) AS turbulence_category,
  trim(regexp_replace(last_event_turb_cat, '\\(.*\\)', '')) AS last_event_turb_cat FROM wr""")
def _clean_basic(spark, sf):
    rows = wait_rows(spark, sf).select(
        "timestamp", "callsign", "takeoff_time", "turbulence_category", "last_event_turb_cat",
        F.lit("takeoff").alias("last_event"), F.lit(1.0).alias("lat"), F.lit(None).cast("double").alias("snow_depth (m)"),
        F.col("takeoff_time").alias("rain (mm)"))
    return cleaning.clean_basic(rows).withColumn("timestamp", F.unix_micros("timestamp"))


OUT = "bad AS (SELECT DISTINCT callsign, CAST(timestamp AS DATE) AS day FROM wr WHERE takeoff_time <= 20 OR takeoff_time >= 240)"


@query("drop_out_of_bounds_flights", f"""WITH {WAITS}, {OUT} SELECT epoch_us(timestamp) AS timestamp, callsign, takeoff_time FROM wr
  WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.callsign = wr.callsign AND bad.day = CAST(wr.timestamp AS DATE))""")
def _drop_out_of_bounds(spark, sf):
    return cleaning.drop_out_of_bounds_flights(wait_rows(spark, sf), "takeoff_time", 20, 240).select(
        micros("timestamp"), "callsign", "takeoff_time")


@query("bounds_report", f"""WITH {WAITS}, {OUT} SELECT count(*) AS removed_rows, (SELECT count(*) FROM bad) AS removed_flights
  FROM wr JOIN bad ON bad.callsign = wr.callsign AND bad.day = CAST(wr.timestamp AS DATE)""")
def _bounds_report(spark, sf):
    return cleaning.bounds_report(wait_rows(spark, sf), "takeoff_time", 20, 240)


@query("out_of_bounds_flights", f"WITH {WAITS}, {OUT} SELECT callsign, CAST(day AS VARCHAR) AS day FROM bad")
def _out_of_bounds_flights(spark, sf):
    return cleaning.out_of_bounds_flights(wait_rows(spark, sf), "takeoff_time", 20, 240).withColumn("day", F.col("day").cast("string"))


JUMPS = """trk AS (SELECT ts, icao, callsign, lat, lon FROM msg WHERE lat IS NOT NULL),
t1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao, ts ORDER BY lat, lon) AS k FROM trk) WHERE k = 1)"""


@query("remove_outlier_flights", f"""WITH {MSG}, {JUMPS},
steps AS (SELECT icao, epoch_us(ts) // 1000000 - lag(epoch_us(ts) // 1000000) OVER w AS dt, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
  FROM t1 WINDOW w AS (PARTITION BY icao ORDER BY ts)),
jump AS (SELECT DISTINCT icao FROM steps WHERE dt < 7200 AND 12756e0 * asin(sqrt(pow(sin(radians(plat - lat) / 2), 2)
  + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plon - lon) / 2), 2))) > 50)
SELECT epoch_us(ts) AS ts, icao, round(lat, 6) AS lat FROM trk WHERE icao NOT IN (SELECT icao FROM jump)""")
def _remove_outlier_flights(spark, sf):
    rows = messages(spark, sf).select("ts", "icao", F.col("icao").alias("callsign"), "lat", "lon")
    return movements.remove_outlier_flights(rows, 50.0, 7200).select(micros("ts"), "icao", F.round("lat", 6).alias("lat"))


@query("null_profile", """SELECT 'callsign' AS column_name, count(*) - count(callsign) AS nulls FROM (WITH """ + MSG + """ SELECT * FROM msg)
UNION ALL SELECT 'speed', count(*) - count(speed) FROM (WITH """ + MSG + """ SELECT * FROM msg)
UNION ALL SELECT 'altitude_ft', count(*) - count(altitude_ft) FROM (WITH """ + MSG + """ SELECT * FROM msg)""")
def _null_profile(spark, sf):
    return cleaning.null_profile(messages(spark, sf).select("callsign", "speed", "altitude_ft"))


@query("impute_constants", f"""WITH {MSG} SELECT epoch_us(ts) AS ts, icao, coalesce(speed, 0) AS speed,
  coalesce(callsign, '__MISSING__') AS callsign FROM msg""")
def _impute_constants(spark, sf):
    rows = messages(spark, sf).select("ts", "icao", "speed", "callsign")
    return cleaning.impute_constants(rows, ["speed"], ["callsign"]).withColumn("ts", F.unix_micros("ts"))


def scenario_raw(spark, sf):
    """A foreign recording from `events`: ten scenarios by aircraft number."""
    e = F.col("event_id")
    labels = list(scenarios.WAKE_LABELS)
    return table(spark, sf, "events").select(
        F.concat(F.lit("scenario_"), (F.col("user_id") % 10).cast("string")).alias("scenario_name"),
        F.unix_millis("ts").alias("ts"), F.col("user_id").cast("string").alias("icao24"),
        F.when(e % 3 == 0, 20).otherwise(17).alias("df"), (e % 30).alias("tc"),
        F.when(e % 4 == 0, F.concat(F.lit("AB"), F.col("user_id").cast("string"))).alias("callsign"),
        F.when(e % 5 == 0, F.concat(F.lit("CD"), F.col("user_id").cast("string"))).alias("bds20_callsign"),
        F.lit(40.5).alias("lat_deg"), F.lit(-3.5).alias("lon_deg"),
        F.when(e % 2 == 0, e * 25).alias("altitude"), F.when(e % 3 == 0, e * 5).alias("bds05_altitude"),
        F.when(e % 7 == 0, F.col("value")).alias("groundspeed"), F.when(e % 2 == 1, F.col("value") + 1).alias("bds50_groundspeed"),
        F.when(e % 9 == 8, "unknown").otherwise(pick(labels, e % 8)).alias("wake_vortex"))


WAKE_CASE = "CASE event_id % 8 " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(scenarios.WAKE_LABELS.values())) + " END"
SCENARIO = f"""sc AS (SELECT 'scenario_' || CAST(user_id % 10 AS VARCHAR) AS scenario_name, epoch_us(ts) // 1000 * 1000 AS ts,
  CAST(user_id AS VARCHAR) AS icao, CASE WHEN event_id % 3 = 0 THEN 20 ELSE 17 END AS downlink_format,
  CAST(event_id % 30 AS DOUBLE) AS typecode,
  CASE WHEN event_id % 3 <> 0 AND event_id % 30 BETWEEN 5 AND 8 THEN 'on-ground'
       WHEN event_id % 3 <> 0 AND event_id % 30 BETWEEN 9 AND 22 THEN 'airborne' ELSE 'NaN' END AS flight_status,
  CASE WHEN event_id % 9 = 8 THEN NULL ELSE {WAKE_CASE} END AS wake_category,
  CASE WHEN event_id % 4 = 0 THEN 'AB' || CAST(user_id AS VARCHAR) WHEN event_id % 5 = 0 THEN 'CD' || CAST(user_id AS VARCHAR) END AS callsign,
  40.5e0 AS lat, -3.5e0 AS lon,
  CASE WHEN event_id % 7 = 0 THEN value WHEN event_id % 2 = 1 THEN value + 1 END AS speed,
  CAST(CASE WHEN event_id % 2 = 0 THEN event_id * 25 WHEN event_id % 3 = 0 THEN event_id * 5 END AS DOUBLE) AS altitude_ft FROM events)"""
SCENARIO_COLUMNS = ["scenario_name", "ts", "icao", "downlink_format", "typecode", "flight_status", "wake_category",
                    "callsign", "lat", "lon", "speed", "altitude_ft"]


@query("normalise_scenario", f"WITH {SCENARIO} SELECT * REPLACE (round(speed, 4) AS speed) FROM sc")
def _normalise_scenario(spark, sf):
    out = scenarios.normalise_scenario(scenario_raw(spark, sf))
    return out.withColumns({"ts": F.unix_micros("ts"), "speed": F.round("speed", 4)})


def answer_sheet(spark, sf):
    """One asked aircraft, holding point and runway per scenario: the smallest aircraft number of each."""
    u = F.col("user_id")
    asked = table(spark, sf, "events").groupBy((u % 10).alias("s")).agg(F.min("user_id").alias("user_id"))
    points = airport.HOLDING_POINTS
    return asked.select(
        F.concat(F.lit("scenario_"), F.col("s").cast("string")).alias("scenario_name"), u.cast("string").alias("icao"),
        pick([p[0] for p in points], F.col("s") * 2).alias("holding_point"),
        pick([p[1][4:] + "/" + p[1][:3] for p in points], F.col("s") * 2).alias("runway"),
        F.lit(None).cast("double").alias("time_to_takeoff_s"))


@query("inject_synthetic_rows", f"""WITH {SCENARIO}, asked AS (SELECT scenario_name, CAST(min(CAST(icao AS BIGINT)) AS VARCHAR) AS icao FROM sc GROUP BY 1),
{HP},
lasts AS (SELECT sc.scenario_name, sc.icao, max(ts) AS ts FROM sc JOIN asked a ON a.scenario_name = sc.scenario_name AND a.icao = sc.icao GROUP BY ALL),
added AS (SELECT l.scenario_name, l.ts + s.k * 1000 AS ts, l.icao, 'on-ground' AS flight_status,
  CASE WHEN s.k = 1 THEN 0e0 END AS speed, CASE WHEN s.k = 2 THEN hp.plat END AS lat, CASE WHEN s.k = 2 THEN hp.plon END AS lon
  FROM lasts l, (VALUES (1), (2)) s(k), hp WHERE hp.i = CAST(substr(l.scenario_name, 10) AS INTEGER) * 2)
SELECT scenario_name, ts, icao, flight_status, round(speed, 4) AS speed, round(lat, 6) AS lat, round(lon, 6) AS lon FROM (
  SELECT scenario_name, ts, icao, flight_status, speed, lat, lon FROM sc UNION ALL
  SELECT scenario_name, ts, icao, flight_status, speed, lat, lon FROM added)""")
def _inject(spark, sf):
    rows = scenarios.normalise_scenario(scenario_raw(spark, sf))
    return scenarios.inject_synthetic_rows(rows, answer_sheet(spark, sf)).select(
        "scenario_name", micros("ts"), "icao", "flight_status", F.round("speed", 4).alias("speed"),
        F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("sort_by_time", f"WITH {MSG} SELECT epoch_us(ts) AS ts, icao, typecode FROM msg ORDER BY ts, icao")
def _sort_by_time(spark, sf):
    return projections.sort_by_time(messages(spark, sf), "icao").select(micros("ts"), "icao", "typecode")


@query("union", f"""WITH {MSG} SELECT icao, speed, NULL AS altitude_ft FROM msg WHERE flight_status = 'on-ground'
  UNION ALL SELECT icao, NULL, round(altitude_ft, 4) FROM msg WHERE flight_status = 'airborne'""")
def _union(spark, sf):
    m = messages(spark, sf)
    return projections.union_all(
        m.where("flight_status = 'on-ground'").select("icao", "speed"),
        m.where("flight_status = 'airborne'").select(F.round("altitude_ft", 4).alias("altitude_ft"), "icao"))


FINAL = f"WITH {located(DAY_S)}, {segment()}, {stops(HOUR_S)}"
TEST_SETTINGS = plan.Settings(callsign_tolerance_s=DAY_S, speed_tolerance_s=HOUR_S, occupancy_s=3600, rate_s=86400)


@query("select_final", FINAL + """ SELECT takeoff_time, epoch_us(ts) AS timestamp, icao, callsign, designator AS holding_point,
  time_before_holding_point, time_at_holding_point, wake_category AS turbulence_category FROM held""")
def _select_final(spark, sf):
    m = messages(spark, sf)
    held = plan.waits(m, freeze(plan.located_positions(m, TEST_SETTINGS)), TEST_SETTINGS)
    missing = {"last_min_takeoffs": F.lit(0), "last_event": F.lit(None).cast("string"), "last_min_landings": F.lit(0),
               "last_event_turb_cat": F.lit("N/C"), "time_since_last_event_seconds": F.lit(0), "event_ts": F.col("ts"),
               "operator": F.substring("callsign", 1, 3)}
    flags = {n: F.lit(False) for n in plan.select_flags()}
    out = plan.select_final(plan.calendar(held.withColumns(missing | flags), "ts"))
    return out.select("takeoff_time", micros("timestamp"), "icao", "callsign", "holding_point", "time_before_holding_point",
                      "time_at_holding_point", "turbulence_category")
