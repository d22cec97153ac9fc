"""Scalar functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort import airport
from holdshort.catalog import query
from holdshort.catalog.aggregates import rounded
from holdshort.catalog.cleaning import micros
from holdshort.catalog.sql import CENTRE, HOLIDAYS, HP, MSG, WAITS, great_circle, haversine, num, sec
from holdshort.catalog.tables import messages, table, wait_rows
from holdshort.functions import geo, labels, timing

RADAR_SQL = haversine(num(airport.RADAR[0]), num(airport.RADAR[1]), "lat", "lon")


@query("great_circle_distance", f"WITH {MSG} SELECT epoch_us(ts) AS ts, round({great_circle(num(40.0), num(-3.0), 'lat', 'lon')}, 2) AS metres FROM msg")
def _great_circle(spark, sf):
    return messages(spark, sf).select(micros("ts"), F.round(geo.great_circle_m(40.0, -3.0, "lat", "lon"), 2).alias("metres"))


@query("haversine_distance", f"""WITH {MSG} SELECT epoch_us(ts) AS ts, round(CASE WHEN speed IS NOT NULL THEN {RADAR_SQL} END, 4) AS km FROM msg""")
def _haversine(spark, sf):
    lat = F.when(F.col("speed").isNotNull(), F.col("lat"))
    return messages(spark, sf).select(micros("ts"), F.round(geo.haversine_km(*airport.RADAR, lat, "lon"), 4).alias("km"))


@query("within_airport", f"WITH {MSG} SELECT epoch_us(ts) AS ts, {CENTRE} <= 5000 AS inside FROM msg")
def _within_airport(spark, sf):
    return messages(spark, sf).select(micros("ts"), geo.within_airport("lat", "lon").alias("inside"))


@query("in_holding_point", f"""WITH {MSG}, {HP}, s AS (SELECT DISTINCT lat, lon FROM msg),
d AS (SELECT s.lat, s.lon, min({haversine('plat', 'plon', 's.lat', 's.lon')}) AS km FROM s, hp GROUP BY ALL)
SELECT epoch_us(ts) AS ts, km <= 0.01 AS inside FROM msg JOIN d USING (lat, lon)""")
def _in_holding_point(spark, sf):
    return messages(spark, sf).select(micros("ts"), geo.in_holding_point("lat", "lon").alias("inside"))


@query("nearest_numbered_runway", f"""WITH {MSG} SELECT epoch_us(ts) AS ts, (SELECT min_by(name, (msg.lat - a) * (msg.lat - a) + (msg.lon - b) * (msg.lon - b))
  FROM (VALUES {", ".join(f"('{n}', {num(a)}, {num(b)})" for n, a, b in airport.NUMBERED_RUNWAYS)}) s(name, a, b)) AS runway FROM msg""")
def _nearest_numbered_runway(spark, sf):
    return messages(spark, sf).select(micros("ts"), geo.nearest_numbered_runway("lat", "lon").alias("runway"))


@query("radar_range", f"""WITH {MSG}, h AS (SELECT ts, lat, lon, coalesce(altitude_ft, 0) * 0.0003048e0 AS km FROM msg)
SELECT epoch_us(ts) AS ts, round(6378e0 * acos(6378e0 / (6378e0 + km)), 3) AS horizon_km,
  {RADAR_SQL} <= 333.36 AND {RADAR_SQL} <= 6378e0 * acos(6378e0 / (6378e0 + km)) AS valid FROM h""")
def _radar_range(spark, sf):
    rows = messages(spark, sf).withColumn("km", F.coalesce("altitude_ft", F.lit(0.0)) * 0.0003048)
    return rows.select(micros("ts"), F.round(geo.radar_horizon_km("km"), 3).alias("horizon_km"),
                       geo.valid_airborne_position("lat", "lon", "km").alias("valid"))


@query("knots_to_kmh", f"WITH {MSG} SELECT epoch_us(ts) AS ts, round(speed * 1.852e0, 4) AS kmh FROM msg")
def _knots(spark, sf):
    return messages(spark, sf).select(micros("ts"), F.round(geo.knots_to_kmh("speed"), 4).alias("kmh"))


@query("epoch_ms_to_timestamp", "SELECT event_id, strftime(make_timestamp((1700000000000 + event_id * 977) * 1000), '%Y-%m-%d %H:%M:%S') AS at FROM events")
def _epoch_ms(spark, sf):
    at = timing.from_epoch_ms(F.col("event_id") * 977 + 1_700_000_000_000)
    return table(spark, sf, "events").select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("calendar_features", f"""SELECT o_orderkey, hour(t) AS hour, strftime(t, '%a') AS weekday, CAST(CAST(t AS DATE) AS VARCHAR) AS date,
  CAST(CAST(t AS DATE) AS VARCHAR) IN {HOLIDAYS} AS is_holiday FROM (SELECT o_orderkey, TIMESTAMP '2024-01-01' + to_hours(o_orderkey % 17500) AS t FROM orders)""")
def _calendar(spark, sf):
    t = F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("o_orderkey") % 17500) * 3600)
    rows = table(spark, sf, "orders").select("o_orderkey", t.alias("t"))
    return rows.select("o_orderkey", F.hour("t").alias("hour"), timing.weekday("t").alias("weekday"),
                       F.to_date("t").cast("string").alias("date"), timing.is_holiday("t").alias("is_holiday"))


@query("time_buckets", f"""SELECT event_id, {sec('ts')} // 10 * 10 AS floor_10s, ({sec('ts')} + 9) // 10 * 10 AS ceil_10s, ({sec('ts')} + 59) // 60 * 60 AS ceil_minute,
  epoch_us(date_trunc('minute', ts)) // 1000000 AS minute, epoch_us(date_trunc('hour', ts)) // 1000000 AS hour FROM events""")
def _time_buckets(spark, sf):
    s = F.unix_seconds
    return table(spark, sf, "events").select(
        "event_id", s(timing.floor_s("ts", 10)).alias("floor_10s"), s(timing.ceil_s("ts", 10)).alias("ceil_10s"),
        s(timing.ceil_s("ts", 60)).alias("ceil_minute"), s(F.date_trunc("minute", "ts")).alias("minute"),
        s(F.date_trunc("hour", "ts")).alias("hour"))


@query("cyclic_time", f"""WITH {WAITS}, d AS (SELECT timestamp, hour, list_position(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'], weekday) - 1 AS weekday_num FROM wr)
SELECT epoch_us(timestamp) AS timestamp, weekday_num, round(sin(2 * pi() * hour / 24), 6) AS hour_sin, round(cos(2 * pi() * hour / 24), 6) AS hour_cos,
  round(sin(2 * pi() * weekday_num / 7), 6) AS weekday_sin, round(cos(2 * pi() * weekday_num / 7), 6) AS weekday_cos FROM d""")
def _cyclic(spark, sf):
    out = timing.with_cyclic_time(wait_rows(spark, sf)).select(
        micros("timestamp"), "weekday_num", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos")
    return rounded(out, "hour_sin", "hour_cos", "weekday_sin", "weekday_cos")


@query("log_target", f"WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, takeoff_time, round(ln(1 + takeoff_time), 6) AS logged, round(takeoff_time, 6) AS back FROM wr")
def _log_target(spark, sf):
    rows = wait_rows(spark, sf).withColumn("logged", labels.log_target("takeoff_time"))
    return rounded(rows.select(micros("timestamp"), "takeoff_time", "logged", labels.unlog_target("logged").alias("back")), "logged", "back")


@query("operator_code", f"WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, callsign, substr(callsign, 1, 3) AS operator FROM wr")
def _operator_code(spark, sf):
    return wait_rows(spark, sf).select(micros("timestamp"), "callsign", labels.operator_code("callsign").alias("operator"))


@query("strip_parenthesised", """SELECT doc_id, md5(trim(regexp_replace(t, '\\(.*\\)', ''))) AS greedy, md5(trim(regexp_replace(t, '\\s*\\(.*?\\)', '', 'g'))) AS each
  FROM (SELECT doc_id, regexp_replace(source || ' (' || lang || ') and (' || text || ') end', '[\\n\\r\\x{85}\\x{2028}\\x{2029}]', ' ', 'g') AS t FROM documents)""")
def _strip(spark, sf):
    t = F.regexp_replace(F.concat("source", F.lit(" ("), "lang", F.lit(") and ("), "text", F.lit(") end")), "[\\n\\r\\u0085\\u2028\\u2029]", " ")
    rows = table(spark, sf, "documents").select("doc_id", t.alias("t"))
    return rows.select("doc_id", F.md5(labels.strip_parenthesised("t").cast("binary")).alias("greedy"),
                       F.md5(labels.strip_parenthesised("t", greedy=False).cast("binary")).alias("each"))


@query("wait_class", f"""WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, takeoff_time, CASE WHEN takeoff_time < 30 THEN 0 WHEN takeoff_time < 60 THEN 1
  WHEN takeoff_time < 90 THEN 2 WHEN takeoff_time < 120 THEN 3 WHEN takeoff_time < 150 THEN 4 WHEN takeoff_time < 180 THEN 5 ELSE 6 END AS wait_class FROM wr""")
def _wait_class(spark, sf):
    return wait_rows(spark, sf).select(micros("timestamp"), "takeoff_time", labels.wait_class("takeoff_time").alias("wait_class"))


@query("day_off", f"WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, CASE WHEN is_holiday OR weekday IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS day_off FROM wr")
def _day_off(spark, sf):
    return wait_rows(spark, sf).select(micros("timestamp"), labels.day_off().alias("day_off"))


@query("rule_based_wait", f"""WITH {WAITS} SELECT epoch_us(timestamp) AS timestamp, greatest(30, 100
  + CASE WHEN last_min_takeoffs + last_min_landings > 5 THEN 40 WHEN last_min_takeoffs + last_min_landings > 3 THEN 20 ELSE 5 END
  + CASE WHEN last_event_turb_cat LIKE 'H%' THEN 30 WHEN last_event_turb_cat LIKE 'M%' THEN 15 ELSE 0 END
  + CASE WHEN time_since_last_event_seconds < 60 THEN 60 - time_since_last_event_seconds ELSE 0 END
  + CASE WHEN hour BETWEEN 7 AND 10 OR hour BETWEEN 17 AND 20 THEN 100 ELSE 0 END
  - CASE WHEN is_holiday THEN 30 ELSE 0 END) AS prediction FROM wr""")
def _rule_based_wait(spark, sf):
    return wait_rows(spark, sf).select(micros("timestamp"), labels.rule_based_wait().alias("prediction"))


@query("zero_pair_to_null", "SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 2 END AS first FROM events")
def _zero_pair(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select("event_id", labels.null_if_zero_pair(e % 2, e % 3).alias("first"))


@query("runway_label", """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '32R/14L' WHEN 1 THEN '32R/14L' ELSE '36L/18R' END AS runway FROM supplier""")
def _runway_label(spark, sf):
    k = F.col("s_suppkey") % 3
    raw = F.when(k == 0, "14L/32R").when(k == 1, "32R/14L").otherwise("18R/36L")
    return table(spark, sf, "supplier").select("s_suppkey", geo.runway_label(raw).alias("runway"))


@query("collect_set_contains", f"""WITH {MSG} SELECT icao, array_to_string(list_sort(list(DISTINCT flight_status)), ',') AS statuses,
  bool_or(flight_status = 'airborne') AS flew FROM msg WHERE flight_status IS NOT NULL GROUP BY 1""")
def _collect_set(spark, sf):
    """The set of statuses per aircraft; a status has two values, so the set is bounded."""
    sets = messages(spark, sf).where("flight_status IS NOT NULL").groupBy("icao").agg(F.collect_set("flight_status").alias("s"))
    return sets.select("icao", F.array_join(F.array_sort("s"), ",").alias("statuses"), F.array_contains("s", "airborne").alias("flew"))
