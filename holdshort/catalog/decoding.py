"""Decoding of frames that Spark builds from `events`; the SQL states the fields the frames were built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdshort import airport
from holdshort.catalog import query
from holdshort.catalog.sql import num
from holdshort.catalog.tables import table
from holdshort.functions.frames import CATEGORIES, gray_altitude_ft
from holdshort.operators import decoding as ops


def raw_frames(spark, sf):
    """(event_id, message, ts_kafka): identification, position, ground, velocity, altitude and identity frames by
    event_id % 6; every 50th frame is not base64."""
    e = F.col("event_id")
    kind = e % 6

    def field(value, shift):
        return F.shiftleft(value.cast("long"), shift)

    letters = sum((field((e * 7 + i * 5) % 26 + 1, 42 - 6 * i) for i in range(8)), F.lit(0).cast("long"))
    ident = field(1 + e % 4, 51) + field(e % 8, 48) + letters
    cpr = field(e % 2, 34) + field(e * 7919 % 131072, 17) + (e * 104729 % 131072)
    air = field(9 + e % 10, 51) + field(F.lit(16) + e * 32 % 4000 + e % 16, 36) + cpr
    ground = field(5 + e % 4, 51) + field(e % 125, 44) + field(e % 2, 43) + field(e % 128, 36) + cpr
    speed = (field(F.lit(19), 51) + field(F.lit(1), 48) + field(e % 2, 42) + field(e % 500 + 2, 32) + field(e % 3 % 2, 31)
             + field(e % 300 + 2, 21) + field(e % 2, 19) + field(e % 510 + 1, 10))
    me = F.when(kind == 0, ident).when(kind == 1, air).when(kind == 2, ground).otherwise(speed)
    long_frame = F.concat(F.lpad(F.hex(F.lit(136) + 4 + e % 2), 2, "0"), F.lpad(F.hex(F.col("user_id") + 4096), 6, "0"),
                          F.lpad(F.hex(me), 14, "0"), F.lit("ABCDEF"))
    code = F.lit(16) + e * 32 % 64 + e % 16 + field(e % 60, 7)
    reply = F.concat(F.lpad(F.hex(F.when(kind == 4, 32).otherwise(40) + e % 4), 2, "0"), F.lit("00"),
                     F.lpad(F.hex(F.when(kind == 4, code).otherwise(e * 31 % 8192)), 4, "0"), F.lit("ABCDEF"))
    frame = F.base64(F.unhex(F.when(kind < 4, long_frame).otherwise(reply)))
    # the shifted ids are spelled out before the text is built
    return table(spark, sf, "events").select(
        "event_id", F.when(e % 50 == 0, "!not a frame!").otherwise(frame).alias("message"),
        (e * 977 + 1_700_000_000_000).alias("ts_kafka"))


BASE = """f AS (SELECT event_id AS e, event_id % 6 AS kind, user_id FROM events WHERE event_id % 50 <> 0)"""
TC = "CASE kind WHEN 0 THEN 1 + e % 4 WHEN 1 THEN 9 + e % 10 WHEN 2 THEN 5 + e % 4 WHEN 3 THEN 19 END"


def _with_bad(columns, nulls):
    return f"WITH {BASE} SELECT e AS event_id, {columns} FROM f UNION ALL SELECT event_id, {nulls} FROM events WHERE event_id % 50 = 0"


def decoded(spark, sf):
    return ops.decode_messages(raw_frames(spark, sf))


#: Parity of the first four bytes of a reply, against the last three that all replies here have.
REPLY = "((CASE kind WHEN 4 THEN 32 ELSE 40 END + e % 4) << 24) + CASE kind WHEN 4 THEN 16 + e * 32 % 64 + e % 16 + ((e % 60) << 7) ELSE e * 31 % 8192 END"
HIDDEN = f"""printf('%06X', xor(list_reduce(list_concat([({REPLY})::BIGINT << 24], range(55, 23, -1)),
  lambda a, i: CASE WHEN (a >> i) & 1 = 1 THEN xor(a, 33551369::BIGINT << (i - 24)) ELSE a END), 11259375))"""


@query("decode_header", _with_bad(f"CASE WHEN kind < 4 THEN 17 WHEN kind = 4 THEN 4 ELSE 5 END AS downlink_format, CASE WHEN kind < 4 THEN printf('%06X', user_id + 4096) ELSE {HIDDEN} END AS icao, CAST({TC} AS DOUBLE) AS typecode", "NULL, NULL, NULL"))
def _decode_header(spark, sf):
    return decoded(spark, sf).select("event_id", "downlink_format", "icao", "typecode")


@query("message_kind", _with_bad("CASE WHEN kind < 4 THEN 'ADS_B' WHEN kind = 4 THEN 'ALTITUDE' ELSE 'IDENTITY' END AS kinds", "NULL"))
def _message_kind(spark, sf):
    return decoded(spark, sf).select("event_id", F.array_join("kinds", ",").alias("kinds"))


@query("flight_status", _with_bad("""CASE WHEN kind = 2 THEN 'on-ground' WHEN kind IN (1, 3) THEN 'airborne'
  WHEN kind = 0 THEN CASE e % 2 WHEN 0 THEN 'on-ground' ELSE 'airborne' END ELSE CASE e % 4 % 2 WHEN 0 THEN 'airborne' ELSE 'on-ground' END END AS flight_status""", "NULL"))
def _flight_status(spark, sf):
    return decoded(spark, sf).select("event_id", "flight_status")


CATEGORY = "CASE (1 + e % 4) * 8 + CASE WHEN e % 4 = 0 THEN 0 ELSE e % 8 END " + " ".join(
    f"WHEN {t * 8 + c} THEN '{n}'" for (t, c), n in CATEGORIES.items()) + " END"


@query("wake_category", _with_bad(f"CASE WHEN kind = 0 THEN {CATEGORY} END AS wake_category", "NULL"))
def _wake_category(spark, sf):
    return decoded(spark, sf).select("event_id", "wake_category")


@query("callsign", _with_bad("CASE WHEN kind = 0 THEN " + " || ".join(f"chr(CAST(65 + (e * 7 + {i * 5}) % 26 AS INTEGER))" for i in range(8)) + " END AS callsign", "NULL"))
def _callsign(spark, sf):
    return decoded(spark, sf).select("event_id", "callsign")


ALT = "(16 + e * 32 % 4000 + e % 16)"
IDENT = "(e * 31 % 8192)"


def _bit(i):
    return f"(({IDENT} // {2 ** (13 - i)}) % 2)"


SQUAWK = " || ".join(f"CAST({_bit(a)} * 4 + {_bit(b)} * 2 + {_bit(c)} AS VARCHAR)" for a, b, c in ((6, 4, 2), (12, 10, 8), (5, 3, 1), (13, 11, 9)))


@query("altitude_squawk", _with_bad(f"""CASE WHEN kind = 4 THEN (e % 60 * 32 + (e * 32 % 64) // 32 * 16 + e % 16) * 25 - 1000.0
  WHEN kind = 2 THEN 0.0 WHEN kind = 1 AND {ALT} // 16 % 2 = 1 THEN ({ALT} // 32 * 16 + {ALT} % 16) * 25 - 1000.0 END::DOUBLE AS altitude_ft,
  CASE WHEN kind = 5 THEN {SQUAWK} END AS squawk""", "NULL, NULL"))
def _altitude_squawk(spark, sf):
    return decoded(spark, sf).select("event_id", "altitude_ft", "squawk")


def _gray(bits):
    """SQL for the number of a reflected binary code: each bit is the parity of the bits up to it."""
    at = [f"((event_id % 8192) // {2 ** (13 - i)} % 2)" for i in bits]
    return " + ".join(f"(({' + '.join(at[:k + 1])}) % 2) * {2 ** (len(bits) - 1 - k)}" for k in range(len(bits)))


@query("gray_altitude", f"""SELECT event_id, (fives * 500 + CASE WHEN fives % 2 = 1 THEN 6 - step ELSE step END * 100 - 1300)::BIGINT AS altitude_ft FROM (
  SELECT event_id, fives, CASE WHEN ones = 7 THEN 5 WHEN ones NOT IN (0, 5, 6) THEN ones END AS step FROM (
    SELECT event_id, {_gray((11, 13, 2, 4, 6, 8, 10, 12))} AS fives, {_gray((1, 3, 5))} AS ones FROM events))""")
def _gray_altitude(spark, sf):
    code = F.col("event_id") % 8192
    return table(spark, sf, "events").select("event_id", gray_altitude_ft(code).cast("long").alias("altitude_ft"))


MOVE = """CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN 0 WHEN m <= 8 THEN 0.125 * (m - 1) WHEN m <= 12 THEN 1 + 0.25 * (m - 9) WHEN m <= 38 THEN 2 + 0.5 * (m - 13)
  WHEN m <= 93 THEN m - 24 WHEN m <= 108 THEN 70 + 2 * (m - 94) WHEN m <= 123 THEN 100 + 5 * (m - 109) ELSE 175 END"""


@query("velocity", f"""WITH {BASE}, v AS (SELECT *, e % 125 AS m, (e % 500 + 1) * CASE e % 2 WHEN 1 THEN -1 ELSE 1 END AS vx,
  (e % 300 + 1) * CASE e % 3 % 2 WHEN 1 THEN -1 ELSE 1 END AS vy FROM f)
SELECT event_id, x.speed, x.angle, x.vertical_rate FROM events LEFT JOIN (SELECT e, CAST(CASE kind WHEN 2 THEN {MOVE} ELSE floor(sqrt(vx * vx + vy * vy)) END AS DOUBLE) AS speed,
  round(CASE WHEN kind = 3 THEN (degrees(atan2(vx, vy)) + 360) % 360 WHEN e % 2 = 1 THEN round(e % 128 * 2.8125e0, 1) END, 2) AS angle,
  CAST(CASE WHEN kind = 2 THEN 0 ELSE e % 510 * 64 * CASE e % 2 WHEN 1 THEN -1 ELSE 1 END END AS DOUBLE) AS vertical_rate FROM v WHERE kind IN (2, 3)) x ON x.e = event_id""")
def _velocity(spark, sf):
    return decoded(spark, sf).select("event_id", "speed", "angle", "vertical_rate")


LAT0, LON0 = num(airport.RADAR[0]), num(airport.RADAR[1])


@query("cpr_position_with_ref", f"""WITH {BASE}, c AS (SELECT e, e % 2 AS odd, (e * 7919 % 131072) / 131072e0 AS y, (e * 104729 % 131072) / 131072e0 AS x,
  CASE kind WHEN 2 THEN 90e0 ELSE 360e0 END AS span FROM f WHERE kind IN (1, 2)),
l AS (SELECT *, span / (60 - odd) AS dlat FROM c),
p AS (SELECT *, dlat * (floor({LAT0} / dlat) + floor(0.5 + ({LAT0} / dlat - floor({LAT0} / dlat)) - y) + y) AS lat FROM l),
z AS (SELECT *, floor(2 * pi() / acos(1 - (1 - cos(pi() / 30)) / pow(cos(radians(abs(lat))), 2))) - odd AS n FROM p),
q AS (SELECT *, span / greatest(n, 1) AS dlon FROM z)
SELECT event_id, round(lat, 5) AS lat, round(dlon * (floor({LON0} / dlon) + floor(0.5 + ({LON0} / dlon - floor({LON0} / dlon)) - x) + x), 5) AS lon
FROM events LEFT JOIN q ON e = event_id""")
def _cpr(spark, sf):
    return decoded(spark, sf).select("event_id", "lat", "lon")


@query("safe_decode", "SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 50 = 0) AS unreadable, 0 AS other_formats FROM events")
def _safe_decode(spark, sf):
    return ops.decode_quality(decoded(spark, sf))
