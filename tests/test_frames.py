"""Published example frames."""

import base64

import pytest
from pyspark.sql import functions as F

from holdshort.functions import frames
from holdshort.operators.decoding import decode_messages


def decode(spark, *hexes, **options):
    raw = [(base64.b64encode(bytes.fromhex(h)).decode(), 1_700_000_000_000 + i) for i, h in enumerate(hexes)]
    return decode_messages(spark.createDataFrame(raw, "message string, ts_kafka long"), **options).orderBy("ts_kafka").collect()


def test_identification(spark):
    r, = decode(spark, "8D4840D6202CC371C32CE0576098")
    assert (r.icao, r.downlink_format, r.typecode, r.callsign) == ("4840D6", 17, 4.0, "KLM1023_")
    assert r.kinds == ["ADS_B"]


def test_airborne_position(spark):
    even, odd = decode(spark, "8D40621D58C382D690C8AC2863A7", "8D40621D58C386435CC412692AD6", reference=(52.258, 3.918))
    assert (even.lat, even.lon, even.altitude_ft) == (52.2572, 3.91937, 38000.0)
    assert (odd.lat, odd.lon) == pytest.approx((52.26578, 3.93891), abs=2e-5)
    assert even.flight_status == "airborne"


def test_surface_position_and_speed(spark):
    r, = decode(spark, "8C4841753A9A153237AEF0F275BE", reference=(51.99, 4.375))
    assert (r.lat, r.lon) == pytest.approx((52.32056, 4.73573), abs=2e-5)
    assert (r.speed, r.angle, r.vertical_rate, r.speed_type) == (17.0, 92.8, 0.0, "GS")
    assert r.flight_status == "on-ground"


def test_velocity(spark):
    ground, air = decode(spark, "8D485020994409940838175B284F", "8DA05F219B06B6AF189400CBC33F")
    assert (ground.speed, ground.angle, ground.vertical_rate, ground.speed_type) == (159.0, 182.88, -832.0, "GS")
    assert (air.speed, air.angle, air.vertical_rate, air.speed_type) == (375.0, 243.98, -2304.0, "TAS")


def test_replies(spark):
    a, c, d = decode(spark, "A02014B400000000000000F9D514", "2A00516D492B80", "A800292DFFBBA9383FFCEB903D01")
    assert a.altitude_ft == 32300.0
    assert (c.squawk, d.squawk) == ("0356", "1346")



def plain_address(text):
    number, size = int(text[:-6], 16) << 24, 4 * len(text)
    for shift in range(size - 25, -1, -1):
        if number >> (shift + 24) & 1:
            number ^= 0x1FFF409 << shift
    return f"{number ^ int(text[-6:], 16):06X}"


def test_addresses_of_replies(spark):
    texts = ["A02014B400000000000000F9D514", "2A00516D492B80", "A800292DFFBBA9383FFCEB903D01", "20000F1F684A6C"]
    assert [r.icao for r in decode(spark, *texts)] == [plain_address(t) for t in texts]
    # in a squitter with the same parity the address in the clear leaves no remainder
    assert plain_address("8D406B902015A678D4D220AA4BDA") == "000000"


def test_gray_altitudes(spark):
    def code(feet):
        fives, ones = divmod(feet + 1200, 500)
        ones = ones // 100 + 1
        ones = 6 - ones if fives % 2 else ones
        ones = 7 if ones == 5 else ones
        gray = {i: (n ^ n >> 1) >> shift & 1 for n, spots in ((fives, (11, 13, 2, 4, 6, 8, 10, 12)), (ones, (1, 3, 5)))
                for shift, i in enumerate(reversed(spots))}
        return sum(bit << (13 - i) for i, bit in gray.items())

    feet = list(range(-1200, 60_000, 100))
    rows = spark.createDataFrame([(f, code(f)) for f in feet], "feet int, code int")
    assert all(r.feet == r.got for r in rows.withColumn("got", frames.gray_altitude_ft(F.col("code"))).collect())


def test_longitude_zones(spark):
    rows = spark.createDataFrame([(0.0, 59), (10.0, 59), (52.2572, 36), (-52.2572, 36), (87.0, 2), (88.0, 1), (None, None)], "lat double, nl int")
    assert all(r.nl == r.z for r in rows.withColumn("z", frames.longitude_zones("lat")).collect())


def test_bad_frames_keep_their_row(spark):
    raw = spark.createDataFrame([("!!", 1), (None, 2), ("AAAA", 3)], "message string, ts_kafka long")
    out = decode_messages(raw).collect()
    assert len(out) == 3 and all(r.hex is None and r.icao is None and r.lat is None for r in out)


def test_compat_reads_the_fifth_byte(spark):
    # fifth byte 0x99: top bits 100 = 4 -> on the ground by the capability table; type code 19 still wins
    r, = decode(spark, "8D485020994409940838175B284F", compat=True)
    assert r.flight_status == "airborne"
    r, = decode(spark, "8D4840D6202CC371C32CE0576098", compat=True)
    assert r.flight_status is None
