"""Fields of 1090 MHz surveillance frames as bit expressions over their hexadecimal text.

Every expression gives null for a frame it does not apply to or cannot read, so a bad frame never fails a job.
Bit positions follow the public description of the frame formats.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort import airport
from holdshort.schemas import AIRBORNE, ON_GROUND

# Six-bit character set of the identification message.
CHARSET = "#ABCDEFGHIJKLMNOPQRSTUVWXYZ#####_###############0123456789######"

# Fixed value: polynomial of the 24 parity bits, without its highest term.
PARITY = 0xFFF409

# What a downlink format carries.
KINDS = {
    4: ["ALTITUDE"], 5: ["IDENTITY"], 17: ["ADS_B"], 18: ["ADS_B"],
    20: ["MODE_S", "ALTITUDE"], 21: ["MODE_S", "IDENTITY"],
}

# Status by flight-status field and by capability field.
STATUS_BY_FS = {0: AIRBORNE, 1: ON_GROUND, 2: AIRBORNE, 3: ON_GROUND}
STATUS_BY_CA = {4: ON_GROUND, 5: AIRBORNE}

# Aircraft category by (type code, category field).
CATEGORIES = {
    (0, 0): "No category information",
    (1, 0): "Reserved",
    (2, 1): "Surface emergency vehicle",
    (2, 3): "Surface service vehicle",
    (2, 4): "Ground obstruction",
    (2, 5): "Ground obstruction",
    (2, 6): "Ground obstruction",
    (2, 7): "Ground obstruction",
    (3, 1): "Glider, sailplane",
    (3, 2): "Lighter-than-air",
    (3, 3): "Parachutist, skydiver",
    (3, 4): "Ultralight, hang-glider, paraglider",
    (3, 5): "Reserved",
    (3, 6): "Unmanned aerial vehicle",
    (3, 7): "Space or transatmospheric vehicle",
    (4, 1): "Light (less than 7000 kg)",
    (4, 2): "Medium 1 (between 7000 kg and 34000 kg)",
    (4, 3): "Medium 2 (between 34000 kg to 136000 kg)",
    (4, 4): "High vortex aircraft",
    (4, 5): "Heavy (larger than 136000 kg)",
    (4, 6): "High performance (>5 g acceleration) and high speed (>400 kt)",
    (4, 7): "Rotorcraft",
}

# Ground movement codes as (first code, last code, speed of the first in knots, step).
MOVEMENT = [
    (1, 1, 0.0, 0.0), (2, 8, 0.125, 0.125), (9, 12, 1.0, 0.25), (13, 38, 2.0, 0.5),
    (39, 93, 15.0, 1.0), (94, 108, 70.0, 2.0), (109, 123, 100.0, 5.0), (124, 124, 175.0, 0.0),
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frame_text(message="message") -> Column:
    """Upper-case hexadecimal text of a base64 frame; null if it is not base64."""
    return F.hex(F.try_to_binary(_col(message), F.lit("base64")))


def _number(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def _bits(number, size: int, first: int, count: int) -> Column:
    """`count` bits of a `size`-bit number starting at bit `first` (1 is the highest)."""
    return F.shiftright(_col(number), size - first - count + 1).bitwiseAND(F.lit((1 << count) - 1))


def with_frame_parts(rows: DataFrame, message: str = "message") -> DataFrame:
    """Add the parts of a frame that the field expressions below read, each worked out once per row:

    hex (7 or 14 bytes, else null), downlink_format, head (first four bytes as a number), me (the 56-bit message field
    of an extended squitter) and tc (its type code).
    """
    rows = rows.withColumn("hex", frame_text(message))
    rows = rows.withColumn("hex", F.when(F.length("hex").isin(7 * 2, 14 * 2), F.col("hex")))
    rows = rows.withColumn("head", _number(F.substring("hex", 1, 8)))
    df = _bits("head", 32, 1, 5)
    rows = rows.withColumn("downlink_format", F.when(df > 24, 24).otherwise(df).cast("int"))
    squitter = F.col("downlink_format").isin(17, 18) & (F.length("hex") == 28)
    rows = rows.withColumn("me", F.when(squitter, _number(F.substring("hex", 9, 14))))
    return rows.withColumn("tc", _bits("me", 56, 1, 5).cast("int"))


def _remainders() -> list[int]:
    """Remainder of each byte value, moved up by 24 bits, by the parity polynomial."""
    out = []
    for byte in range(256):
        value = byte << 16
        for _ in range(8):
            value = value << 1 ^ (PARITY if value >> 23 & 1 else 0)
        out.append(value & 0xFFFFFF)
    return out


def parity_address(hex_text="hex") -> Column:
    """Address that a reply hides in its last three bytes: their difference to the parity of the bytes before."""
    text = _col(hex_text)
    table = F.array(*[F.lit(x) for x in _remainders()])
    spots = F.sequence(F.lit(1), F.length(text) - 7, F.lit(2))
    low = lambda c: c.bitwiseAND(F.lit(0xFFFFFF))

    def step(parity: Column, at: Column) -> Column:
        byte = F.conv(F.substr(text, at, F.lit(2)), 16, 10).cast("int")
        return low(F.shiftleft(parity, 8)).bitwiseXOR(F.get(table, F.shiftright(parity, 16).bitwiseXOR(byte)))

    last = F.conv(F.substr(text, F.length(text) - 5), 16, 10).cast("int")
    return F.lpad(F.hex(F.aggregate(spots, F.lit(0), step).bitwiseXOR(last)), 6, "0")


def icao_address(hex_text="hex", df="downlink_format") -> Column:
    """Address in the clear (formats 11, 17, 18), or recovered from the parity of a reply (0, 4, 5, 16, 20, 21)."""
    return (F.when(_col(df).isin(11, 17, 18), F.substring(_col(hex_text), 3, 6))
            .when(_col(df).isin(0, 4, 5, 16, 20, 21), parity_address(hex_text)))


def message_kinds(df="downlink_format") -> Column:
    """List of kinds a downlink format carries; `NONE` for all others."""
    c, out = _col(df), None
    for number, kinds in KINDS.items():
        value = F.array(*[F.lit(k) for k in kinds])
        out = F.when(c == number, value) if out is None else out.when(c == number, value)
    return F.when(c.isNotNull(), out.otherwise(F.array(F.lit("NONE"))))


def _lookup(c: Column, table: dict) -> Column:
    out = None
    for key, value in table.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


def flight_status(head="head", df="downlink_format", tc="tc", hex_text="hex", compat: bool = False) -> Column:
    """Ground or air: by position and velocity type codes, else by the flight-status or capability field.

    The field is the last three bits of the first byte. `compat` reads the top three bits of the fifth byte instead,
    as tables decoded by older tools did.
    """
    field = _bits(_number(F.substring(_col(hex_text), 9, 2)), 8, 1, 3) if compat else _bits(head, 32, 6, 3)
    df, tc = _col(df), _col(tc)
    by_field = (F.when(df.isin(17, 18), _lookup(field, STATUS_BY_CA))
                .when(df.isin(4, 5, 20, 21), _lookup(field, STATUS_BY_FS)))
    return F.when(tc.between(5, 8), ON_GROUND).when(tc.between(9, 22), AIRBORNE).otherwise(by_field)


def wake_category(me="me", tc="tc", hex_text="hex", compat: bool = False) -> Column:
    """Aircraft category of an identification message; type code 1 counts as category 0.

    `compat` takes the category from the top bits of the fifth byte of the hexadecimal text read as base64.
    """
    tc = _col(tc)
    if compat:
        field = _bits(_number(F.substring(frame_text(hex_text), 9, 2)), 8, 1, 3)
    else:
        field = _bits(me, 56, 6, 3)
    field = F.when(tc == 1, 0).otherwise(field)
    return _lookup(tc * 8 + field, {t * 8 + c: name for (t, c), name in CATEGORIES.items()})


def callsign(me="me", tc="tc") -> Column:
    """Eight characters of an identification message (type codes 1 to 4)."""
    chars = [F.substring(F.lit(CHARSET), (_bits(me, 56, 9 + 6 * i, 6) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.when(_col(tc).between(1, 4), F.concat(*chars))


def _from_gray(bits: list[Column]) -> Column:
    """Number of a reflected binary code, highest bit first."""
    seen, out = F.lit(0), F.lit(0)
    for bit in bits:
        seen = seen.bitwiseXOR(bit)
        out = out * 2 + seen
    return out


def gray_altitude_ft(code: Column) -> Column:
    """Feet of a 13-bit altitude code without the 25-foot bit: steps of 500 and, mirrored in every other one, of 100."""
    # order of the 13 bits: C1 A1 C2 A2 C4 A4 M B1 Q B2 D2 B4 D4
    bit = lambda i: _bits(code, 13, i, 1).cast("int")
    fives = _from_gray([bit(i) for i in (11, 13, 2, 4, 6, 8, 10, 12)])
    ones = _from_gray([bit(i) for i in (1, 3, 5)])
    step = F.when(ones == 7, 5).when(~ones.isin(0, 5, 6), ones)
    return fives * 500 + F.when(fives % 2 == 1, 6 - step).otherwise(step) * 100 - 1300


def altitude_ft(head="head", df="downlink_format", me="me", tc="tc") -> Column:
    """Altitude in feet: formats 4 and 20, and position messages, of which 100-foot codes give null."""
    df, tc = _col(df), _col(tc)
    code = _bits(head, 32, 20, 13)
    metric, fine = _bits(code, 13, 7, 1) == 1, _bits(code, 13, 9, 1) == 1
    steps = _bits(code, 13, 1, 6) * 32 + _bits(code, 13, 8, 1) * 16 + _bits(code, 13, 10, 4)
    metres = _bits(code, 13, 1, 6) * 64 + _bits(code, 13, 8, 6)
    reply = F.when(code == 0, None).when(metric, F.floor(metres * 3.28084)).when(
        fine, steps * 25 - 1000).otherwise(gray_altitude_ft(code))
    short = _bits(me, 56, 9, 12)
    baro = F.when((short != 0) & (_bits(short, 12, 8, 1) == 1),
                  (_bits(short, 12, 1, 7) * 16 + _bits(short, 12, 9, 4)) * 25 - 1000)
    height = (F.when(df.isin(4, 20), reply).when(tc.between(5, 8), F.lit(0))
              .when(tc.between(9, 18), baro).when(tc.between(20, 22), short * 3.28084))
    return height.cast("double")


def squawk(head="head", df="downlink_format") -> Column:
    """Four octal digits of formats 5 and 21."""
    code = _bits(head, 32, 20, 13)
    bit = lambda i: _bits(code, 13, i, 1)
    # order of the 13 bits: C1 A1 C2 A2 C4 A4 X B1 D1 B2 D2 B4 D4
    digits = [bit(6) * 4 + bit(4) * 2 + bit(2), bit(12) * 4 + bit(10) * 2 + bit(8),
              bit(5) * 4 + bit(3) * 2 + bit(1), bit(13) * 4 + bit(11) * 2 + bit(9)]
    return F.when(_col(df).isin(5, 21), F.concat(*[d.cast("string") for d in digits]))


def velocity(me="me", tc="tc") -> Column:
    """Struct (speed kt, angle deg, vertical_rate ft/min, speed_type) of surface and velocity messages."""
    tc = _col(tc)
    code = _bits(me, 56, 6, 7)
    ground_speed = None
    for first, last, base, step in MOVEMENT:
        value = F.lit(base) + (code - first) * step
        ground_speed = (F.when(code.between(first, last), value) if ground_speed is None
                        else ground_speed.when(code.between(first, last), value))
    track = F.when(_bits(me, 56, 13, 1) == 1, F.round(_bits(me, 56, 14, 7) * 360 / 128, 1))

    kind = _bits(me, 56, 6, 3)
    east_raw, north_raw = _bits(me, 56, 15, 10), _bits(me, 56, 26, 10)
    scale = F.when(kind.isin(2, 4), 4).otherwise(1)
    east = (east_raw - 1) * scale * F.when(_bits(me, 56, 14, 1) == 1, -1).otherwise(1)
    north = (north_raw - 1) * scale * F.when(_bits(me, 56, 25, 1) == 1, -1).otherwise(1)
    over_ground = F.floor(F.sqrt((east * east + north * north).cast("double")))
    course = F.degrees(F.atan2(east.cast("double"), north.cast("double")))
    course = F.round(F.when(course < 0, course + 360).otherwise(course), 2)
    heading = F.when(_bits(me, 56, 14, 1) == 1, F.round(east_raw * 360 / 1024, 2))
    air_raw = north_raw
    moving = kind.isin(1, 2) & (east_raw != 0) & (north_raw != 0)
    rate_raw = _bits(me, 56, 38, 9)
    rate = F.when(rate_raw != 0, (rate_raw - 1) * 64 * F.when(_bits(me, 56, 37, 1) == 1, -1).otherwise(1))
    air_kind = F.when(_bits(me, 56, 25, 1) == 1, "TAS").otherwise("IAS")

    def row(speed, angle, climb, name):
        return F.struct(speed.cast("double").alias("speed"), angle.cast("double").alias("angle"),
                        climb.cast("double").alias("vertical_rate"), name.alias("speed_type"))

    return (F.when(tc.between(5, 8), row(ground_speed, track, F.lit(0), F.lit("GS")))
            .when((tc == 19) & moving, row(over_ground, course, rate, F.lit("GS")))
            .when((tc == 19) & kind.isin(3, 4) & (air_raw != 0), row((air_raw - 1) * scale, heading, rate, air_kind)))


def longitude_zones(lat) -> Column:
    """Number of longitude zones at a latitude, 1 to 59."""
    c = F.abs(_col(lat))
    cos = F.cos(F.radians(c))
    arc = 1 - F.try_divide(F.lit(1 - math.cos(math.pi / 30)), cos * cos)
    # a null latitude has a null arc; greatest() would skip it
    inner = F.floor(F.try_divide(F.lit(2 * math.pi), F.acos(F.when(arc < -1, -1.0).otherwise(arc))))
    return F.when(c == 0, 59).when(c == 87, 2).when(c > 87, 1).otherwise(inner).cast("int")


def _nearest_cell(reference, size: Column, fraction: Column) -> Column:
    """Coordinate with this fraction of a cell that lies closest to the reference."""
    ref = F.lit(float(reference))
    cell = F.floor(ref / size)
    within = (ref - size * cell) / size
    return size * (cell + F.floor(within - fraction + 0.5) + fraction)


def with_position(rows: DataFrame, reference=airport.RADAR, digits: int = 5, me="me", tc="tc") -> DataFrame:
    """Add lat and lon of surface and airborne position messages, resolved near a reference point.

    The number of longitude zones needs the latitude, so the latitude is a column of its own first.
    """
    tc = _col(tc)
    surface, odd = tc.between(5, 8), _bits(me, 56, 22, 1)
    placed = surface | tc.between(9, 18)
    span = F.when(surface, 90.0).when(placed, 360.0)
    rows = rows.withColumns({"_span": span, "_odd": odd})
    lat_part, lon_part = _bits(me, 56, 23, 17) / F.lit(131072.0), _bits(me, 56, 40, 17) / F.lit(131072.0)
    rows = rows.withColumn("_cell", F.col("_span") / (60 - F.col("_odd")))
    rows = rows.withColumn("_lat", _nearest_cell(reference[0], F.col("_cell"), lat_part))
    rows = rows.withColumn("_zones", longitude_zones("_lat") - F.col("_odd"))
    rows = rows.withColumn("_cell", F.col("_span") / F.when(F.col("_zones") > 0, F.col("_zones")).otherwise(1))
    lon = _nearest_cell(reference[1], F.col("_cell"), lon_part)
    rows = rows.withColumns({"lat": F.round("_lat", digits), "lon": F.round(lon, digits)})
    return rows.drop("_span", "_odd", "_cell", "_lat", "_zones")
