"""Column names and types of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw message log: base64 frame and epoch milliseconds.
RAW_MESSAGE = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("ts_kafka", T.LongType()),
])

# Stored name and type of every column of the decoded-message table.
DECODED_TYPES = {
    "Timestamp (kafka)": "bigint",
    "Timestamp (date)": "timestamp",
    "Message (base64)": "string",
    "Message (hex)": "string",
    "ICAO": "string",
    "Downlink Format": "int",
    "Flight status": "string",
    "BDS": "string",
    "Roll angle (deg)": "double",
    "True track angle (deg)": "double",
    "Ground speed (kt)": "double",
    "Track angle rate (deg/sec)": "double",
    "True airspeed (kt)": "double",
    "Altitude (ft)": "double",
    "Typecode": "double",
    "TurbulenceCategory": "string",
    "Position with ref (RADAR)": "string",
    "lat": "double",
    "lon": "double",
    "Speed": "double",
    "Angle": "double",
    "Vertical rate": "double",
    "Speed type": "string",
    "Callsign": "string",
    "MCP/FCU selected altitude (ft)": "double",
    "FMS selected altitude (ft)": "double",
    "Barometric pressure (mb)": "double",
    "Speed heading": "string",
    "Magnetic heading (deg)": "double",
    "Indicated airspeed (kt)": "double",
    "Mach number (-)": "double",
    "Barometric altitude rate (ft/min)": "double",
    "Inertial vertical speed (ft/min)": "double",
    "Squawk code": "string",
    "GICB capability": "string",
    "Turbulence level (0-3)": "double",
    "Wind shear level (0-3)": "double",
    "Microburst level (0-3)": "double",
    "Icing level (0-3)": "double",
    "Wake vortex level (0-3)": "double",
    "Static air temperature (C)": "double",
    "Average static pressure (hPa)": "double",
    "Radio height (ft)": "double",
    "Overlay capability": "double",
    "Wind speed (kt) and direction (true) (deg)": "string",
    "Humidity (%)": "double",
}

# Stored name -> name used by the operators.
OPERATOR_NAMES = {
    "Timestamp (date)": "ts",
    "ICAO": "icao",
    "Downlink Format": "downlink_format",
    "Typecode": "typecode",
    "Flight status": "flight_status",
    "TurbulenceCategory": "wake_category",
    "Callsign": "callsign",
    "lat": "lat",
    "lon": "lon",
    "Speed": "speed",
    "Altitude (ft)": "altitude_ft",
}

NULL_CALLSIGN = "########"
NULL_WORDS = ["nan", "None", "null", ""]
ON_GROUND = "on-ground"
AIRBORNE = "airborne"


def operator_names(df):
    """Rename the stored columns the operators read; all others are carried through."""
    return df.withColumnsRenamed({k: v for k, v in OPERATOR_NAMES.items() if k in df.columns})


def stored_names(df):
    """Inverse of `operator_names`."""
    return df.withColumnsRenamed({v: k for k, v in OPERATOR_NAMES.items() if v in df.columns})
