"""The test tables in the shape the operators read.

`events` stands in for decoded messages: users are aircraft, event types give the status, ids give the place. All of it
is plain CASE and integer arithmetic over the whole table, so `sql.py` can state the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdshort import airport

WAKE = ["Light (less than 7000 kg)", "Medium 1 (between 7000 kg and 34000 kg)",
        "Medium 2 (between 34000 kg to 136000 kg)", "Heavy (larger than 136000 kg)"]
PREFIXES = ["IBE", "RYR", "VLG", "AEA", "EZY", "BAW", "DLH", "AFR", "KLM"]
RUNWAY_SPOTS = [((ring[0][1] + ring[2][1]) / 2, (ring[0][0] + ring[2][0]) / 2) for ring in airport.RUNWAY_RINGS.values()]
FAR = (41.0, -3.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in stamps})


def pick(values, index: Column) -> Column:
    """Value at a 0-based index of a constant list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages from `events`."""
    e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    ground, air, odd = kind.isin("view", "click"), kind.isin("purchase", "signup"), kind == "error"
    at_point = ground & (e % 24 < len(airport.HOLDING_POINTS))
    nudge = (e % 3) * 5e-5

    def place(points, spots, far, centre):
        return (F.when(at_point, pick(points, F.least(e % 24, F.lit(20))) + nudge).when(e % 7 == 0, F.lit(far))
                .when(e % 2 == 0, pick(spots, e % 4)).otherwise(F.lit(centre)))

    return table(spark, sf_dir, "events").select(
        "ts",
        u.cast("string").alias("icao"),
        F.when(odd, 20).when(e % 5 == 0, 18).otherwise(17).alias("downlink_format"),
        F.when(ground, 5 + e % 4).when(air, 9 + e % 10).otherwise(19).cast("double").alias("typecode"),
        F.when(ground, "on-ground").when(air, "airborne").alias("flight_status"),
        F.when(odd, None).when(e % 11 == 0, "None").otherwise(
            pick(WAKE, (u + F.when(e % 13 == 0, 1).otherwise(0)) % 4)).alias("wake_category"),
        F.when(kind == "signup", F.when(e % 17 == 0, "########").otherwise(
            F.concat(pick(PREFIXES, u % 9), u.cast("string")))).alias("callsign"),
        place([p[3] for p in airport.HOLDING_POINTS], [s[0] for s in RUNWAY_SPOTS], FAR[0], airport.CENTRE[0]).alias("lat"),
        place([p[2] for p in airport.HOLDING_POINTS], [s[1] for s in RUNWAY_SPOTS], FAR[1], airport.CENTRE[1]).alias("lon"),
        F.when(kind == "view", 0.0).when(kind.isin("click", "purchase"), F.col("value")).alias("speed"),
        F.when(air, F.col("value") * 100).alias("altitude_ft"),
    )


def wait_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wait records with a prediction from `lineitem`: the return flag is the runway, the line number the holding point."""
    q, k = F.col("l_quantity"), F.col("l_orderkey")
    minute = F.make_interval(mins=(k % 1440).cast("int"), secs=(F.col("l_partkey") % 60).cast("decimal(8,6)"))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_shipdate") + minute).alias("timestamp"),
        F.concat(pick(PREFIXES, F.col("l_suppkey") % 9), (k % 50).cast("string")).alias("callsign"),
        F.col("l_suppkey").cast("string").alias("icao"),
        F.col("l_returnflag").alias("runway"),
        F.concat(F.lit("P"), F.col("l_linenumber").cast("string")).alias("holding_point"),
        pick(WAKE, F.col("l_partkey") % 4).alias("turbulence_category"),
        pick([*WAKE, "N/C"], F.col("l_suppkey") % 5).alias("last_event_turb_cat"),
        (q * 5).alias("takeoff_time"),
        (q * 4 + F.col("l_discount") * 300).alias("prediction"),
        (k % 4).alias("last_min_takeoffs"),
        (F.col("l_partkey") % 4).alias("last_min_landings"),
        (F.col("l_partkey") % 120).alias("time_since_last_event_seconds"),
        (k % 7 == 0).alias("is_holiday"),
    ).withColumns({"hour": F.hour("timestamp"), "weekday": F.date_format("timestamp", "E")})


def meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather: one row per hour in which something happened, values from the hour's events."""
    hourly = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("time"))
    return hourly.agg(F.count(F.lit(1)).cast("double").alias("cloud_cover (%)"),
                      F.min("value").alias("temperature_2m (°C)"))
