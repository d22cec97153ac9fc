"""Narrow views of the decoded-message table; every one reaches the scan as filter and column list.

`by` names further key columns, such as a scenario name, when one table holds many recordings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.functions.geo import knots_to_kmh
from holdshort.functions.timing import epoch_s
from holdshort.operators.joins import nearest_within
from holdshort.schemas import AIRBORNE, NULL_CALLSIGN, NULL_WORDS, ON_GROUND


def positions(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct position reports: type codes 5 to 22 but 19."""
    kept = F.col("typecode").between(5, 22) & (F.col("typecode") != 19)
    return messages.where(kept).select(*by, "ts", "icao", "flight_status", "lat", "lon").distinct()


def _known_category(messages):
    word = F.col("wake_category")
    return messages.where(
        F.col("downlink_format").isin(17, 18) & word.isNotNull() & ~F.lower(word).isin("none", "nan"))


def airplane_categories(messages: DataFrame) -> DataFrame:
    """Distinct (aircraft, wake category); an aircraft that changes its report has several rows."""
    return _known_category(messages).select("icao", "wake_category").distinct()


def airplane_category(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One wake category per aircraft: the most frequent, then the alphabetically first."""
    votes = _known_category(messages).groupBy(*by, "icao", "wake_category").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("wake_category", F.struct(-F.col("n"), F.col("wake_category")))
    return votes.groupBy(*by, "icao").agg(best.alias("wake_category"))


def flights(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct (ts, aircraft, callsign) with a usable callsign."""
    c = F.col("callsign")
    return messages.where(c.isNotNull() & (c != NULL_CALLSIGN) & ~c.isin(NULL_WORDS)).select(
        *by, "ts", "icao", "callsign").distinct()


def altitudes(messages: DataFrame, need_speed: bool = False) -> DataFrame:
    """Rows with an altitude; optionally only those whose speed is not NaN."""
    kept = F.col("altitude_ft").isNotNull()
    if need_speed:
        kept = kept & ~F.isnan("speed")
    return messages.where(kept).select("ts", "icao", "callsign", "flight_status", "altitude_ft", "lat", "lon")


def velocities(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows with a speed (knots)."""
    return messages.where(F.col("speed").isNotNull() & ~F.isnan("speed")).select(
        *by, "ts", "icao", "flight_status", "speed")


def velocities_located(messages: DataFrame, tolerance_s: int = 1) -> DataFrame:
    """Speeds in km/h with a position.

    Ground rows carry their own position; airborne rows take the nearest position report of the aircraft within
    the tolerance and are dropped without one.
    """
    rows = messages.where(F.col("speed").isNotNull() & ~F.isnan("speed")).select(
        "ts", "icao", "flight_status", "speed", "lat", "lon")
    ground = rows.where(F.col("flight_status") == ON_GROUND)
    air = rows.where(F.col("flight_status") == AIRBORNE).drop("lat", "lon")
    located = nearest_within(air, positions(messages), ["icao"], tolerance_s, ["lat", "lon"])
    return ground.unionByName(located).withColumn("speed", knots_to_kmh("speed"))


def messages_of_aircraft(messages: DataFrame, icao: str) -> DataFrame:
    return messages.where(F.col("icao") == icao)


def latest_n(messages: DataFrame, icao: str, n: int) -> DataFrame:
    """The last n messages of one aircraft."""
    return messages_of_aircraft(messages, icao).orderBy(F.desc("ts")).limit(n)


def max_timestamp(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.max(ts).alias("max_ts"))


def sort_by_time(df: DataFrame, *more: str, ts: str = "ts") -> DataFrame:
    """Total order by time; only for results that are read in order, never ahead of a join."""
    return df.orderBy(ts, *more)


def union_all(*tables: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def with_epoch(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("epoch_s", epoch_s(ts))
