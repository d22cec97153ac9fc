"""Null words, casts, bounds and column clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.functions.labels import strip_parenthesised
from holdshort.operators.spread import spread_join
from holdshort.schemas import DECODED_TYPES, NULL_WORDS

# Columns of the feature table that the basic clean-up removes.
ALWAYS_NULL = ["snow_depth (m)"]
NO_VARIANCE = ["last_event"]
CORRELATED = [
    "apparent_temperature (°C)", "rain (mm)", "pressure_msl (hPa)", "wind_speed_100m (km/h)",
    "wind_gusts_10m (km/h)", "soil_temperature_0_to_7cm (°C)", "soil_temperature_7_to_28cm (°C)",
    "soil_temperature_28_to_100cm (°C)", "soil_moisture_7_to_28cm (m³/m³)",
    "soil_moisture_28_to_100cm (m³/m³)", "vapour_pressure_deficit (kPa)",
]
NOT_NEEDED = [
    "lat", "lon", "event_timestamp", "first_holding_time", "first_airborne_time", "first_on_ground_time", "time",
]


def null_strings(df: DataFrame, words: list[str] | None = None) -> DataFrame:
    """Null words in string columns become null; `words` defaults to nan, None, null and the empty string."""
    words = NULL_WORDS if words is None else words
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(words), F.col(f"`{c}`")) for c in text})


def cast_schema(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast the columns that are present to their stored types; a value that does not fit becomes null."""
    types = DECODED_TYPES if types is None else types
    return df.select(*[
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def clean_basic(features: DataFrame) -> DataFrame:
    """Shorten the wake categories, drop the columns that models do not use, parse the timestamp."""
    short = {c: strip_parenthesised(c) for c in ("turbulence_category", "last_event_turb_cat") if c in features.columns}
    kept = features.withColumns(short).drop(*ALWAYS_NULL, *NO_VARIANCE, *CORRELATED, *NOT_NEEDED)
    return kept.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def out_of_bounds_flights(rows: DataFrame, column: str, low: float, high: float, callsign: str = "callsign",
                          ts: str = "timestamp") -> DataFrame:
    """Distinct (callsign, day) with a value on or outside the bounds."""
    bad = (F.col(column) <= low) | (F.col(column) >= high)
    return rows.where(bad).select(callsign, F.to_date(ts).alias("day")).distinct()


def drop_out_of_bounds_flights(rows: DataFrame, column: str, low: float = 20, high: float = 1250,
                               callsign: str = "callsign", ts: str = "timestamp") -> DataFrame:
    """Remove every row of a (callsign, day) that has a value on or outside the bounds."""
    bad = out_of_bounds_flights(rows, column, low, high, callsign, ts)
    return spread_join(rows.withColumn("day", F.to_date(ts)), bad, [callsign, "day"], "left_anti").drop("day")


def bounds_report(rows: DataFrame, column: str, low: float = 20, high: float = 1250,
                  callsign: str = "callsign", ts: str = "timestamp") -> DataFrame:
    """How many rows and flights `drop_out_of_bounds_flights` removes: one aggregate, no second read."""
    bad = (F.col(column) <= low) | (F.col(column) >= high)
    per_flight = rows.groupBy(callsign, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(bad), F.lit(False)).alias("bad"))
    lost = F.col("bad") & F.col(callsign).isNotNull() & F.col("day").isNotNull()
    return per_flight.agg(
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("removed_rows"),
        F.count_if(lost).alias("removed_flights"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [f"`{c}`" for c in df.columns], "column_name", "nulls")


def impute_constants(df: DataFrame, numeric: list[str], categorical: list[str], missing: str = "__MISSING__") -> DataFrame:
    """Missing numbers become 0, missing categories a marker."""
    return df.na.fill(0, subset=numeric).na.fill(missing, subset=categorical)
