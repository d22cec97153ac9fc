"""Held-out scenarios: many short recordings in one table keyed by `scenario_name`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.functions.geo import runway_label
from holdshort.functions.timing import from_epoch_ms
from holdshort.operators.joins import holding_point_table
from holdshort.operators.spread import spread_join
from holdshort.schemas import AIRBORNE, ON_GROUND

# Foreign wake-vortex labels and the categories they stand for.
WAKE_LABELS = {
    "<7000kg": "Light (less than 7000 kg)",
    "<34,000kg": "Medium 1 (between 7000 kg and 34000 kg)",
    "<136,000kg": "Medium 2 (between 34000 kg to 136000 kg)",
    "Heavy": "Heavy (larger than 136000 kg)",
    "High vortex": "High vortex aircraft",
    "Rotorcraft": "Rotorcraft",
    "Obstruction": "Ground obstruction",
    "Surface emergency vehicle": "Surface emergency vehicle",
}

# Why a scenario has no prediction.
STATUS_CODES = {
    "missing_file": -1, "empty_result": -4, "failure": -5, "no_weather": -6, "no_features": -7,
    "short_sequence": -12, "not_processed": -99,
}


def normalise_scenario(raw: DataFrame) -> DataFrame:
    """Bring a foreign recording to the operator columns; further columns such as `scenario_name` are kept."""
    surveillance = F.col("df").isin(17, 18)
    status = (F.when(surveillance & F.col("tc").between(5, 8), ON_GROUND)
              .when(surveillance & F.col("tc").between(9, 22), AIRBORNE).otherwise("NaN"))
    wake = F.element_at(F.create_map(*[F.lit(x) for kv in WAKE_LABELS.items() for x in kv]), F.col("wake_vortex"))
    used = {"ts", "icao24", "df", "tc", "callsign", "bds20_callsign", "lat_deg", "lon_deg", "altitude",
            "bds05_altitude", "groundspeed", "bds50_groundspeed", "wake_vortex"}
    return raw.select(
        *[c for c in raw.columns if c not in used],
        from_epoch_ms("ts").alias("ts"),
        F.col("icao24").alias("icao"),
        F.col("df").cast("int").alias("downlink_format"),
        F.col("tc").cast("double").alias("typecode"),
        status.alias("flight_status"),
        wake.alias("wake_category"),
        F.coalesce("callsign", "bds20_callsign").alias("callsign"),
        F.col("lat_deg").alias("lat"),
        F.col("lon_deg").alias("lon"),
        F.coalesce("groundspeed", "bds50_groundspeed").cast("double").alias("speed"),
        F.coalesce("altitude", "bds05_altitude").cast("double").alias("altitude_ft"),
    )


def normalise_answers(answers: DataFrame) -> DataFrame:
    """Answer sheet with lower-case aircraft addresses and the runway labels the tables use."""
    return answers.withColumns({"icao": F.lower("icao"), "runway": runway_label("runway")})


def inject_synthetic_rows(messages: DataFrame, answers: DataFrame) -> DataFrame:
    """Append two rows per scenario after the target aircraft's last message: 1 ms later a stop without position,
    2 ms later the asked holding point's position without speed, both on the ground.

    All scenarios are handled in one job; a scenario whose aircraft is never seen gets no rows.
    """
    asked = answers.select("scenario_name", F.lower("icao").alias("_icao"), "holding_point")
    asked = asked.join(F.broadcast(holding_point_table(messages.sparkSession).select(
        "holding_point", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))), "holding_point")
    keyed = messages.withColumn("_icao", F.lower("icao"))
    rest = [c for c in messages.columns if c not in ("scenario_name", "ts")]
    last = spread_join(keyed, asked.select("scenario_name", "_icao").distinct(), ["scenario_name", "_icao"], "left_semi")
    last = last.groupBy("scenario_name", "_icao").agg(F.max(F.struct("ts", *rest)).alias("_last"))
    added = last.join(asked, ["scenario_name", "_icao"]).withColumn("_step", F.explode(F.array(F.lit(1), F.lit(2))))
    stop = F.col("_step") == 1
    values = {
        "scenario_name": F.col("scenario_name"),
        "ts": F.timestamp_micros(F.unix_micros(F.col("_last.ts").cast("timestamp")) + F.col("_step") * 1000),
        "speed": F.when(stop, F.lit(0.0)),
        "lat": F.when(~stop, F.col("_lat")),
        "lon": F.when(~stop, F.col("_lon")),
        "flight_status": F.lit(ON_GROUND),
    }
    added = added.select(*[
        (values[c] if c in values else F.col(f"_last.`{c}`")).alias(c) for c in messages.columns])
    return messages.unionByName(added)


def scenario_status(answers: DataFrame, loaded: DataFrame, featured: DataFrame, weathered: DataFrame,
                    encoded: DataFrame, predicted: DataFrame, history: int) -> DataFrame:
    """Code per scenario: 0 if it has a prediction, else the first step that came out empty.

    Each table is reduced to rows per scenario first; `history` is the number of rows a sequence needs, and
    `predicted` holds (scenario_name, prediction).
    """
    def rows(df, name):
        return df.groupBy("scenario_name").agg(F.count(F.lit(1)).alias(name))

    out = answers.select("scenario_name").distinct()
    for df, name in ((loaded, "_raw"), (featured, "_feat"), (weathered, "_meteo"), (encoded, "_enc")):
        out = out.join(rows(df, name), "scenario_name", "left")
    done = predicted.groupBy("scenario_name").agg(
        F.count(F.lit(1)).alias("_n"), F.count("prediction").alias("_ok"))
    out = out.join(done, "scenario_name", "left")
    code = STATUS_CODES
    status = (F.when(F.col("_raw").isNull(), code["missing_file"])
              .when(F.col("_feat").isNull(), code["empty_result"])
              .when(F.col("_meteo").isNull(), code["no_weather"])
              .when(F.col("_enc").isNull(), code["no_features"])
              .when(F.col("_enc") < history, code["short_sequence"])
              .when(F.col("_n").isNull(), code["not_processed"])
              .when(F.col("_ok") == 0, code["failure"])
              .otherwise(0))
    return out.select("scenario_name", status.alias("status"))


def scenario_answers(answers: DataFrame, predictions: DataFrame) -> DataFrame:
    """Fill the answer sheet: per scenario the prediction of the latest row of the asked aircraft, holding point and
    runway, -1 if there is none. One join for all scenarios."""
    keys = ["scenario_name", "icao", "holding_point", "runway"]
    asked = normalise_answers(answers.drop("time_to_takeoff_s"))
    found = predictions.select("scenario_name", F.lower("icao").alias("icao"), "holding_point",
                               runway_label("runway").alias("runway"), "timestamp", "prediction")
    best = found.groupBy(*keys).agg(F.max_by("prediction", F.struct("timestamp", "prediction")).alias("_p"))
    return asked.join(best, keys, "left").withColumn(
        "time_to_takeoff_s", F.coalesce("_p", F.lit(-1.0))).drop("_p")
