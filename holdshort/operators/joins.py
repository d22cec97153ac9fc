"""Joins by time tolerance, last event, interval, minute and hour, and joins with the fixed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdshort import airport
from holdshort.functions import geo
from holdshort.functions.timing import epoch_s, floor_s, slot
from holdshort.operators.spread import last_event_before, one_per_instant, spread_join


def nearest_within(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance_s: int,
                   payload: Sequence[str], one_per_ts: bool = False) -> DataFrame:
    """Give each left row the payload of the nearest right row of the same keys within the tolerance.

    The tolerance is in whole seconds; nearness is exact, ties go to the earlier right row, then to the smallest payload.
    Left rows without a match are dropped. With `one_per_ts` the left side is first reduced to one row per (keys, ts).

    The answer depends only on (keys, ts). Both sides are reduced to that with a partial aggregate, the right side is
    copied to the slots next to its own, and the neighbours are found by an ordered window per (keys, slot). Such a group
    holds at most the distinct times of four slots as wide as the tolerance, whatever the number of rows behind them.
    """
    if one_per_ts:
        left = one_per_instant(left, keys)
    width = max(int(tolerance_s), 1)
    marks = right.groupBy(*keys, "ts").agg(F.min(F.struct(*payload)).alias("_row"))
    marks = marks.withColumn("_m", F.struct(F.col("ts").alias("ts"), F.col("_row").alias("row"))).drop("_row")
    s = slot("ts", width)
    near = marks.withColumn("_slot", F.explode(F.array(s - 1, s, s + 1))).withColumn("_own", F.lit(False))
    no_mark = F.lit(None).cast(marks.schema["_m"].dataType)
    times = left.select(*keys, "ts").distinct().select(*keys, "ts", no_mark.alias("_m"), s.alias("_slot"), F.lit(True).alias("_own"))
    group = Window.partitionBy(*keys, "_slot")
    # at one instant the mark sorts before the time, both ways
    up = group.orderBy("ts", "_own").rowsBetween(Window.unboundedPreceding, 0)
    down = group.orderBy(F.desc("ts"), "_own").rowsBetween(Window.unboundedPreceding, 0)
    merged = times.unionByName(near).select(
        *keys, "ts", "_own",
        F.last("_m", ignorenulls=True).over(up).alias("_back"),
        F.last("_m", ignorenulls=True).over(down).alias("_ahead"),
    ).where("_own")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = lambda m: F.abs(at - F.unix_micros(F.col(f"{m}.ts").cast("timestamp")))
    fits = lambda m: F.coalesce(F.abs(epoch_s("ts") - epoch_s(F.col(f"{m}.ts"))) <= tolerance_s, F.lit(False))
    earlier = fits("_back") & (~fits("_ahead") | (gap("_back") <= gap("_ahead")))
    answer = merged.where(fits("_back") | fits("_ahead")).withColumn(
        "_best", F.when(earlier, F.col("_back")).otherwise(F.col("_ahead")))
    answer = answer.select(*keys, "ts", *[F.col(f"_best.row.{c}").alias(c) for c in payload])
    return left.join(answer, [*keys, "ts"])


def labels_within(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance_s: int, label: str) -> DataFrame:
    """Pair each left row with every distinct right label of the same keys that occurs within the tolerance.

    The right side is reduced to the first and last second of each (keys, label, slot): with slots as wide as the
    tolerance a label of the own slot always matches, one of the slot before by its last and one of the slot after by
    its first second. So a pair comes out once, and no message pairs are formed.
    """
    width = max(int(tolerance_s), 1)
    sec = epoch_s("ts")
    seen = right.where(F.col(label).isNotNull()).groupBy(*keys, label, slot("ts", width).alias("_at")).agg(
        F.min(sec).alias("_first"), F.max(sec).alias("_last"))
    side = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    reach = (
        seen.select("*", side.alias("_side"))
        .groupBy(*keys, label, (F.col("_at") - F.col("_side")).alias("_slot"))
        .agg(
            F.max(F.when(F.col("_side") == -1, F.col("_last"))).alias("_prev_last"),
            F.max(F.when(F.col("_side") == 0, F.col("_last"))).alias("_own_last"),
            F.min(F.when(F.col("_side") == 1, F.col("_first"))).alias("_next_first"),
        )
    )
    rows = left.withColumn("_slot", slot("ts", width))
    joined = rows.join(reach, [*keys, "_slot"])
    # a zero tolerance has one-second slots: only the own slot counts
    own = F.col("_own_last").isNotNull()
    before = sec - F.col("_prev_last") <= tolerance_s
    after = F.col("_next_first") - sec <= tolerance_s
    return joined.where(F.coalesce(own, F.lit(False)) | F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))).select(
        *left.columns, label)


def flight_state(velocity_rows: DataFrame, flight_rows: DataFrame, tolerance_s: int = 600) -> DataFrame:
    """Speed rows with the callsigns heard within the tolerance, plus hour label and weekday."""
    out = labels_within(velocity_rows, flight_rows, ["icao"], tolerance_s, "callsign")
    return out.withColumns({
        "hour": F.hour("ts"),
        "day_of_week": F.date_format("ts", "E"),
    })


def flights_info(position_rows: DataFrame, flight_rows: DataFrame, speed_rows: DataFrame, category_rows: DataFrame,
                 altitude_rows: DataFrame, tolerance_s: int = 600, speed_tolerance_s: int = 60) -> DataFrame:
    """Airborne positions with callsign, speed, wake category and altitude (the last two may be missing)."""
    air = position_rows.where(F.col("flight_status") == "airborne")
    named = nearest_within(air, flight_rows, ["icao"], tolerance_s, ["callsign"], one_per_ts=True)
    fast = nearest_within(named, speed_rows, ["icao"], speed_tolerance_s, ["speed"])
    typed = spread_join(fast, category_rows, ["icao"], "left")
    heights = altitude_rows.groupBy("icao", "callsign", "ts").agg(F.max("altitude_ft").alias("altitude_ft"))
    return typed.join(heights, ["icao", "callsign", "ts"], "left")


def join_categories(rows: DataFrame, category_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Inner join by aircraft; aircraft without a category are dropped."""
    return spread_join(rows, category_rows, [*by, "icao"])


def assign_holding_point(rows: DataFrame, limit_m: float = 20.0) -> DataFrame:
    """Add designator and runway of the first listed holding point within the limit."""
    return rows.withColumn("_hp", geo.holding_point("lat", "lon", limit_m)).withColumns({
        "designator": F.col("_hp.designator"), "runway": F.col("_hp.runway")}).drop("_hp")


def asof_last_event(rows: DataFrame, events: DataFrame, per_day: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Add the last runway event strictly before each row.

    A runway with no event at all gets a stand-in 65 s earlier with category `N/C`; rows of a runway that only has
    later events are dropped. `per_day` treats each day on its own.
    """
    keys = [*by, "runway", "_day"]
    day = F.to_date("ts") if per_day else F.lit(None).cast("date")
    day = F.coalesce(day, F.to_date(F.lit("1970-01-01")))
    left = rows.withColumn("_day", day)
    # of events at one instant the one with the smallest category and kind stands
    ev = one_per_instant(
        events.withColumn("_day", day).select(*keys, "ts", "wake_category", "event"), keys)
    points = last_event_before(left, ev, keys, ["wake_category", "event"]).withColumnRenamed("event", "_e")
    busy = ev.select(*keys).distinct().withColumn("_busy", F.lit(True))
    points = spread_join(points, busy, keys, "left").where(F.col("_e").isNotNull() | F.col("_busy").isNull())
    points = points.select(
        *keys, "ts",
        F.coalesce(F.col("_e.ts"), F.col("ts") - F.expr("INTERVAL 65 SECONDS")).alias("event_ts"),
        F.coalesce(F.col("_e.wake_category"), F.lit("N/C")).alias("last_event_turb_cat"),
        F.col("_e.event").alias("last_event"),
    )
    out = left.join(points, [*keys, "ts"]).drop("_day")
    return out.withColumn("time_since_last_event_seconds", epoch_s("ts") - epoch_s("event_ts"))


def join_occupancy(rows: DataFrame, occupancy: DataFrame, width_s: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Inner join with the occupancy of the last complete interval: floor of the row, end of the interval."""
    keyed = rows.withColumn("bucket", floor_s("ts", width_s))
    return spread_join(keyed, occupancy, [*by, "bucket"]).drop("bucket")


def join_minute_rate(rows: DataFrame, rate: DataFrame, width_s: int = 60, by: Sequence[str] = (),
                     how: str = "left") -> DataFrame:
    """Join with the counts of the last complete minute; missing counts are 0, `how="inner"` drops such rows."""
    keyed = rows.withColumn("minute", floor_s("ts", width_s))
    counts = ["last_min_takeoffs", "last_min_landings"]
    return spread_join(keyed, rate, [*by, "minute"], how).na.fill(0, subset=counts)


def join_meteo_hourly(rows: DataFrame, meteo: DataFrame, ts: str = "ts", time: str = "time", prefix: str = "") -> DataFrame:
    """Inner join by hour. Columns both tables have are taken from the weather table, or kept apart by a prefix."""
    values = [c for c in meteo.columns if c != time]
    right = meteo.select(F.date_trunc("hour", F.col(time)).alias("_hour"),
                         *[F.col(f"`{c}`").alias(prefix + c) for c in values])
    left = rows if prefix else rows.drop(*[c for c in values if c in rows.columns])
    left = left.withColumn("_hour", F.date_trunc("hour", F.col(ts).cast("timestamp")))
    return spread_join(left, right, ["_hour"]).drop("_hour")


def join_meteo_prefixed(rows: DataFrame, meteo: DataFrame, ts: str = "ts", time: str = "time") -> DataFrame:
    return join_meteo_hourly(rows, meteo, ts, time, prefix="meteo_")


def holding_point_table(spark) -> DataFrame:
    return spark.createDataFrame(airport.HOLDING_POINTS, "holding_point string, runway string, lon double, lat double")


def runway_position_table(spark) -> DataFrame:
    return spark.createDataFrame(airport.RUNWAY_LABEL_POSITIONS, "runway string, lon double, lat double")


def geo_error_join(group_errors: DataFrame, by: str) -> DataFrame:
    """Put per-group errors on the map: `by` is `runway` or `holding_point`. The coordinate tables are constants."""
    spark = group_errors.sparkSession
    places = runway_position_table(spark) if by == "runway" else holding_point_table(spark).drop("runway")
    return group_errors.join(F.broadcast(places), by)


def nearest_reference(points: DataFrame, references: list[tuple[str, float, float]]) -> DataFrame:
    """Label each point with the closest of a fixed list of (name, lat, lon), by squared degrees."""
    options = F.array(*[
        F.struct(
            ((F.col("lat") - la) * (F.col("lat") - la) + (F.col("lon") - lo) * (F.col("lon") - lo)).alias("d"),
            F.lit(name).alias("name"))
        for name, la, lo in references
    ])
    return points.withColumn("nearest", F.array_min(options)["name"])
