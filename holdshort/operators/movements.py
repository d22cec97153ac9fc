"""Flight phases, runway events, occupancy and waits.

Flights are identified by callsign. `per_day` (default) starts every day anew, so that a whole table gives the same
result as one run per day file; `per_day=False` uses the bare key. `by` names further key columns, such as a scenario
name, when one table holds many recordings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdshort import airport
from holdshort.functions import geo
from holdshort.functions.timing import ceil_s, epoch_s
from holdshort.operators.spread import (
    next_in_time, number_rows, one_per_instant, previous_in_time, spread_join, with_halo,
)
from holdshort.schemas import AIRBORNE, ON_GROUND

STOPPED = "speed = 0 AND designator IS NOT NULL"


def _dated(rows: DataFrame, per_day: bool) -> DataFrame:
    day = F.to_date("ts") if per_day else F.to_date(F.lit("1970-01-01"))
    return rows.withColumn("_day", day)


def _first_when(condition, ts="ts"):
    return F.min(F.when(condition, F.col(ts)))


def semi_valid_flights(rows: DataFrame, per_day: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Rows of flights that are seen at a holding point at least once."""
    dated = _dated(rows, per_day)
    keys = [*by, "callsign", "_day"]
    valid = dated.where("designator IS NOT NULL").select(*keys).distinct()
    return spread_join(dated, valid, keys, "left_semi").drop("_day")


def first_times(rows: DataFrame, per_day: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Add first_on_ground_time and first_holding_time per flight; keep rows from the first holding time on.

    Flights never seen at a holding point vanish, so a preceding `semi_valid_flights` is not needed.
    """
    dated = _dated(rows, per_day)
    keys = [*by, "callsign", "_day"]
    firsts = dated.groupBy(*keys).agg(
        _first_when(F.col("flight_status") == ON_GROUND).alias("first_on_ground_time"),
        _first_when(F.col("designator").isNotNull()).alias("first_holding_time"),
    ).where("first_holding_time IS NOT NULL")
    return spread_join(dated, firsts, keys).where("ts >= first_holding_time").drop("_day")


def takeoff_segment(rows: DataFrame, per_day: bool = True, scenario: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """After `first_times`: add first_airborne_time, taken over the remaining rows, and keep rows up to it.

    Flights that never get airborne vanish. A scenario has no take-off yet: rows are returned as they are.
    """
    if scenario:
        return rows
    dated = _dated(rows, per_day)
    keys = [*by, "callsign", "_day"]
    firsts = dated.where(F.col("flight_status") == AIRBORNE).groupBy(*keys).agg(F.min("ts").alias("first_airborne_time"))
    return spread_join(dated, firsts, keys).where("ts <= first_airborne_time").drop("_day")


def flight_window(rows: DataFrame, per_day: bool = True, scenario: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """`takeoff_segment(first_times(rows))` with one join of the wide rows instead of two.

    The per-flight times are worked out on three narrow columns first.
    """
    keys = [*by, "callsign", "_day"]
    dated = _dated(rows, per_day)
    times = dated.groupBy(*keys).agg(
        _first_when(F.col("flight_status") == ON_GROUND).alias("first_on_ground_time"),
        _first_when(F.col("designator").isNotNull()).alias("first_holding_time"),
    ).where("first_holding_time IS NOT NULL")
    inside = "ts >= first_holding_time"
    if not scenario:
        air = dated.where(F.col("flight_status") == AIRBORNE).select(*keys, "ts")
        off = spread_join(air, times, keys).where(inside).groupBy(*keys).agg(F.min("ts").alias("first_airborne_time"))
        times = times.join(off, keys)
        inside += " AND ts <= first_airborne_time"
    return spread_join(dated, times, keys).where(inside).drop("_day")


def semi_stopped(rows: DataFrame, per_day: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Rows of aircraft that stop at a holding point, from the flight's first such stop on.

    first_holding_time becomes the time of that stop.
    """
    dated = _dated(rows.drop("first_holding_time"), per_day)
    stops = dated.where(STOPPED)
    keys, aircraft_keys = [*by, "callsign", "_day"], [*by, "icao", "_day"]
    aircraft = stops.select(*aircraft_keys).distinct()
    first_stop = stops.groupBy(*keys).agg(F.min("ts").alias("first_holding_time"))
    kept = spread_join(dated, aircraft, aircraft_keys, "left_semi")
    return spread_join(kept, first_stop, keys).where("ts >= first_holding_time").drop("_day")


def holding_times(rows: DataFrame, scenario: bool = False) -> DataFrame:
    """Stopped rows with the wait until take-off, the time before and the time at the holding point (whole seconds)."""
    out = rows.where(STOPPED)
    gap = lambda a, b: (epoch_s(a) - epoch_s(b)).cast("double")
    new = {
        "time_before_holding_point": gap("first_holding_time", "first_on_ground_time"),
        "time_at_holding_point": gap("ts", "first_holding_time"),
    }
    if not scenario:
        new["takeoff_time"] = gap("first_airborne_time", "ts")
    return out.withColumns(new)


def stopped_waits(segment: DataFrame, per_day: bool = True, scenario: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """`holding_times(semi_stopped(segment))`: only stopped rows survive, so only they are joined."""
    stops = _dated(segment.drop("first_holding_time"), per_day).where(STOPPED)
    keys = [*by, "callsign", "_day"]
    first_stop = stops.groupBy(*keys).agg(F.min("ts").alias("first_holding_time"))
    return holding_times(spread_join(stops, first_stop, keys).drop("_day"), scenario)


def with_runway_position(rows: DataFrame) -> DataFrame:
    return rows.withColumn("runway_from_position", geo.runway_at("lat", "lon"))


def runway_events(rows: DataFrame, per_day: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Take-offs and landings: status changes between consecutive messages of an aircraft that happen on a runway.

    The runway is that of the holding point, else of the position. Of several rows of an aircraft at one instant the
    one with the smallest columns counts.
    """
    narrow = _dated(rows, per_day).select(
        *by, "icao", "_day", "ts", "flight_status", "wake_category",
        F.coalesce("runway", "runway_from_position").alias("runway"))
    keys = [*by, "icao", "_day"]
    seen = previous_in_time(one_per_instant(narrow, keys), keys, ["flight_status"], ["prev_status"])
    now, before = F.col("flight_status"), F.col("prev_status")
    event = (F.when((now == AIRBORNE) & (before == ON_GROUND), "takeoff")
             .when((now == ON_GROUND) & (before == AIRBORNE), "landing"))
    return seen.select(*by, "runway", "ts", "wake_category", event.alias("event")).where(
        "event IS NOT NULL AND runway IS NOT NULL")


def occupancy(rows: DataFrame, width_s: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """One row per interval, labelled by its end, with a flag per holding point and per runway."""
    def seen(column, name):
        return F.coalesce(F.max(F.col(column) == name), F.lit(False))

    flags = [seen("designator", n).alias(n) for n in airport.HOLDING_POINT_NAMES]
    flags += [seen("runway_from_position", n).alias(airport.runway_column(n)) for n in airport.RUNWAY_NAMES]
    return rows.groupBy(*by, ceil_s("ts", width_s).alias("bucket")).agg(*flags)


def events_per_minute(events: DataFrame, width_s: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Take-offs and landings per minute, labelled by the minute's end."""
    return events.groupBy(*by, ceil_s("ts", width_s).alias("minute")).agg(
        F.count_if(F.col("event") == "takeoff").alias("last_min_takeoffs"),
        F.count_if(F.col("event") == "landing").alias("last_min_landings"),
    )


def wait_times(states: DataFrame) -> DataFrame:
    """Per (callsign, aircraft): first stop on the ground to first airborne message, and the numbered runway nearest to
    the position at that message."""
    first_air = F.struct("ts", "lat", "lon")
    per_flight = states.groupBy("callsign", "icao").agg(
        _first_when((F.col("flight_status") == ON_GROUND) & (F.col("speed") == 0)).alias("ts_ground"),
        F.min(F.when(F.col("flight_status") == AIRBORNE, first_air)).alias("_air"),
    )
    return per_flight.select(
        "callsign", "icao", "ts_ground", F.col("_air.ts").alias("ts_airborne"),
        F.col("_air.lat").alias("lat"), F.col("_air.lon").alias("lon"),
    ).where("ts_airborne > ts_ground").withColumns({
        "runway": geo.nearest_numbered_runway("lat", "lon"),
        "wait_s": (epoch_s("ts_airborne") - epoch_s("ts_ground")).cast("double"),
        "day_of_week": F.date_format("ts_airborne", "E"),
    })


def wait_times_by_callsign(states: DataFrame) -> DataFrame:
    """The same by callsign alone; the weekday is that of the stop."""
    per_flight = states.groupBy("callsign").agg(
        _first_when((F.col("flight_status") == ON_GROUND) & (F.col("speed") == 0)).alias("ts_ground"),
        _first_when(F.col("flight_status") == AIRBORNE).alias("ts_airborne"),
    )
    return per_flight.where("ts_airborne > ts_ground").withColumns({
        "wait_s": epoch_s("ts_airborne") - epoch_s("ts_ground"),
        "day_of_week": F.date_format("ts_ground", "E"),
    })


def prev_category_on_runway(waits: DataFrame, categories: DataFrame, below_s: float,
                            runways: Sequence[str] = ("3", "4")) -> DataFrame:
    """Waits under a limit at some runways with the wake category of the aircraft that left before on that runway."""
    rows = spread_join(waits.where(F.col("runway").isin(*runways) & (F.col("wait_s") < below_s)), categories, ["icao"])
    numbered = number_rows(rows, ["ts_airborne", "icao", "callsign"], keys=["runway"], name="_seq")
    blocks = with_halo(numbered, 1, "_seq")
    w = Window.partitionBy("runway", "block").orderBy("_seq")
    return blocks.withColumn("prev_category", F.lag("wake_category").over(w)).where(
        "own AND prev_category IS NOT NULL").drop("_seq", "block", "own")


def latest_per_key(rows: DataFrame, keys: Sequence[str] = ("callsign",), ts: str = "ts") -> DataFrame:
    """The row with the latest time per key; equal times are decided by the remaining columns."""
    rest = [c for c in rows.columns if c not in keys and c != ts]
    best = rows.groupBy(*keys).agg(F.max(F.struct(ts, *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in rows.columns])


def sequence_number(rows: DataFrame, keys: Sequence[str] = ("icao",), order: Sequence[str] = ("ts",)) -> DataFrame:
    """Number the rows of each key by time; rows at one time are ordered by their other columns."""
    return number_rows(rows, _total(rows, order, keys), keys, "row_num")


def _total(rows, order, keys):
    """The order, then all other columns: rows that still tie are alike."""
    return [*order, *[c for c in rows.columns if c not in (*order, *keys)]]


def _at(keys, table, columns):
    return one_per_instant(table.select(*keys, "ts", *columns), keys)


def step_distance(rows: DataFrame, keys: Sequence[str] = ("icao", "callsign")) -> DataFrame:
    """Distance in km and time in s from the previous located row of the same track."""
    track = _at(keys, rows.where("lat IS NOT NULL"), ["lat", "lon"])
    out = previous_in_time(track, keys, ["ts", "lat", "lon"], ["prev_ts", "prev_lat", "prev_lon"])
    return out.withColumns({
        "distance_km": geo.haversine_km("lat", "lon", "prev_lat", "prev_lon"),
        "time_diff_s": epoch_s("ts") - epoch_s("prev_ts"),
    })


def remove_outlier_flights(rows: DataFrame, max_km: float = 200.0, within_s: int = 600) -> DataFrame:
    """Drop every row of aircraft that jump further than the limit in less than the time."""
    located = rows.where("lat IS NOT NULL")
    jumps = step_distance(located).where((F.col("distance_km") > max_km) & (F.col("time_diff_s") < within_s))
    return spread_join(located, jumps.select("icao").distinct(), ["icao"], "left_anti")


def state_durations(messages: DataFrame) -> DataFrame:
    """Seconds each aircraft spends on the ground and in the air.

    A status holds until the aircraft's next message, the last one until the last message of the whole table.
    """
    track = _at(["icao"], messages, ["flight_status"])
    ends = next_in_time(track, ["icao"], ["ts"], ["next_ts"])
    last = messages.agg(F.max("ts")).scalar()
    span = (F.unix_micros(F.coalesce("next_ts", last).cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")))
    def total(status):
        micros = F.sum(F.when(F.col("flight_status") == status, span))
        return F.coalesce(micros / 1_000_000, F.lit(0.0))

    return ends.groupBy("icao").agg(total(ON_GROUND).alias("ground_s"), total(AIRBORNE).alias("airborne_s"))


def thin_trajectory(rows: DataFrame, near_km: float = 10.0, slow: float = 300.0, near_step: int = 10,
                    far_step: int = 50, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Per callsign keep every 10th row near the radar at low speed, else every 50th; rows at one time are ordered by
    their other columns. All rows count; one without a speed or place is not near and slow."""
    numbered = number_rows(rows, _total(rows, order, ["callsign"]), ["callsign"], "_i")
    slow_near = (geo.radar_distance_km("lat", "lon") < near_km) & (F.col("speed") <= slow)
    step = F.when(slow_near, near_step).otherwise(far_step)
    return numbered.where((F.col("_i") - 1) % step == 0).drop("_i")


def trajectory_class(rows: DataFrame, near_km: float = 10.0) -> DataFrame:
    """Classify each (aircraft, callsign) track by its ends: starts near the radar, else ends near it, else neither."""
    point = F.struct("ts", "lat", "lon")
    ends = rows.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy("icao", "callsign").agg(
        F.min(point).alias("a"), F.max(point).alias("b"))
    start_km = geo.radar_distance_km(F.col("a.lat"), F.col("a.lon"))
    end_km = geo.radar_distance_km(F.col("b.lat"), F.col("b.lon"))
    kind = F.when(start_km < near_km, "Take-off").when(end_km < near_km, "Landing").otherwise("In flight")
    return ends.select("icao", "callsign", start_km.alias("start_km"), end_km.alias("end_km"), kind.alias("kind"))


def trajectory_mean_altitude(rows: DataFrame, keys: Sequence[str] = ("icao", "callsign")) -> DataFrame:
    """Segments between consecutive points with their mean altitude, next to the mean of the whole track."""
    track = _at(keys, rows.where("altitude_ft IS NOT NULL"), ["altitude_ft"])
    steps = next_in_time(track, keys, ["ts", "altitude_ft"], ["next_ts", "next_altitude_ft"])
    means = track.groupBy(*keys).agg(F.avg("altitude_ft").alias("mean_altitude_ft"))
    segments = steps.where("next_ts IS NOT NULL").withColumn(
        "segment_altitude_ft", (F.col("altitude_ft") + F.col("next_altitude_ft")) / 2)
    return spread_join(segments, means, list(keys))


def sequences(rows: DataFrame, n: int, values: Sequence[str], keys: Sequence[str], order: Sequence[str],
              include_self: bool = False) -> DataFrame:
    """Sliding sequences: the n rows before each row (or the n rows ending with it) as one array `steps`.

    Rows without a full history are left out.
    """
    numbered = number_rows(rows, list(order), list(keys), "seq")
    blocks = with_halo(numbered, n, "seq")
    frame = (-(n - 1), 0) if include_self else (-n, -1)
    w = Window.partitionBy(*keys, "block").orderBy("seq").rowsBetween(*frame)
    item = F.struct(*values) if len(values) > 1 else F.col(values[0])
    out = blocks.withColumn("steps", F.collect_list(item).over(w))
    first = n if include_self else n + 1
    return out.where(F.col("own") & (F.col("seq") >= first)).drop("block", "own")


def position_time_slices(rows: DataFrame, minutes: int) -> DataFrame:
    """Points of every time slice: slice centres run from the first to the last time in steps of `minutes`; a point
    within half a step of a centre, ends included, belongs to it, so edge points come out twice."""
    step = minutes * 60_000_000
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ts_micros = lambda agg: rows.agg(F.unix_micros(agg("ts").cast("timestamp"))).scalar()
    start, stop = ts_micros(F.min), ts_micros(F.max)
    offset = micros - start
    low = F.greatest(F.lit(0), F.ceil((2 * offset - step) / (2 * step)))
    high = F.least(F.floor((stop - start) / step), F.floor((2 * offset + step) / (2 * step)))
    placed = rows.withColumns({"_low": low.cast("long"), "_high": high.cast("long"), "_start": start}).where("_low <= _high")
    sliced = placed.withColumn("_k", F.explode(F.sequence("_low", "_high")))
    at = F.timestamp_micros(F.col("_start") + F.col("_k") * step)
    return sliced.withColumn("slice_ts", at).drop("_low", "_high", "_start", "_k")
