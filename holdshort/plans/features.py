"""Decoded messages to the feature table of waits before take-off."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort import airport
from holdshort.functions import geo, labels, timing
from holdshort.operators import joins, movements, projections
from holdshort.session import freeze


@dataclass(frozen=True)
class Settings:
    """Tolerances and bucket widths in seconds; the defaults fit radar data.

    `scenario` leaves out everything that needs the take-off; `by` keeps recordings in one table apart.
    """

    callsign_tolerance_s: int = 600
    speed_tolerance_s: int = 1
    occupancy_s: int = 10
    rate_s: int = 60
    per_day: bool = True
    scenario: bool = False
    by: tuple[str, ...] = ()


def calendar(rows: DataFrame, minute: str = "minute") -> DataFrame:
    """Hour, weekday and holiday flag."""
    return rows.withColumns({
        "hour": F.hour(minute), "weekday": timing.weekday(minute), "is_holiday": timing.is_holiday(minute)})


def select_flags() -> list[str]:
    """Names of the occupancy flags in table order."""
    return [*airport.HOLDING_POINT_NAMES, *map(airport.runway_column, airport.RUNWAY_NAMES)]


def select_final(rows: DataFrame, scenario: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Final names and order; a scenario has neither target nor first airborne time."""
    names = [*by] if scenario else [*by, "takeoff_time"]
    names += [("ts", "timestamp"), "icao", "callsign", ("designator", "holding_point"), "runway", "operator",
              ("wake_category", "turbulence_category"), "lat", "lon", "last_min_takeoffs", "last_event",
              "last_min_landings", "last_event_turb_cat", "time_since_last_event_seconds", "time_before_holding_point",
              "time_at_holding_point", "hour", "weekday", "is_holiday", ("event_ts", "event_timestamp"), "first_holding_time"]
    names += [] if scenario else ["first_airborne_time"]
    names += ["first_on_ground_time", *select_flags()]
    return rows.select(*[F.col(n) if isinstance(n, str) else F.col(n[0]).alias(n[1]) for n in names])


def located_positions(messages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Positions near the airport with callsign, holding point, wake category and runway by position."""
    by, keys = settings.by, [*settings.by, "icao"]
    near = projections.positions(messages, by).where(geo.within_airport("lat", "lon"))
    named = joins.nearest_within(near, projections.flights(messages, by), keys, settings.callsign_tolerance_s,
                                 ["callsign"], one_per_ts=True)
    placed = joins.assign_holding_point(named)
    typed = joins.join_categories(placed, projections.airplane_category(messages, by), by)
    return movements.with_runway_position(typed)


def waits(messages: DataFrame, located: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Stopped rows at holding points between first holding and take-off, with their times."""
    s = settings
    segment = movements.flight_window(located, s.per_day, s.scenario, s.by)
    # only rows at a holding point can be stops, so only they need a speed
    segment = segment.where("designator IS NOT NULL")
    speeds = projections.velocities(messages, s.by)
    fast = joins.nearest_within(segment, speeds, [*s.by, "icao"], s.speed_tolerance_s, ["speed"])
    return movements.stopped_waits(fast, s.per_day, s.scenario, s.by)


def feature_table(messages: DataFrame, settings: Settings = Settings(), scenario: bool | None = None) -> DataFrame:
    """The whole job. The located positions feed four branches, the stopped rows and the runway events several, so
    these are written once to the shared folder."""
    s = settings if scenario is None else replace(settings, scenario=scenario)
    located = freeze(located_positions(messages, s))
    stops = freeze(waits(messages, located, s))
    events = freeze(movements.runway_events(located, s.per_day, s.by))
    rows = joins.join_occupancy(stops, movements.occupancy(located, s.occupancy_s, s.by), s.occupancy_s, s.by)
    rows = joins.join_minute_rate(rows, movements.events_per_minute(events, s.rate_s, s.by), s.rate_s, s.by)
    rows = rows.na.fill(0.0, subset=["time_before_holding_point"])
    rows = joins.asof_last_event(rows, events, s.per_day, s.by)
    rows = calendar(rows).withColumn("operator", labels.operator_code("callsign"))
    return select_final(rows, s.scenario, s.by)


def mean_wait_by_runway_hour(stops: DataFrame) -> DataFrame:
    """Mean wait from the first stop to take-off, by runway and hour."""
    first = stops.where("ts = first_holding_time")
    return first.groupBy("runway", F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("takeoff_time").alias("mean_wait_s"))
