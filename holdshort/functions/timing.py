"""Time buckets and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdshort import airport

# Weekday numbers, Monday first.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_s(ts="ts") -> Column:
    """Whole seconds, fraction cut off; works for timestamps with and without zone (session zone UTC)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def slot(ts, width_s: int) -> Column:
    """Number of the time slot of the given width."""
    return F.floor(epoch_s(ts) / F.lit(width_s)).cast("long")


def floor_s(ts, width_s: int) -> Column:
    return F.timestamp_seconds(F.floor(epoch_s(ts) / F.lit(width_s)) * width_s)


def ceil_s(ts, width_s: int) -> Column:
    """End of the interval (start, end] that holds the whole second of ts."""
    return F.timestamp_seconds(F.ceil(epoch_s(ts) / F.lit(width_s)) * width_s)


def from_epoch_ms(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def weekday(ts="ts") -> Column:
    return F.date_format(_col(ts), "E")


def hour_label(ts="ts") -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:00:00")


def is_holiday(day) -> Column:
    """The calendar has a fixed 24 entries, so a set test beats a join."""
    return F.to_date(_col(day)).isin([F.to_date(F.lit(d)) for d in airport.HOLIDAYS])


def weekday_number(name="weekday") -> Column:
    """Monday 0 … Sunday 6, case-insensitive; null for anything else."""
    at = F.array_position(F.array(*[F.lit(d.lower()) for d in WEEKDAYS]), F.lower(_col(name)))
    return F.when(at > 0, (at - 1).cast("int"))


def cyclic(value, period: float) -> tuple[Column, Column]:
    """(sin, cos) of a value on a circle."""
    angle = _col(value) * (2 * 3.141592653589793) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def with_cyclic_time(df):
    """hour_sin/cos and weekday_sin/cos next to a numeric weekday."""
    df = df.withColumn("weekday_num", weekday_number("weekday"))
    hour_sin, hour_cos = cyclic("hour", 24)
    day_sin, day_cos = cyclic("weekday_num", 7)
    return df.withColumns({
        "hour_sin": hour_sin, "hour_cos": hour_cos, "weekday_sin": day_sin, "weekday_cos": day_cos,
    })
