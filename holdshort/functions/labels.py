"""Text clean-up, class labels and the rule-based wait estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_parenthesised(text, greedy: bool = True) -> Column:
    """Drop `(...)`: from the first to the last bracket, or each pair with the space before it."""
    pattern = r"\(.*\)" if greedy else r"\s*\(.*?\)"
    return F.trim(F.regexp_replace(_col(text), pattern, ""))


def operator_code(callsign="callsign") -> Column:
    return F.substring(_col(callsign), 1, 3)


def wait_class(seconds) -> Column:
    """Half-minute classes 0 (< 30 s) … 6 (180 s and more, or unknown)."""
    c = _col(seconds)
    return F.coalesce(F.greatest(F.lit(0), F.least(F.floor(c / 30), F.lit(6))), F.lit(6)).cast("int")


def day_off(weekday="weekday", holiday="is_holiday") -> Column:
    """1 on weekends and holidays."""
    return F.when(_col(holiday) | _col(weekday).isin("Sat", "Sun"), 1).otherwise(0)


def log_target(seconds) -> Column:
    return F.log1p(_col(seconds))


def unlog_target(value) -> Column:
    return F.expm1(_col(value))


def null_if_zero_pair(first, second) -> Column:
    """A (0, 0) pair is an inconsistency marker: null, else the first value."""
    a, b = _col(first), _col(second)
    return F.when(~((a == 0) & (b == 0)), a)


def rule_based_wait(
    takeoffs="last_min_takeoffs", landings="last_min_landings", category="last_event_turb_cat",
    since="time_since_last_event_seconds", hour="hour", holiday="is_holiday",
) -> Column:
    """Estimate in seconds: 100 plus traffic, wake, spacing and rush-hour terms, minus 30 on holidays; at least 30."""
    traffic = _col(takeoffs) + _col(landings)
    by_traffic = F.when(traffic > 5, 40).when(traffic > 3, 20).otherwise(5)
    by_wake = F.when(_col(category).startswith("H"), 30).when(_col(category).startswith("M"), 15).otherwise(0)
    spacing = F.coalesce(F.greatest(F.lit(0), 60 - _col(since)), F.lit(0))
    rush = F.when(_col(hour).between(7, 10) | _col(hour).between(17, 20), 100).otherwise(0)
    off = F.when(_col(holiday), 30).otherwise(0)
    return F.greatest(F.lit(30), 100 + by_traffic + by_wake + spacing + rush - off)
