"""Temporal splits. Bounds are half-open dates, so the last day of a window is complete."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdshort.operators.spread import number_rows

# First day of the test period, validation days, and the expanding folds
# (last training day, first and last validation day).
TEST_START = "2025-01-15"
HOLDOUT = ("2025-01-01", "2025-01-14")
EXPANDING_FOLDS = [
    ("2024-11-30", "2024-12-01", "2024-12-07"),
    ("2024-12-07", "2024-12-08", "2024-12-14"),
    ("2024-12-14", "2024-12-15", "2024-12-21"),
    ("2024-12-21", "2024-12-22", "2024-12-28"),
    ("2024-12-28", "2024-12-29", "2025-01-04"),
]


def _next_day(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()


def _since(ts, day):
    return F.col(ts) >= F.lit(day).cast("timestamp")


def _before(ts, day):
    return F.col(ts) < F.lit(day).cast("timestamp")


def time_split(rows: DataFrame, test_start: str = TEST_START, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(train, test) around the first test day."""
    return rows.where(_before(ts, test_start)), rows.where(_since(ts, test_start))


def holdout_split(rows: DataFrame, first: str = HOLDOUT[0], last: str = HOLDOUT[1],
                  ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(train, validation): validation is the closed day range, training everything before it."""
    return rows.where(_before(ts, first)), rows.where(_since(ts, first) & _before(ts, _next_day(last)))


def expanding_folds(rows: DataFrame, folds: Sequence[tuple[str, str, str]] = EXPANDING_FOLDS,
                    ts: str = "timestamp") -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) per fold: training grows, validation is the following week."""
    return [
        (rows.where(_before(ts, _next_day(end))), rows.where(_since(ts, first) & _before(ts, _next_day(last))))
        for end, first, last in folds
    ]


def sliding_cuts(rows: DataFrame, window_days: int = 15, step_days: int = 15,
                 ts: str = "timestamp") -> list[tuple[datetime, datetime]]:
    """(cut, end of validation) from the first and last time: a handful of numbers."""
    first, last = rows.agg(F.min(ts), F.max(ts)).first()
    cuts, start = [], first
    while first is not None and start + timedelta(days=window_days) <= last:
        cut = start + timedelta(days=window_days)
        cuts.append((cut, cut + timedelta(days=step_days)))
        start += timedelta(days=step_days)
    return cuts


def sliding_folds(rows: DataFrame, window_days: int = 15, step_days: int = 15,
                  ts: str = "timestamp") -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) per cut: everything before the cut, then the next `step_days`."""
    return [
        (rows.where(F.col(ts) < F.lit(cut)), rows.where((F.col(ts) >= F.lit(cut)) & (F.col(ts) < F.lit(end))))
        for cut, end in sliding_cuts(rows, window_days, step_days, ts)
    ]


def sliding_fold_sizes(rows: DataFrame, window_days: int = 15, step_days: int = 15, ts: str = "timestamp") -> DataFrame:
    """(fold, n_train, n_val) of all sliding folds from one aggregate."""
    day = 86_400_000_000
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    bounds = rows.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    fold = F.floor((at - lo - window_days * day) / F.lit(step_days * day))
    counts = rows.groupBy(F.greatest(fold, F.lit(-1)).alias("fold")).agg(F.count(F.lit(1)).alias("n"))
    last = F.floor((hi - lo - window_days * day) / F.lit(step_days * day))
    # folds without validation rows still count
    grid = rows.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(-1).cast("long"), F.greatest(last, F.lit(-1)))).alias("fold"))
    sizes = grid.join(counts, "fold", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    before = F.sum("n").over(Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("fold", before.alias("n_train"), F.col("n").alias("n_val")).where("fold >= 0")


def with_rank_block(rows: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """Add `block`: 0 for the first rows, then 1 … k for the last k blocks of n // (k + 1) rows in row order.

    Fold i trains on block < i and validates on block i.
    """
    numbered = number_rows(rows, list(order), name="_row")
    n = numbered.agg(F.max("_row")).scalar()
    size = F.floor(n / F.lit(k + 1))
    offset = F.col("_row") - 1 - (n - size * k)
    return numbered.withColumn("block", F.when(offset < 0, 0).otherwise(1 + F.floor(offset / size)).cast("int")).drop("_row")


def rank_folds(blocked: DataFrame, k: int = 5) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) per fold of a table with `block`."""
    return [(blocked.where(F.col("block") < i), blocked.where(F.col("block") == i)) for i in range(1, k + 1)]


def split_by_quantile(rows: DataFrame, value: str, prob: float = 0.75,
                      error: float = 0.01) -> tuple[DataFrame, DataFrame, float]:
    """(low, high, cutoff): rows up to and above an approximate quantile."""
    cutoff = rows.approxQuantile(value, [prob], error)[0]
    return rows.where(F.col(value) <= cutoff), rows.where(F.col(value) > cutoff), cutoff
