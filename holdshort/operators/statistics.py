"""Counts, heat maps, exact quantiles and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.functions.timing import WEEKDAYS
from holdshort.operators.spread import number_rows, spread_join

HOURS = list(range(24))


def flight_status_counts(states: DataFrame, by: Sequence[str] = ("hour",)) -> DataFrame:
    """Distinct callsigns per hour and status."""
    return states.groupBy(*by, "flight_status").agg(F.countDistinct("callsign").alias("count_nonzero"))


def hourly_status_rows(messages: DataFrame) -> DataFrame:
    """Messages per hour of day and status; a missing status counts 0 rows."""
    return messages.groupBy(F.hour("ts").alias("hour"), "flight_status").agg(F.count("flight_status").alias("n"))


def flight_stats(counts: DataFrame, status: str) -> DataFrame:
    """Per weekday for one status: largest, smallest and mean hourly count, with the hours they occur in."""
    if status not in ("on-ground", "airborne"):
        raise ValueError("status must be 'on-ground' or 'airborne'")
    n = F.col("count_nonzero")
    return counts.where(F.col("flight_status") == status).groupBy("day_of_week").agg(
        F.max(n).alias("max_count"), F.min(n).alias("min_count"), F.avg(n).alias("avg_count"),
        # the earliest hour wins a tie
        F.max_by("hour", F.struct(n, -F.col("hour"))).alias("max_hour"),
        F.min_by("hour", F.struct(n, F.col("hour"))).alias("min_hour"),
    )


def wait_heatmap(waits: DataFrame, ts: str = "ts_ground", value: str = "wait_s") -> DataFrame:
    """Mean wait per date (rows) and hour (columns 0 … 23)."""
    dated = waits.withColumns({"date": F.to_date(ts), "_h": F.hour(ts)})
    return pivot_hours(dated, "date", F.col(value))


def pivot_hours(df: DataFrame, row: str, value, finish=lambda c: c) -> DataFrame:
    """Mean of a value per row label with one column per hour `_h`; the hours are known, so one pass suffices."""
    cells = [finish(F.avg(F.when(F.col("_h") == h, value))).alias(f"h{h:02d}") for h in HOURS]
    return df.groupBy(row).agg(*cells)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / df.agg(F.count(F.lit(1))).scalar())


def top_values(df: DataFrame, column: str, k: int = 7) -> DataFrame:
    """The k most frequent values (ties: alphabetically first)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def top_k_else_other(train: DataFrame, rows: DataFrame, column: str, k: int = 7, other: str = "other") -> DataFrame:
    """Values among the k most frequent of `train` keep their name, all others become one. k rows are broadcast."""
    top = top_values(train, column, k).select(column, F.lit(True).alias("_top"))
    return rows.join(F.broadcast(top), column, "left").withColumn(
        f"{column}_grouped", F.when(F.col("_top"), F.col(column)).otherwise(other)).drop("_top")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class: rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    rows, classes = (counts.agg(x).scalar() for x in (F.sum("n"), F.count(F.lit(1))))
    return counts.withColumn("weight", rows / (classes * F.col("n")))


def with_class_weights(rows: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    return spread_join(rows, weights.select(label, "weight"), [label], "left")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, (by…, prob, value), of groups of any size.

    Equal values are counted first, so a frequent value is one row; the distinct ones are put in order by range pieces,
    and only those next to the wanted ranks are gathered.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = number_rows(counted, [value], list(by), "_last", weight="_c")
    sizes = ranked.groupBy(*by).agg(F.max("_last").alias("_n"))
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = F.array(*[F.struct(
        F.lit(float(p)).alias("prob"), (a - F.floor(a)).alias("_part"), (F.floor(a) + 1).cast("long").alias("_lo"))
        for p, a in zip(probs, at)])
    wanted = sizes.select(*by, ranks.alias("_ranks"))
    if by:
        placed = spread_join(ranked.withColumn("_g", F.xxhash64(*by)), wanted.withColumn("_g", F.xxhash64(*by)).drop(*by), ["_g"])
    else:
        placed = ranked.withColumn("_ranks", wanted.scalar())
    first = F.col("_last") - F.col("_c") + 1
    inside = lambda r: (r >= first) & (r <= F.col("_last"))
    hits = F.filter("_ranks", lambda r: inside(r["_lo"]) | inside(r["_lo"] + 1))
    spots = placed.select(*by, value, first.alias("_first"), "_last", F.explode(hits).alias("_r"))
    sides = F.filter(F.array(F.lit(0), F.lit(1)), lambda s: (F.col("_r._lo") + s >= F.col("_first")) & (F.col("_r._lo") + s <= F.col("_last")))
    near = spots.select(*by, F.col("_r.prob").alias("prob"), F.col("_r._part").alias("_part"), F.explode(sides).alias("_side"),
                        F.col(value).cast("double").alias("_v"))
    low = F.max(F.when(F.col("_side") == 0, F.col("_v")))
    high = F.max(F.when(F.col("_side") == 1, F.col("_v")))
    part = F.max("_part")
    return near.groupBy(*by, "prob").agg((low + part * (F.coalesce(high, low) - low)).alias("value"))


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, quartiles, maximum and row count per group."""
    q = exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], by)
    pick = lambda p, name: F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
    return q.groupBy(*by).agg(pick(0.0, "low"), pick(0.25, "q1"), pick(0.5, "median"), pick(0.75, "q3"), pick(1.0, "high"))


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins 0 … bins-1 between smallest and largest value of each group; the last bin is closed."""
    kept = df.where(F.col(value).isNotNull()).select(*by, value)
    limits = kept.groupBy(*by).agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    if by:
        rows = spread_join(kept, limits, list(by))
    else:
        rows = kept.withColumns({"_lo": kept.agg(F.min(value).cast("double")).scalar(),
                                 "_hi": kept.agg(F.max(value).cast("double")).scalar()})
    width = (F.col("_hi") - F.col("_lo")) / bins
    number = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col(value) - F.col("_lo")) / width)).otherwise(0)
    counted = rows.groupBy(*by, "_lo", "_hi", F.least(number, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    low = F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(*by, "bin", low.alias("bin_low"), "n")


def quantile_cutoff(df: DataFrame, value: str, prob: float = 0.75, error: float = 0.01) -> float:
    """Approximate quantile as a number; error 0 asks for an element of exact rank."""
    return df.approxQuantile(value, [prob], error)[0]


def weekday_order(name="weekday"):
    """Sort key Monday … Sunday."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col(name))
