"""Quantiles of any span of days from one sketch per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: ranks of a merged one are off by about 0.4 percent.
SIZE = 800


def day_sketches(rows: DataFrame, value: str, ts: str = "timestamp", size: int = SIZE) -> DataFrame:
    """(day, sketch) with a mergeable sketch (KLL) of the day's values, a few KB; null values and times do not count."""
    known = rows.where(F.col(ts).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(F.to_date(ts).alias("day")).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"))


def fold_cutoffs(sketches: DataFrame, ends: Sequence[datetime], prob: float = 0.75) -> DataFrame:
    """(fold, n, cutoff): the quantile of the days before each end, from the sketches alone; folds without rows are left out.

    Ends are whole days. A day goes to the folds that contain it, whose number is that of the ends.
    """
    within = F.filter(F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(end).cast("date").alias("end")) for i, end in enumerate(ends)]),
                      lambda f: F.col("day") < f["end"])
    dealt = sketches.select(F.explode(F.transform(within, lambda f: f["fold"])).alias("fold"), "sketch")
    merged = dealt.groupBy("fold").agg(F.kll_merge_agg_double("sketch").alias("_all"))
    return merged.select("fold", F.kll_sketch_get_n_double("_all").alias("n"),
                         F.kll_sketch_get_quantile_double("_all", F.lit(float(prob))).alias("cutoff"))
