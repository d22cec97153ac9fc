"""Prediction errors by group, and classification metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdshort.operators.spread import freeze
from holdshort.operators.statistics import box_stats, histogram, pivot_hours, weekday_order


def with_errors(scored: DataFrame, target: str = "takeoff_time", prediction: str = "prediction") -> DataFrame:
    """Add error, abs_error, squared_error and mape (percent; a target of 0 counts as 1)."""
    e = F.col(prediction) - F.col(target)
    base = F.when(F.col(target) == 0, F.lit(1.0)).otherwise(F.col(target))
    return scored.withColumns({
        "error": e, "abs_error": F.abs(e), "squared_error": e * e, "mape": F.abs(e) * 100 / base,
    })


def _mae_rmse():
    return F.avg("abs_error").alias("mae"), F.sqrt(F.avg("squared_error")).alias("rmse")


def regression_report(scored: DataFrame, by: Sequence[str] = ("runway", "holding_point"),
                      target: str = "takeoff_time", prediction: str = "prediction") -> DataFrame:
    """(scope, key, n, mae, mse, rmse, r2, mape) for all rows and for each value of each grouping column.

    One grouping-sets aggregate. R² and MAPE are given for all rows only. Sums of squares are taken around the overall
    mean, which avoids the cancellation of a single-pass formula.
    """
    rows = with_errors(scored.where(F.col(target).isNotNull() & F.col(prediction).isNotNull()), target, prediction)
    rows = rows.withColumn("_dev", F.col(target) - rows.agg(F.avg(target)).scalar())
    # a grouping column that is null on a row must not be mistaken for the all-rows line
    grouped = rows.groupingSets([[]] + [[F.col(c)] for c in by], *[F.col(c) for c in by]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"), *_mae_rmse(), F.avg("squared_error").alias("mse"),
        (1 - F.sum("squared_error") / F.sum(F.col("_dev") * F.col("_dev"))).alias("r2"), F.avg("mape").alias("mape"))
    everything = 2 ** len(by) - 1
    scope, key = F.lit("all"), F.lit(None).cast("string")
    for i, c in enumerate(by):
        only = F.col("_set") == everything - 2 ** (len(by) - 1 - i)
        scope = F.when(only, F.lit(c)).otherwise(scope)
        key = F.when(only, F.col(c).cast("string")).otherwise(key)
    whole = F.col("_set") == everything
    return grouped.select(
        scope.alias("scope"), key.alias("key"), "n", "mae", "mse", "rmse",
        F.when(whole, F.col("r2")).alias("r2"), F.when(whole, F.col("mape")).alias("mape"),
    ).where((F.col("scope") == "all") | F.col("key").isNotNull())


def metrics_long(report: DataFrame, suffix: str = "test") -> DataFrame:
    """Report flattened to (metric, value): `mae_test`, `mae_test_runway_<runway>`, `mae_test_hp_<point>` …"""
    long = report.unpivot(["scope", "key"], ["mae", "rmse", "mse", "r2", "mape"], "measure", "value")
    whole = F.col("scope") == "all"
    short = F.when(F.col("scope") == "holding_point", "hp").otherwise(F.col("scope"))
    name = F.when(whole, F.concat_ws("_", "measure", F.lit(suffix))).otherwise(
        F.concat_ws("_", "measure", F.lit(suffix), short, "key"))
    return long.where(F.col("value").isNotNull() & (whole | F.col("measure").isin("mae", "rmse"))).select(
        name.alias("metric"), "value")


def group_errors(scored: DataFrame, by: str) -> DataFrame:
    return with_errors(scored).groupBy(by).agg(*_mae_rmse())


def error_heatmap(scored: DataFrame, metric: str = "mae") -> DataFrame:
    """Error per weekday (Monday first, with its sort key) and hour as columns."""
    rows = with_errors(scored).withColumn("_h", F.col("hour"))
    value, finish = (F.col("abs_error"), lambda c: c) if metric == "mae" else (F.col("squared_error"), F.sqrt)
    return pivot_hours(rows, "weekday", value, finish).withColumn("day_order", weekday_order("weekday").cast("int"))


def error_by_weekday_hour(scored: DataFrame) -> DataFrame:
    """The long form of the heat map: MAE and RMSE per (weekday, hour)."""
    return with_errors(scored).groupBy("weekday", "hour").agg(*_mae_rmse())


def error_by_day(scored: DataFrame, ts: str = "timestamp") -> DataFrame:
    return with_errors(scored).groupBy(F.to_date(ts).alias("date")).agg(*_mae_rmse())


def error_by_category(scored: DataFrame, columns: Sequence[str] = ("turbulence_category", "last_event_turb_cat")) -> DataFrame:
    """Box statistics of the error per value of each category column."""
    long = with_errors(scored).unpivot("error", list(columns), "category_type", "category_value")
    return box_stats(long, "error", ["category_type", "category_value"])


def error_histogram(scored: DataFrame, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    return histogram(with_errors(scored), "error", bins, by)


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (true class, predicted class)."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1 and support, and the lines `accuracy` and `weighted`.

    Works on the confusion matrix, so the rows are read once.
    """
    cells = confusion_matrix(scored, label, prediction)
    sides = F.explode(F.array(
        F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("hits")),
        F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("hits")),
    ))
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    per = cells.withColumn("_right", right).select(sides.alias("s"), "_right").select("s.*", "_right")
    per = per.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("hits").alias("hits"),
        F.sum(F.when(F.col("support") > 0, F.col("_right")).otherwise(0)).alias("tp"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    per = per.withColumns({"precision": ratio(F.col("tp"), F.col("hits")), "recall": ratio(F.col("tp"), F.col("support"))})
    p, r = F.col("precision"), F.col("recall")
    per = per.withColumn("f1", ratio(2 * p * r, p + r))
    total = F.sum("support")
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / total
    summary = per.agg(weighted("precision").alias("precision"), weighted("recall").alias("recall"),
                      weighted("f1").alias("f1"), total.alias("support"), (F.sum("tp") / total).alias("_acc"))
    line = lambda name, *cols: summary.select(F.lit(name).alias("class"), *cols, "support")
    acc = F.col("_acc")
    return (
        per.select("class", "precision", "recall", "f1", "support")
        .unionByName(line("weighted", "precision", "recall", "f1"))
        .unionByName(line("accuracy", acc.alias("precision"), acc.alias("recall"), acc.alias("f1")))
    )


def roc_points(scored: DataFrame, label: str = "label", score: str = "score", parts: int | None = None) -> DataFrame:
    """(threshold, tpr, fpr) at every distinct score, from the largest down; label 1 is positive.

    Counts per distinct score are cut into range pieces and summed up piece by piece.
    """
    counts = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    parts = parts or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = freeze(counts.repartitionByRange(parts, F.desc("threshold")).withColumn("_piece", F.spark_partition_id()))
    sizes = pieces.groupBy("_piece").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shifts = sizes.select(
        "_piece", F.coalesce(F.sum("p").over(earlier), F.lit(0)).alias("_p0"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n0"),
        F.sum("p").over(everything).alias("_p"), F.sum("n").over(everything).alias("_n"))
    upto = Window.partitionBy("_piece").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    cum = pieces.join(shifts, "_piece").withColumns({
        "cum_pos": F.sum("pos").over(upto) + F.col("_p0"), "cum_neg": F.sum("neg").over(upto) + F.col("_n0")})
    return cum.select("threshold", "pos", "neg", "cum_pos", "cum_neg",
                      (F.col("cum_pos") / F.col("_p")).alias("tpr"), (F.col("cum_neg") / F.col("_n")).alias("fpr"))


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by trapezoids, as a one-row table."""
    p = roc_points(scored, label, score)
    area = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    return p.agg((F.sum(area) / (F.sum("neg") * F.sum("pos"))).alias("auc"))
