"""Model fitting and scoring on the whole test tables. Fits have no SQL form, so only their rows are checked."""

from __future__ import annotations

from datetime import datetime

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from holdshort.catalog import query
from holdshort.catalog.aggregates import rounded
from holdshort.catalog.tables import table, wait_rows
from holdshort.features import encoders, quantiles, splits
from holdshort.functions.labels import day_off, wait_class
from holdshort.models import bayes, classification, gram, posterior, regimes, regression, search
from holdshort.operators import reports, statistics
from holdshort.operators.spread import even_pieces
from holdshort.plans import training
from holdshort.session import freeze

NUMERIC = ["last_min_takeoffs", "last_min_landings", "time_since_last_event_seconds", "hour"]
CUT = "2001-01-01"


def encoded(spark, sf):
    """Wait rows with a feature vector; the encoder is fitted on the training period only. Fits read it many times, so
    it is written once, in even pieces: each pass over a piece is one task."""
    rows = encoders.booleans_to_int(wait_rows(spark, sf)).drop("prediction")
    train, _ = splits.time_split(rows, CUT)
    model = encoders.feature_pipeline_lr(["runway", "holding_point", "weekday"], NUMERIC, ["is_holiday"]).fit(train)
    dealt = even_pieces(rows.select("timestamp", "runway", "holding_point", "weekday", "takeoff_time", "is_holiday", *NUMERIC))
    return freeze(model.transform(dealt).select("timestamp", "runway", "holding_point", "takeoff_time", "features"))


def scored_report(scored):
    return rounded(reports.metrics_long(reports.regression_report(scored)), "value", digits=3)


def _fit_and_report(spark, sf, estimator):
    train, test = splits.time_split(encoded(spark, sf), CUT)
    return scored_report(estimator.fit(train).transform(test))


@query("linear_regression")
def _linear(spark, sf):
    return _fit_and_report(spark, sf, regression.linear_regression("takeoff_time", regParam=0.1, elasticNetParam=0.5, maxIter=50))


@query("linear_fit_plain", """SELECT round(regr_slope(CAST(l_quantity AS DOUBLE) * 5, CAST(l_partkey % 120 AS DOUBLE)), 5) AS slope,
  round(regr_intercept(CAST(l_quantity AS DOUBLE) * 5, CAST(l_partkey % 120 AS DOUBLE)), 4) AS intercept, count(*) AS n FROM lineitem""")
def _linear_fit_plain(spark, sf):
    """One feature without a penalty, which has a closed form."""
    rows = wait_rows(spark, sf).select(F.col("takeoff_time").cast("double").alias("takeoff_time"), array_to_vector(
        F.array(F.col("time_since_last_event_seconds").cast("double"))).alias("features"))
    model = regression.linear_regression("takeoff_time", regParam=0.0, standardization=False).fit(rows)
    return rows.agg(F.lit(round(float(model.coefficients[0]), 5)).alias("slope"), F.lit(round(float(model.intercept), 4)).alias("intercept"),
                    F.count(F.lit(1)).alias("n"))


@query("random_forest")
def _forest(spark, sf):
    return _fit_and_report(spark, sf, regression.random_forest("takeoff_time", numTrees=100, maxDepth=10))


@query("boosted_trees")
def _boosted(spark, sf):
    return _fit_and_report(spark, sf, regression.boosted_trees("takeoff_time", maxIter=100, maxDepth=3, subsamplingRate=0.7))


@query("ada_boost")
def _ada(spark, sf):
    train, test = splits.time_split(encoded(spark, sf), CUT)
    return scored_report(regression.ada_boost(train, "takeoff_time", rounds=50).transform(test))


@query("model_per_group")
def _per_group(spark, sf):
    train, test = splits.time_split(encoded(spark, sf), CUT)
    groups = encoders.vocabulary(train, "runway")
    return scored_report(regression.model_per_group(
        train, test, "runway", lambda: regression.boosted_trees("takeoff_time", maxIter=3, maxDepth=3), groups))


@query("two_regime_model")
def _two_regime(spark, sf):
    train, test = splits.time_split(encoded(spark, sf), CUT)
    scores = regression.two_regime_model(train, test, "takeoff_time", lambda: regression.boosted_trees("takeoff_time", maxIter=3, maxDepth=3))
    parts = [scored_report(df).withColumn("regime", F.lit(name)) for name, df in (("low", scores.low), ("high", scores.high), ("both", scores.both))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("two_regime_gated")
def _two_regime_gated(spark, sf):
    """Test rows reach a regime through a gate fitted on training rows, alone or weighted."""
    train, test = splits.time_split(encoded(spark, sf), CUT)
    model = regimes.gated_regimes(train, "takeoff_time", lambda: regression.linear_regression("takeoff_time", regParam=0.01))
    hard, mixed = (scored_report(model.transform(test, weighted)).withColumn("routing", F.lit(name)) for weighted, name in ((False, "hard"), (True, "weighted")))
    return hard.unionByName(mixed)


#: Training grows by a year, the next year validates.
YEARS = [(f"{y}-12-31", f"{y + 1}-01-01", f"{y + 1}-12-31") for y in range(1995, 2000)]


FOLDS = [tuple(datetime.fromisoformat(d) for d in (f"{y + 1}-01-01", f"{y + 1}-01-01", f"{y + 2}-01-01")) for y in range(1995, 2000)]


def _linear_folds(spark, sf):
    rows = encoders.booleans_to_int(wait_rows(spark, sf)).drop("prediction")
    train, _ = splits.time_split(rows, CUT)
    encoder = encoders.feature_pipeline_lr(["runway", "holding_point", "weekday"], NUMERIC, ["is_holiday"]).fit(train)
    # the scale of a feature does not matter to the fit, so one encoding serves all folds
    folds = gram.Folds(encoder.transform(train).select("timestamp", "takeoff_time", "features"), "takeoff_time", FOLDS)
    return folds.search(search.param_grid(**regression.LINEAR_GRID))


ERRORS = ["train_mae", "train_rmse", "val_mae", "val_rmse"]


@query("grid_search_folds")
def _grid_folds(spark, sf):
    """Every setting of the published grid on every fold."""
    flat = [(r["fold"], *[r["params"][p] for p in regression.LINEAR_GRID], *[r[e] for e in ERRORS]) for r in _linear_folds(spark, sf)]
    return rounded(spark.createDataFrame(flat, "fold int, reg double, enet double, max_iter int, " + ", ".join(f"{e} double" for e in ERRORS)),
                   *ERRORS, digits=4)


@query("grid_search")
def _grid(spark, sf):
    """Errors of the settings, averaged over the folds."""
    return rounded(_grid_folds(spark, sf).groupBy("reg", "enet", "max_iter").agg(*[F.avg(e).alias(e) for e in ERRORS]), *ERRORS, digits=4)


@query("ridge_folds", f"""WITH r AS (SELECT CAST(l_partkey % 120 AS DOUBLE) AS x, CAST(l_quantity * 5 AS DOUBLE) AS y,
  year(l_shipdate) AS year FROM lineitem),
f AS (SELECT fold, reg FROM unnest(generate_series(0, 4)) a(fold), (VALUES (0.01), (0.1), (1.0)) b(reg)),
t AS (SELECT fold, reg, count(*) AS n, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, corr(x, y) AS c
  FROM f JOIN r ON year <= 1995 + fold GROUP BY ALL),
m AS (SELECT fold, reg, c / (1 + CAST(reg AS DOUBLE) / sy) * sy / sx AS slope, my - c / (1 + CAST(reg AS DOUBLE) / sy) * sy / sx * mx AS intercept FROM t)
SELECT CAST(fold AS INTEGER) AS fold, CAST(reg AS DOUBLE) AS reg, round(slope, 6) AS slope, round(intercept, 5) AS intercept,
  round(sqrt(avg(pow(y - intercept - slope * x, 2)) FILTER (WHERE year <= 1995 + fold)), 5) AS train_rmse,
  round(sqrt(avg(pow(y - intercept - slope * x, 2)) FILTER (WHERE year = 1996 + fold)), 5) AS val_rmse,
  round(avg(abs(y - intercept - slope * x)) FILTER (WHERE year = 1996 + fold), 5) AS val_mae
FROM m, r GROUP BY fold, reg, slope, intercept""")
def _ridge_folds(spark, sf):
    """Ridge fits of one feature on growing years, which have a closed form."""
    rows = wait_rows(spark, sf).select("timestamp", "takeoff_time", array_to_vector(
        F.array(F.col("time_since_last_event_seconds").cast("double"))).alias("features"))
    found = gram.Folds(rows, "takeoff_time", FOLDS).search(search.param_grid(regParam=[0.01, 0.1, 1.0], elasticNetParam=[0.0]))
    flat = [(r["fold"], r["params"]["regParam"], float(r["coefficients"][0]), r["intercept"], r["train_rmse"], r["val_rmse"], r["val_mae"])
            for r in found]
    names = ["slope", "intercept", "train_rmse", "val_rmse", "val_mae"]
    out = spark.createDataFrame(flat, "fold int, reg double, " + ", ".join(f"{n} double" for n in names))
    return rounded(rounded(out, "slope", digits=6), *names[1:], digits=5)


@query("quantile_by_fold", """SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, true AS within
FROM unnest(generate_series(0, 4)) f(fold) JOIN lineitem ON year(l_shipdate) <= 1995 + fold GROUP BY fold""")
def _quantile_by_fold(spark, sf):
    """Third quartiles of growing years from sketches of days; exact ranks tell whether each lies within one percent."""
    rows = wait_rows(spark, sf).select("timestamp", "takeoff_time")
    cutoffs = quantiles.fold_cutoffs(quantiles.day_sketches(rows, "takeoff_time"), [fold[0] for fold in FOLDS])
    ends = F.element_at(F.array(*[F.lit(fold[0]) for fold in FOLDS]), F.col("fold") + 1)
    ranked = rows.join(F.broadcast(cutoffs), F.col("timestamp") < ends).groupBy("fold", "n").agg(
        F.avg((F.col("takeoff_time") < F.col("cutoff")).cast("double")).alias("below"),
        F.avg((F.col("takeoff_time") <= F.col("cutoff")).cast("double")).alias("up_to"))
    return ranked.select("fold", "n", ((F.col("below") <= 0.76) & (F.col("up_to") >= 0.74)).alias("within"))


@query("training_plan")
def _training_plan(spark, sf):
    rows = freeze(even_pieces(encoders.booleans_to_int(wait_rows(spark, sf)).drop("prediction")))
    encoder = encoders.feature_pipeline_lr(["runway", "holding_point", "weekday"], NUMERIC, ["is_holiday"])
    trained = training.train(rows, CUT, YEARS, encoder, lambda **p: regression.linear_regression("takeoff_time", **p),
                             search.param_grid(**regression.LINEAR_GRID))
    return rounded(trained.report(), "value", digits=3)


@query("top_features")
def _top_features(spark, sf):
    rows = encoders.booleans_to_int(wait_rows(spark, sf))
    words = {c: encoders.vocabulary(rows, c) for c in ("runway", "holding_point")}
    wide = encoders.one_hot_wide(rows.select("takeoff_time", "runway", "holding_point", *NUMERIC), list(words), words)
    names = [c for c in wide.columns if c != "takeoff_time"]
    vectors = wide.select("takeoff_time", array_to_vector(F.array(*[F.col(f"`{c}`").cast("double") for c in names])).alias("features"))
    model = regression.linear_regression("takeoff_time", regParam=0.01).fit(vectors)
    return rounded(regression.top_features(spark, names, model.coefficients.toArray()), "weight", digits=4)


def class_rows(spark, sf):
    rows = encoders.booleans_to_int(wait_rows(spark, sf)).drop("prediction").withColumn("label", wait_class("takeoff_time").cast("double"))
    train, _ = splits.time_split(rows, CUT)
    out = encoders.feature_pipeline_minmax(["runway", "holding_point"], NUMERIC).fit(train).transform(rows)
    return freeze(out.select("timestamp", "weekday", "is_holiday", "label", "features"))


def _bayes_rows(spark, sf):
    rows = class_rows(spark, sf)
    train, test = splits.time_split(rows, CUT)
    weighted = statistics.with_class_weights(train, statistics.class_weights(train, "label"), "label")
    fit, validation = splits.time_split(weighted, "2000-01-01")
    return weighted, fit, validation, test


@query("naive_bayes")
def _naive_bayes(spark, sf):
    weighted, fit, validation, test = _bayes_rows(spark, sf)
    best, _ = bayes.search(bayes.ClassSums.of(fit, "label"), search.param_grid(**classification.BAYES_GRID), validation, "label")
    model = bayes.ClassSums.of(weighted, "label").model(best["modelType"], best["smoothing"])
    scored = test.withColumn("prediction", model.predict(vector_to_array("features")))
    return rounded(reports.classification_report(scored), "precision", "recall", "f1", digits=4)


@query("naive_bayes_grid")
def _naive_bayes_grid(spark, sf):
    """Hold-out accuracy of every setting of the published grid."""
    _, fit, validation, _ = _bayes_rows(spark, sf)
    _, results = bayes.search(bayes.ClassSums.of(fit, "label"), search.param_grid(**classification.BAYES_GRID), validation, "label")
    flat = [(r["params"]["modelType"], r["params"]["smoothing"], r["accuracy"]) for r in results]
    return rounded(spark.createDataFrame(flat, "kind string, smoothing double, accuracy double"), "accuracy", digits=4)


@query("naive_bayes_parameters", """WITH r AS (SELECT CAST(l_suppkey % 3 AS INTEGER) AS label, CAST(l_quantity AS DOUBLE) AS w,
  [CAST(l_orderkey % 4 AS DOUBLE), CAST(l_partkey % 4 AS DOUBLE), CAST(l_partkey % 120 AS DOUBLE)] AS x FROM lineitem),
c AS (SELECT label, sum(w) AS n FROM r GROUP BY 1),
s AS (SELECT label, CAST(slot AS INTEGER) AS slot, sum(w * x[slot + 1]) AS v, sum(w * x[slot + 1] * x[slot + 1]) AS q
  FROM r, unnest(generate_series(0, 2)) u(slot) GROUP BY ALL),
t AS (SELECT label, sum(v) AS all_v FROM s GROUP BY 1), a AS (SELECT sum(n) AS n FROM c),
w AS (SELECT max(q / n - (v / n) ** 2) AS most FROM (SELECT slot, sum(v) AS v, sum(q) AS q FROM s GROUP BY 1), a)
SELECT label, slot, round(ln(c.n + 0.5) - ln(a.n + 0.5 * 3), 6) AS prior, round(ln(v + 0.5) - ln(all_v + 0.5 * 3), 6) AS theta,
  round(v / c.n, 6) AS mean, round(q / c.n - (v / c.n) ** 2 + 1e-9 * most, 4) AS variance
FROM s JOIN c USING (label) JOIN t USING (label), a, w""")
def _naive_bayes_parameters(spark, sf):
    """Multinomial (smoothing 0.5) and Gaussian parameters by class and feature."""
    columns = ["last_min_takeoffs", "last_min_landings", "time_since_last_event_seconds"]
    rows = wait_rows(spark, sf).select((F.col("icao").cast("int") % 3).alias("label"), (F.col("takeoff_time") / 5).alias("weight"),
                                       array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])).alias("features"))
    sums = bayes.ClassSums.of(rows, "label")
    counts, normal = sums.model("multinomial", 0.5), sums.model("gaussian")
    flat = [(label, slot, *map(float, (counts.prior[i], counts.theta[i, slot], normal.theta[i, slot], normal.sigma[i, slot])))
            for i, label in enumerate(sums.labels) for slot in range(len(columns))]
    out = spark.createDataFrame(flat, "label int, slot int, prior double, theta double, mean double, variance double")
    return rounded(rounded(out, "prior", "theta", "mean", digits=6), "variance", digits=4)


@query("logistic_binary")
def _logistic_binary(spark, sf):
    rows = class_rows(spark, sf).withColumn("label", day_off(holiday=F.col("is_holiday") == 1).cast("double"))
    train, test = splits.time_split(rows, CUT)
    score = posterior.logistic_posterior(train, "label").probability()
    scored = freeze(test.withColumn("score", score).withColumn("prediction", (F.col("score") >= 0.5).cast("double")))
    area = reports.auc(scored.select(F.col("label").cast("int").alias("label"), "score"))
    report = reports.classification_report(scored)
    return rounded(report.unionByName(area.select(F.lit("auc").alias("class"), F.col("auc").alias("precision"), F.col("auc").alias("recall"),
                                                  F.col("auc").alias("f1"), F.lit(0).cast("long").alias("support"))),
                   "precision", "recall", "f1", digits=4)


@query("logistic_curvature", """WITH r AS (SELECT [1e0, (l_partkey % 120) / 120e0, (l_orderkey % 4) / 4e0] AS a FROM lineitem),
w AS (SELECT a, 1 / (1 + exp(-(0.25e0 + 0.5e0 * a[2] - a[3]))) AS p FROM r)
SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(sum(p * (1 - p) * a[i + 1] * a[j + 1]), 4) AS value
FROM w, unnest(generate_series(0, 2)) u(i), unnest(generate_series(0, 2)) v(j) GROUP BY ALL""")
def _logistic_curvature(spark, sf):
    """Curvature of the log-likelihood at given coefficients, from which the posterior's width comes."""
    rows = wait_rows(spark, sf).select(array_to_vector(F.array(
        F.col("time_since_last_event_seconds") / 120, F.col("last_min_takeoffs") / 4)).alias("features"))
    found = posterior.curvature(rows, np.array([0.25, 0.5, -1.0]))
    flat = [(i, j, float(found[i, j])) for i in range(3) for j in range(3)]
    return rounded(spark.createDataFrame(flat, "i int, j int, value double"), "value", digits=4)


@query("logistic_multi")
def _logistic_multi(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                                                 (F.col("vec_id") % 5 == 0).alias("held_out"))
    scored = classification.logistic_map(rows.where("NOT held_out"), "label", family="multinomial").transform(rows.where("held_out"))
    return rounded(reports.classification_report(scored), "precision", "recall", "f1", digits=4)
