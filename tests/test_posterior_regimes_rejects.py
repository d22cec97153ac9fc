"""Averaged logistic regression, gated regimes and rejected lines against plain computations."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from holdshort.models import posterior, regimes, regression
from holdshort.sources import readers
from holdshort.sources.rejects import LINE, REASON, split_rejects


def vectors(df, *columns):
    return df.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def test_probability_equals_the_integral(spark):
    """One feature: the average over the Gaussian by a fine grid over intercept and coefficient."""
    model = posterior.LogisticPosterior(np.array([0.3, -1.2]), np.array([[0.4, 0.1], [0.1, 0.9]]))
    xs = [-40.0, -2.0, -0.5, 0.0, 0.7, 3.0]
    rows = vectors(spark.createDataFrame([(x,) for x in xs], "x double"), "x")
    rows = rows.unionByName(spark.createDataFrame([(99.0, None)], rows.schema))
    got = {r.x: r.p for r in rows.withColumn("p", model.probability()).collect()}
    assert got.pop(99.0) is None
    grid = np.linspace(-8, 8, 801)
    u, v = np.meshgrid(grid, grid)
    weight = np.exp(-(u * u + v * v) / 2)
    root = np.linalg.cholesky(model.covariance)
    a, b = model.mode[0] + root[0, 0] * u, model.mode[1] + root[1, 0] * u + root[1, 1] * v
    for x in xs:
        plain = (posterior.sigmoid(a + b * x) * weight).sum() / weight.sum()
        assert got[x] == pytest.approx(plain, abs=2e-4)


def test_posterior_narrows_with_rows(spark):
    rows = vectors(spark.range(2000).select(((F.col("id") % 41) / 20 - 1).alias("x"), F.rand(3).alias("u")), "x")
    rows = rows.withColumn("label", (F.col("u") < 1 / (1 + F.exp(-2 * F.col("x")))).cast("double"))
    many, few = posterior.logistic_posterior(rows, "label"), posterior.logistic_posterior(rows.limit(50), "label")
    assert many.covariance[1, 1] < few.covariance[1, 1] < 1.0 + 1e-9  # the prior's own variance is 1
    x = np.array([[1.0, r.x] for r in rows.select("x").collect()])
    p = posterior.sigmoid(x @ many.mode)
    plain = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.0, 1.0])
    assert np.allclose(np.linalg.inv(plain), many.covariance, rtol=1e-6)
    # the mode: the gradient of likelihood and prior is zero there
    y = np.array([r.label for r in rows.select("label").collect()])
    assert np.abs(x.T @ (y - p) - np.array([0.0, many.mode[1]])).max() < 0.05


def test_one_class_alone(spark):
    rows = vectors(spark.range(20).withColumn("label", F.lit(1.0)), "id")
    model = posterior.logistic_posterior(rows, "label")
    assert all(r.p > 0.9 for r in rows.select(model.probability().alias("p")).collect())
    assert not posterior.curvature(rows.limit(0), np.zeros(2)).any()


@pytest.fixture(scope="module")
def bend(spark):
    """Flat up to 75, steep beyond: one line fits neither part."""
    rows = spark.range(1000).select((F.col("id") % 100).cast("double").alias("x"))
    rows = rows.withColumn("takeoff_time", F.when(F.col("x") < 75, 10 + 0.1 * F.col("x")).otherwise(20 * (F.col("x") - 70)))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


def test_gate_routes_without_the_target(bend):
    make = lambda: regression.linear_regression("takeoff_time")
    model = regimes.gated_regimes(bend, "takeoff_time", make)
    for weighted, most in ((False, 2.0), (True, 30.0)):
        scored = model.transform(bend, weighted)
        error = scored.agg(F.avg(F.abs(F.col("prediction") - F.col("takeoff_time")))).first()[0]
        blind = model.transform(bend.drop("takeoff_time"), weighted)
        assert error < most
        assert sorted(r.prediction for r in blind.collect()) == sorted(r.prediction for r in scored.collect())
    whole = make().fit(bend).transform(bend).agg(F.avg(F.abs(F.col("prediction") - F.col("takeoff_time")))).first()[0]
    assert whole > 30.0
    routed = regression.two_regime_model(bend, bend.withColumn("takeoff_time", F.lit(0.0)), "takeoff_time", make, model.route)
    assert routed.both.count() == 1000 and routed.high.count() == pytest.approx(250, abs=20)


def test_one_regime(bend):
    flat = bend.withColumn("takeoff_time", F.lit(7.0))
    model = regimes.gated_regimes(flat, "takeoff_time", lambda: regression.linear_regression("takeoff_time"))
    assert model.gate is None
    assert all(math.isclose(r.prediction, 7.0) for r in model.transform(flat).select("prediction").distinct().collect())


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    weather = tmp_path / "weather.csv"
    weather.write_text("latitude,longitude\n40.5,-3.5\n\ntime,a (%)\n2024-01-01T00:00,1.5\n2024-01-01T01:00,\nlater,3\n")
    found = split_rejects(readers.mark_meteo_csv(spark, str(weather)))
    assert (found.read, found.n_rejected) == (6, 4)
    assert [r["a (%)"] for r in found.accepted.orderBy("time").collect()] == [1.5, None]
    assert sorted(r.reason for r in found.rejected.collect()) == ["header", "time", "time", "time"]
    registry = tmp_path / "registry.csv"
    registry.write_text("'icao24','engines','manufacturerName','model','operator','owner'\n'a1','2 JET','M','m','','o'\n'a2','1'\n'a3','','M','m','o','o','x'\n")
    found = split_rejects(readers.mark_aircraft_db(spark, str(registry)))
    assert (found.read, found.n_rejected, found.accepted.count()) == (3, 2, 1)
    assert sorted((r.line, r.reason) for r in found.rejected.collect()) == [("'a2','1'", "fields"), ("'a3','','M','m','o','o','x'", "fields")]
    assert readers.scan_aircraft_db(spark, str(registry)).collect() == found.accepted.collect()


def test_rejects_of_an_empty_table(spark):
    found = split_rejects(spark.createDataFrame([], f"a int, {LINE} string, {REASON} string"))
    assert (found.read, found.n_rejected, found.accepted.count(), found.rejected.count()) == (0, 0, 0, 0)
    assert found.accepted.columns == ["a"]
