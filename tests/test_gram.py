"""Linear models from sums of products against Spark's own fits, and stand-in spans against brute force."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from holdshort.models import gram, search
from holdshort.operators import prior_waits

START = datetime(2024, 1, 1)
FOLDS = [(START + timedelta(days=d), START + timedelta(days=d + 1), START + timedelta(days=d + 4)) for d in (6, 10, 30)]


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(4)
    data = []
    for i in range(900):
        a, b = pick.gauss(0, 1), pick.gauss(5, 30)
        data.append((START + timedelta(hours=i * 0.4), 3 * a - 0.2 * b + pick.gauss(0, 2) + 7, a, b, a + 0.5 * pick.gauss(0, 1), 1.0, float(i % 3 == 0)))
    data.append((None, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0))
    df = spark.createDataFrame(data, "timestamp timestamp, y double, a double, b double, c double, one double, flag double")
    return VectorAssembler(inputCols=["a", "b", "c", "one", "flag"], outputCol="features").transform(df).repartition(5)


@pytest.mark.parametrize(("reg", "elastic"), [(0.0, 0.0), (0.01, 0.0), (1.0, 0.0), (0.01, 0.5), (0.1, 1.0), (1.0, 0.5)])
def test_fits_equal_sparks(rows, reg, elastic):
    folds = gram.Folds(rows, "y", FOLDS)
    for number, (end, start, until) in enumerate(FOLDS):
        train = rows.where(F.col("timestamp") < F.lit(end))
        validation = rows.where((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(until)))
        model = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=elastic, tol=1e-12, maxIter=1000).fit(train)
        found = next(r for r in folds.search([{"regParam": reg, "elasticNetParam": elastic}]) if r["fold"] == number)
        assert np.allclose(found["coefficients"], model.coefficients.toArray(), atol=1e-6, rtol=1e-6)
        assert found["intercept"] == pytest.approx(model.intercept, abs=1e-6)
        assert (found["train_mae"], found["train_rmse"]) == pytest.approx(search.regression_errors(model.transform(train), "y"), rel=1e-6)
        if validation.count():
            assert (found["val_mae"], found["val_rmse"]) == pytest.approx(
                search.regression_errors(model.transform(validation), "y"), rel=1e-6)
        else:
            assert found["val_mae"] is None and found["val_rmse"] is None


def test_all_settings_in_two_passes(rows):
    grid = search.param_grid(regParam=[0.01, 50.0], elasticNetParam=[0.0, 1.0], maxIter=[5, 50])
    found = gram.Folds(rows, "y", FOLDS).search(grid)
    assert len(found) == len(grid) * len(FOLDS) and gram.best_setting(found)["regParam"] == 0.01


def test_descent_reaches_the_minimum_of_alike_features():
    pick = np.random.default_rng(3)
    x = pick.normal(size=(400, 3))
    x[:, 2] = x[:, 0] + 0.02 * pick.normal(size=400)
    x = (x - x.mean(0)) / x.std(0)
    both, pull = x.T @ x / 400, x.T @ (x @ [1, -2, 0.5] + pick.normal(size=400)) / 400
    found = gram.descend(both, pull, 0.05, 0.01)
    slope = both @ found - pull + 0.01 * found  # of the smooth part; its negative is a subgradient of 0.05 |b|
    assert np.allclose(np.where(found != 0, slope + 0.05 * np.sign(found), 0), 0, atol=1e-9) and (np.abs(slope) <= 0.05 + 1e-9).all()


def test_no_rows(rows):
    found = gram.Folds(rows.limit(0), "y", FOLDS).search([{"regParam": 0.1}])
    assert all(r["train_rmse"] is None and r["train_mae"] is None and r["intercept"] == 0 for r in found)


def test_stand_ins_at_points_equal_brute_force(spark):
    pick = random.Random(8)
    groups = [("r1", "2024-01-01"), ("r2", "2024-01-01"), (None, "2024-01-02")]
    points = [(*groups[0], t) for t in range(0, 400, 3)] + [(*groups[1], t) for t in (5, 6, 7)] + [(*groups[2], 9)]
    spans = []
    for i in range(300):
        start = pick.randint(-20, 400)
        spans.append((*pick.choice(groups[:2]), start, start + pick.choice([0, 1, 3, 40, 400]), (pick.randint(0, 30), f"f{i}", float(i))))
    of = spark.createDataFrame(points, "runway string, _day string, _t long")
    standins = spark.createDataFrame(spans, "runway string, _day string, _from long, _to long, _item struct<t: long, callsign: string, wait: double>")
    found = {(r.runway, r._day, r._t): [tuple(x) for x in r._extra] for r in prior_waits._standins_at(of, standins, 4).collect()}
    expected = defaultdict(list)
    for runway, day, t in points:
        hits = sorted((s[4] for s in spans if s[0] == runway and s[1] == day and s[2] < t <= s[3]), reverse=True)[:4]
        if hits:
            expected[runway, day, t] = hits
    assert found == expected
